"""Operators: functions DataFrame -> DataFrame, key and order columns as parameters."""
