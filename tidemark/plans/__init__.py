"""Whole tables: silver from raw feeds, gold from silver."""
