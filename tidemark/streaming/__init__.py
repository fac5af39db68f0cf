"""Raw files landed as they arrive."""
