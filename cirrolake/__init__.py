"""Weather lakehouse on PySpark: landed API responses to a tested star schema and its dashboard queries."""
