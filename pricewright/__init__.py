"""Product and price intelligence on PySpark."""
