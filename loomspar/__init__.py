"""Schema-driven record ingestion, entity resolution and validation on PySpark."""
