"""sluice: deterministic multi-table ingestion and corpus operators on PySpark."""
