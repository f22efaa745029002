"""Daily price-bar ingest, audit and reporting on Spark."""
