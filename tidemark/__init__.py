"""Config-driven incremental ingest, merge and modelling of tables on Spark."""
