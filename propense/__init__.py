"""Customer-offer analytics as Spark jobs: ingest, check, join, profile, model, score, decide."""
