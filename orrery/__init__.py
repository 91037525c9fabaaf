"""orrery: telemetry ingestion, window features, models and scoring as Spark jobs."""

__version__ = "0.1.0"
