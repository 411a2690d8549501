"""End-to-end jobs composed from ``opsflow.operators``."""
