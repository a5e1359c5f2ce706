"""Audited medallion pipelines on Spark: land, reconcile, clean, profile, build marts, evaluate."""
