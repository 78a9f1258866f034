"""Drift monitoring on Spark: keyed tables, chronological splits, exact metrics, verdicts."""
