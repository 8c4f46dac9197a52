"""Observation engine on Spark: folds unreliable observations into audited current-state tables."""
