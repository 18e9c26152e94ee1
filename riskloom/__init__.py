"""Leakage-safe behavioural features, evaluation and decisions on Spark."""
