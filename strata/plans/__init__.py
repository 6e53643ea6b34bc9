"""Composed plans: the lakehouse jobs, the record flow, run metrics, and the
query catalog the driver checks."""
