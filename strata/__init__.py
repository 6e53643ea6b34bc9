"""strata: customer, event and transaction data operators on Spark DataFrames.

Bronze / silver / gold jobs (ingest with malformed rows set aside, single-pass
validation with quarantine, dedup, enrichment, versioned upserts, daily summary,
customer lifetime value) and a record flow (filter, normalize, rename, dedup)
that runs as a batch job or on Structured Streaming.
"""

__version__ = "0.1.0"
