"""LedgerLake: a Spark-first engine for verifiable datasets."""
