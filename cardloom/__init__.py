"""Fraud-transaction analytics on Spark: clean, profile, train, validate, score and monitor."""
