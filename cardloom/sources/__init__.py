"""Readers and writers: text feed, Parquet tables, message envelopes, events adapter."""
