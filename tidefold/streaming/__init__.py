"""Structured Streaming: chunks to spool, spool to federated tables."""
