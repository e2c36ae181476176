"""Stored state, federated tables, base backups and the query catalog."""
