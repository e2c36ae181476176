"""Change-data federation on Spark: change chunks in, current-state federated tables out."""
