"""Operators: framing, filters, folding, batching, DDL, SQL text, advice and repair."""
