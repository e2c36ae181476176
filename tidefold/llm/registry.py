"""The queries and SQL of this subpackage, for the driver's entry module."""

from .queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
