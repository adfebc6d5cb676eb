"""Multi-row operators composed from joins, grouping and windows."""
