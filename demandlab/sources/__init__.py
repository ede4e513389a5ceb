"""Schemas, table inputs, CSV files and the demand table."""
