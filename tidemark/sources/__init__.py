"""Readers: parquet tables with fixed schemas, JDBC tables, application logs."""
