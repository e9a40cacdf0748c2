"""Readers that turn files, pages and JSON into typed DataFrames."""
