"""Writers for tables, documents and reports."""
