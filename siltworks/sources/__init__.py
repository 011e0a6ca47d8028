"""Files, tables, table versions and their layout."""
