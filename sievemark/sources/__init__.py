"""Reading files with a pinned schema, comparing schemas, storing tables and reports."""
