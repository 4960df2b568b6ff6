"""Table-building plans: one function per curated table."""
