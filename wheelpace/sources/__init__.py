"""Reading and writing trip tables and result tables."""
