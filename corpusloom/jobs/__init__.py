"""Jobs: compositions of operators that read tables and write tables."""
