"""Drop files in, tables and files out."""
