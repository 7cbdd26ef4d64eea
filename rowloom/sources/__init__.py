"""Reading and writing tables, files and databases."""
