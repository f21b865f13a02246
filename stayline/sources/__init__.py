"""Reading and writing tables, and the description of each supported database."""
