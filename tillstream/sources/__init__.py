"""Reading and writing: message streams, tables, databases."""
