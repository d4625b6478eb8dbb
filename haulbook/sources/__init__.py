"""Reading base tables, constant tables and writing reports."""
