"""Reading and writing: landing zone, tables, runs, JDBC."""
