"""Outputs: staged and bucketed file tables, literal inserts, console, JDBC."""
