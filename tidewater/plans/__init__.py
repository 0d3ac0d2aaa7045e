"""Registered queries and flows, size estimates, JDBC queries for a given database."""
