"""Readers: flat files, stored tables, JDBC queries, folder listings."""
