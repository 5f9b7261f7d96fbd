"""Queries by name, and their DuckDB SQL."""

from docpack.plans import io_queries, scalar_queries

QUERIES = scalar_queries.QUERIES | io_queries.QUERIES
SQL = scalar_queries.SQL | io_queries.SQL
