"""The queries on training data and their SQL, from the modules of this package."""

from __future__ import annotations

from tessagraph.llm import budget_queries, name_queries, text_queries, vector_queries

QUERIES = {**text_queries.QUERIES, **budget_queries.QUERIES, **name_queries.QUERIES, **vector_queries.QUERIES}
SQL = {**text_queries.SQL, **budget_queries.SQL, **name_queries.SQL, **vector_queries.SQL}
