"""Test input and query registry: ride events made from the given tables, and the queries that run the library on them."""
