"""Reusable relational operators: quality rules, lookups, integrity checks, profiling, filters, paging."""
