"""Compositions of operators: dashboard pages, findings, the query registry, batch jobs."""
