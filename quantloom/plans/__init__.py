"""Compositions of operators: the registered queries and the nightly run."""
