"""Whole jobs over stored tables, and the registered queries."""
