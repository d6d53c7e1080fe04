"""Whole flows: the monthly load, the retail view, and the registered queries."""
