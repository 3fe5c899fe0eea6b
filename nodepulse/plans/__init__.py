"""Operators chained into whole jobs, and the registry of checked queries."""
