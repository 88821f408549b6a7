"""Whole jobs (DataFrame and SQL forms) and the query catalog."""
