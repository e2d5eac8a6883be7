"""Whole jobs, the table views they run on, and the query catalog."""
