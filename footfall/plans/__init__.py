"""Whole analyses: the three jobs, and the registered queries with their SQL."""
