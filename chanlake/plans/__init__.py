"""Whole jobs, from files to tables."""
