"""Whole jobs: operators put together into the tables and reports that users ask for."""
