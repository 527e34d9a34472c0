"""Spark jobs that turn cached basketball game pages and archives into typed tables and reports."""
