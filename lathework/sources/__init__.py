"""Readers and writers for feature tables, targets, submissions, models and search logs."""
