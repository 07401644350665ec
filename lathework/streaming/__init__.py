"""Scoring of file streams with fitted stages."""
