"""Inputs: CSV files and published tables."""
