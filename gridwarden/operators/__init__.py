"""Reusable operators over network DataFrames."""
