"""Scans: files in, DataFrames with a declared schema out."""
