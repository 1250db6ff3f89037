"""Spark analytics for networks of linked videos.

Every operator takes DataFrames and returns a lazy DataFrame; only the
iterative graph algorithms run jobs while they are being built.
"""
