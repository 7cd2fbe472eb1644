"""Collaborative filtering on Spark DataFrames.

``sources`` read and write tables, ``functions`` are column expressions,
``operators`` map DataFrames to DataFrames, and ``plans`` chain operators
into the jobs and answers a caller asks for.
"""
