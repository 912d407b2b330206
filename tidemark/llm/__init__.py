"""Operators for preparing training text at scale.

Nothing else in the library imports this package. Every operator takes DataFrames and column names,
reads only the columns it names (so extra columns, whatever they are called, do no harm) and returns
rows keyed by the id column it was given.
"""
