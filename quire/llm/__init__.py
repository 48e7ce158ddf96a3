"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Every operator takes a DataFrame and returns one whose column ``row`` is the struct of all input
columns (so that extra columns, whatever their names, pass through) beside its own outputs.
"""
