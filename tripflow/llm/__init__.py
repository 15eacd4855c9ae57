"""Operators of a training-data pipeline over text, URL and vector tables.

Nothing else in the package imports this one.  Every operator takes and
returns DataFrames; ``queries.py`` registers one thin query per operator.
"""
