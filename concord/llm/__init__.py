"""Operators for preparing training data at scale.

Nothing else in the library imports this subpackage.  Every operator takes
DataFrames and parameters and returns a lazy DataFrame; the registered queries
are in :mod:`concord.llm.queries`.
"""
