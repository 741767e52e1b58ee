"""Operators of a training-data pipeline, one module per operator.

Nothing else in the library imports this subpackage; its queries and SQL are
in :mod:`riskframe.llm.queries`.
"""
