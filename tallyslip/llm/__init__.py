"""Operators for preparing language-model training data.

Nothing outside this package imports it. Every operator takes and returns DataFrames; where a task
needs Python it works on Arrow batches inside `mapInArrow`, so Spark keeps the partitioning.
"""
