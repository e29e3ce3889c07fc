"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage.  The operators take a
DataFrame with an id and a text column and return narrow DataFrames; heavy
per-document work runs as numpy over Arrow batches (:mod:`core`), while Spark
partitions, shuffles and joins it.
"""
