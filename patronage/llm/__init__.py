"""Operators of a training-data pipeline: packing, tokenizing, language and
quality scores, exact / near / substring duplicates, archives, LM scores.

Every operator takes a DataFrame and returns a DataFrame; Spark partitions and
shuffles the work, Python sees Arrow batches of a task at a time. Nothing
outside this package imports it.
"""
