"""Operators of a training-data pipeline: deduplication, quality and toxicity
scores, source mixing, tokenisation and secret scans, each a Spark job.

Nothing else in the library imports this subpackage; ``queries`` registers
one query per operator.
"""
