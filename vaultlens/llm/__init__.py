"""Operators of a training-data pipeline: token files, dedup, quality, decontamination, scans, WARC.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds its
queries only when it can be imported.
"""
