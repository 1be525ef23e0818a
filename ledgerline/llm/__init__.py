"""Operators of a training-data pipeline, re-expressed as Spark jobs.

Nothing outside this folder imports it: deleting ``ledgerline/llm``,
``tests/llm`` and ``corpus_pipeline.py`` leaves the rest of the library
working.  ``queries.py`` registers one query per operator.
"""
