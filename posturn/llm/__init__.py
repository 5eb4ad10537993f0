"""Operators of a training-data pipeline: cleaning, deduplication, packing.

One module per operator; ``queries`` registers them with the driver.  Nothing
outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
