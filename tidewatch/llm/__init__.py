"""Operators of a training-data pipeline over documents, pages and URLs.

One module per operator; ``queries`` binds them to the given tables. Nothing
outside this folder (and ``corpus_pipeline.py``) imports it.
"""
