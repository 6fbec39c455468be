"""Training-data operators: archives, deduplication, tokenisation, filters and mixing.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
