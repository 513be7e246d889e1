"""Training-data operators: cleaning, deduplication, scanning, mixing and packing of text corpora.

Nothing outside this subpackage imports it; `queries.py` registers one query per operator.
"""
