"""Training-data operators: search, deduplication, tokenization, quality and packing.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries
when it can be imported.
"""
