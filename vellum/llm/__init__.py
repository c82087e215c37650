"""Training-data operators: language id, deduplication, quality, tokens, packing.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries only where the subpackage is present.
"""
