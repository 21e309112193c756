"""Training-data operators: sharding, deduplication, packing, language ID and the like.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries
only when it can be imported.
"""
