"""Training-data operators (filtering, deduplication, extraction, mixing).

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries when it is present.
"""
