"""Training-data operators over ``documents``, ``embeddings`` and ``benchmark``.

Nothing else in the library imports this subpackage; ``queries.py`` registers
its queries. Model and text work runs on Arrow batches inside tasks, all
grouping and joining is Spark's.
"""
