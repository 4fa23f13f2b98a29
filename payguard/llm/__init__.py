"""Operators for large training-data pipelines over ``documents``, ``pages`` and
``embeddings``. Nothing else in the package imports this subpackage; its
queries are in :mod:`payguard.llm.queries`."""
