"""Operators of a training-data pipeline (documents, labels, embeddings).

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries only when it is present.
"""
