"""Operators of a training-data pipeline (documents, embeddings, pages).

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its queries
when it can be imported.
"""
