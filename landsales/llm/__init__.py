"""Training-data operators: thirteen Spark jobs over documents, embeddings, pages and benchmark tables.

Nothing else in the library imports this subpackage.
"""
