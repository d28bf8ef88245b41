"""Operators for preparing training data: the documents, pages, vectors and conversations of a corpus."""
