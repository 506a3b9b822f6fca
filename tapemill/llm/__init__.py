"""Operators that prepare a text corpus for training, each over a DataFrame of documents, pages or vectors."""
