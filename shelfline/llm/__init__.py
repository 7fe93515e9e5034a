"""Operators that turn a corpus of documents into training data, one module each."""
