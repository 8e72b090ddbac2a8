"""Operators on the text of documents for training data; nothing outside this subpackage imports it."""
