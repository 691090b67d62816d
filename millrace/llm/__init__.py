"""Operators for preparing training data from text, vectors and web pages."""
