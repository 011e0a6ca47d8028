"""Operators for preparing training data of language models, each one module."""
