"""Operators that prepare text for the training of language models, their queries and their SQL."""
