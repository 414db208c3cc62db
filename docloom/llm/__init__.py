"""Operators for preparing training corpora, their queries and their expected-result SQL."""
