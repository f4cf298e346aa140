"""Operators for preparing training data for language models.

Nothing outside this subpackage imports it. Each module holds one operator;
``queries`` registers the thin ``opN_*`` queries over the standard tables.
"""
