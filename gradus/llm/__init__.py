"""Operators for preparing language-model training text.

Documents are rows with ``doc_id`` (long) and ``text``; other columns are carried or ignored.
"""
