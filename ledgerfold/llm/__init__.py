"""Operators over a text corpus: quality, tokens, duplicates, licences, personal data, mixing."""
