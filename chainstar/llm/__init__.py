"""Operators of a training-data pipeline: quality rules, packing, SimHash
near-duplicates, HTML extraction, personal data, chat formatting, toxicity,
SentencePiece, token files and exact deduplication.

Nothing else in the library imports this subpackage; ``queries.py`` registers
its queries.
"""
