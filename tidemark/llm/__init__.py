"""Preparation of text corpora for training: quality, duplicates, packing, tokens and scoring.

Nothing else in the library imports this subpackage.
"""
