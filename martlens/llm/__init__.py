"""Training-data operators: search, tokenizers, near-duplicate removal, scoring, archives, mixing.

Each module is one operator with a general interface; ``queries.py`` holds the thin registered
queries. Nothing else in the library imports this subpackage.
"""
