"""Training-data operators: near-duplicate joins, dedup, classifiers, tokenizer, scans.

Nothing else in the library imports this subpackage.
"""
