"""Operators for preparing training data: dedup, search, classifiers, secrets, mixing, packing and file formats."""
