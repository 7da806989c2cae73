"""Training-data operators: classifiers, scans, dedup, mixing, tokenising, search.

Nothing outside this subpackage imports it.
"""
