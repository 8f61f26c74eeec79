"""Training-data operators: deduplication, search, scoring, tokenization, mixing, scans.

Nothing outside this subpackage imports it.  Each module holds one operator
with a general interface; ``queries`` registers one thin query per operator.
"""
