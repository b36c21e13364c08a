"""Training-data operators: packing, quality rules, near-duplicate joins, language
identification, vector search, language-model scoring, license scans, BPE.

Nothing outside this package imports it; ``queries.py`` holds the registered queries.
"""
