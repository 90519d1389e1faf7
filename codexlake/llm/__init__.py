"""Operators for building training data: packing, piece segmentation, secret
scans, near-duplicates, toxicity, quality, URL rules, language-model scores,
media columns and exact code search.  Nothing outside this package imports it.
"""
