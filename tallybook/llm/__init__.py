"""Operators for large text corpora: cleaning, near copies, scoring, packing, archives."""
