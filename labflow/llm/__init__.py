"""Operators for large training corpora: packing, filtering, deduplication, decontamination, extraction, token output."""
