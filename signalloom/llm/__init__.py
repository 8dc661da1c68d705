"""Operators for preparing training corpora; see README, "Corpus operators"."""
