"""Operators for text corpora that language models are trained on."""
