"""Operators for preparing training data: one module per operator, composed in ``corpus_pipeline``."""
