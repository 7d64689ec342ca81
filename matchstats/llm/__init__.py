"""Operators for training-data pipelines (archives, licences, tokens, packing,
personal data, deduplication, decontamination, quality, toxicity).

Nothing outside this subpackage imports it, except the guarded registration
in ``__spark_entry__.py``.
"""
