"""Operators for building training data: deduplication, decontamination,
quality, personal data, language-model scores and token work.

Nothing outside this subpackage imports it.
"""
