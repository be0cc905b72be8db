"""Operators of a training-data pipeline: chat repair, secret scan, decontamination, quality and
toxicity models, byte-level BPE, vector search, packed id files, line and near de-duplication.

Nothing else in the package imports this subpackage; it may be deleted as a whole.
"""
