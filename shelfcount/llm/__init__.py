"""Operators for preparing training data: one module per operator, named queries in ``queries``.

Every operator takes DataFrames and returns DataFrames. Tables follow the contract of ``documents``
(doc_id, text, ...); null texts count as empty, null ids are allowed, repeated rows are allowed, and columns
that an operator does not know are ignored or passed on unchanged.
"""
