"""Operators for building training corpora: one module per operator, all on plain DataFrames."""
