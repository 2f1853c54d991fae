"""Veil: personal-data erasure and versioned-cell tables on PySpark."""
