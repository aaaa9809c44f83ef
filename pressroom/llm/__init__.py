"""Operators of a training-data pipeline (mixing, tokenising, de-duplication, extraction, language ID).

Nothing else in the package imports this subpackage.
"""
