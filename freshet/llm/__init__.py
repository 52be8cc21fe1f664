"""Operators for preparing large text corpora for language-model training.

Nothing else in the package imports this subpackage; it can be removed as a whole.
"""
