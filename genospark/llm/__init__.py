"""Operators for preparing language-model training data, one module per operator.

Nothing else in the library imports this subpackage.  ``queries`` registers one
query per operator; ``corpus_pipeline.py`` at the repository top chains five.
"""
