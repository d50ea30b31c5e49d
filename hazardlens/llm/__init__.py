"""Operators for preparing language-model training corpora: DataFrame in, DataFrame out."""
