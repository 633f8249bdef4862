"""Spark jobs that prepare language-model training corpora and evaluate models on them."""
