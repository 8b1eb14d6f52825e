"""Operators for preparing training corpora. Nothing outside this folder (but the pipeline and the entry file) uses them."""
