"""Operators for large training-data pipelines, one module per operator.

Each module documents its method, its results on nulls, empty and repeated
rows, and what bounds its memory. :mod:`bizlens.llm.queries` registers one
query per operator; ``corpus_pipeline.py`` at the repository top chains five
of them. Nothing outside this package imports it.
"""
