"""Quire: document-structure and corpus jobs as PySpark DataFrame programs."""
