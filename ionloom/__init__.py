"""Peptide search as Spark jobs, and operators for training corpora."""
