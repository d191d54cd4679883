"""Operators: moments, correlation, summaries, normalisation, covariance, matrices, factorisation."""
