"""Structured Streaming form of T1: subject files mapped to their F matrices
as they arrive (see :mod:`cohortmx.streaming.subjects`)."""
