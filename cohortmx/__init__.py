"""Grouped matrix analytics on PySpark.

Per-subject correlation and Fisher z, entrywise statistics over subjects,
ordered train/test splits, z-scoring, covariance, a low-rank factorisation
of the stacked rows and Frobenius distances, all as Spark DataFrame jobs.
"""

from .operators.correlate import corr_from_moments, corr_matrix, fisher_z
from .operators.covariance import cov_from_moments, cov_matrix, zscored_stack_cov
from .operators.factorise import Factors, factor_gram, factor_range, factor_rows, factorise, tall_r
from .operators.matrix import distance, frobenius, multiply, subtract, subtract_union, transpose
from .operators.moments import moments, pairwise_moments
from .operators.normalise import apply_zscore, column_params, column_stats, zscore, zscore_params
from .operators.summarise import (attach_split, entry_stats, rank_subjects, row_offsets, split_by_rank,
                                  split_by_threshold, subject_dim)

__all__ = [
    "Factors", "apply_zscore", "attach_split", "column_params", "column_stats", "corr_from_moments", "corr_matrix",
    "cov_from_moments", "cov_matrix", "distance", "entry_stats", "factor_gram", "factor_range", "factor_rows", "factorise",
    "fisher_z", "frobenius", "moments", "multiply", "pairwise_moments", "rank_subjects", "row_offsets", "split_by_rank",
    "split_by_threshold", "subject_dim", "subtract", "subtract_union", "tall_r", "transpose", "zscore",
    "zscore_params", "zscored_stack_cov",
]
