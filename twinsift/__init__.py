"""twinsift: record deduplication as Spark DataFrame plans.

Pipeline: combined text per row -> k most similar other rows (exact tiled
kNN, sparse token cosine, BM25, rank fusion, LSH) -> score statistics and a
threshold sweep -> a cleaned table without the greater key of every pair at
or above a per-table threshold.
"""

from twinsift.config import EntitySpec, JobParams, DEFAULT_THRESHOLDS

__all__ = ["EntitySpec", "JobParams", "DEFAULT_THRESHOLDS"]
