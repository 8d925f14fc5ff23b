"""Spark-first bibliographic matching and ingestion; operators for training-data pipelines are in a subpackage of their own."""

from .functions.scoring import Weights, component_points, features, partial_scores, weighted
from .functions.similarity import jaro_winkler, token_sort_ratio
from .operators.blocking import candidate_pairs, postings
from .operators.matching import best, match, score_batch, staged
from .operators.output import match_rows, record_rows, staged_rows
from .operators.quality import retrieval, search_weights

__all__ = [
    "Weights", "best", "candidate_pairs", "component_points", "features", "jaro_winkler", "match", "match_rows", "partial_scores", "postings", "record_rows", "retrieval", "score_batch", "search_weights", "staged", "staged_rows",
    "token_sort_ratio", "weighted",
]
