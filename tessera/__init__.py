"""tessera: analytics operators on PySpark DataFrames and Structured Streaming.

The main entry points, re-exported; see the submodules for the rest.
"""

from tessera.operators.common import dense_number, minmax, next_in_group, top_k, zscore
from tessera.operators.evaluate import coverage, matrix_mae, popularity, precision_recall
from tessera.operators.fit import kmeans, logistic_gd, sample_k
from tessera.operators.graph import pagerank, personalized_pagerank
from tessera.operators.logs import errors_per_minute, parse_log_lines, parse_tab_logs
from tessera.operators.ratings import parse_ratings, train_test_split, with_user_id
from tessera.operators.recommend import recommend, recommend_score, recommend_weighted_sum
from tessera.operators.similarity import item_similarity, similarity, top_neighbours
from tessera.operators.text import word_count
from tessera.plans.recommender import run_recommender
from tessera.session import build_session, materialize
from tessera.sources.jdbc import jdbc_scan, jdbc_upsert, register_view
from tessera.sources.text import read_edges, read_lines

__all__ = [
    "build_session", "materialize", "read_lines", "read_edges", "jdbc_scan", "jdbc_upsert", "register_view",
    "word_count", "parse_tab_logs", "parse_log_lines", "errors_per_minute",
    "parse_ratings", "with_user_id", "train_test_split", "dense_number", "next_in_group", "zscore", "minmax",
    "top_k", "similarity", "item_similarity", "top_neighbours", "recommend", "recommend_score",
    "recommend_weighted_sum", "precision_recall", "coverage", "popularity", "matrix_mae", "run_recommender",
    "pagerank", "personalized_pagerank", "kmeans", "logistic_gd", "sample_k",
]
