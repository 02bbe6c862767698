"""The recommender run: parse, ids, split, train, recommend, write, evaluate (R5)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import evaluate as EV
from tessera.operators import ratings as RT
from tessera.operators import recommend as RC
from tessera.operators import similarity as S
from tessera.session import materialize
from tessera.sinks.files import write_tsv

NUM_NEIGHBOURS = 50
SPLIT_SEED = 913


def run_recommender(lines: DataFrame, algorithm: str, similarity_method: str = "cosine",
                    recommend_method: str = "weighted-sum", num_recommendations: int = 30,
                    output_path: str | None = None, num_neighbours: int = NUM_NEIGHBOURS,
                    seed: int = SPLIT_SEED) -> DataFrame:
    """Metrics row ``tp, tp_fn, tp_fp, precision, recall, f1, coverage, popularity``.

    ``lines`` are ``user item clicks`` text lines, one for each user and item (repeated ones raise).  ``algorithm`` is ``sim``
    (item similarity + ``score`` / ``weighted-sum``) or ``als``
    (``user-product`` / ``product-user``).  With ``output_path``, the
    neighbour lists and the recommendations are written as tab-separated text
    under it (each folder replaced).  Ratings, neighbour lists and
    recommendations are each written once to the shared checkpoint folder,
    since several later steps read them.
    """
    parsed = RT.parse_ratings(lines).select("user", "item", F.col("clicks").cast("double").alias("rating"))
    rated = RT.require_unique(materialize(RT.with_user_id(parsed), "rated"))
    train, test = RT.train_test_split(rated, seed)
    if algorithm == "sim":
        nb = materialize(S.top_neighbours(S.similarity(train, similarity_method), num_neighbours), "neighbours")
        if output_path:
            write_tsv(nb.select("item", "neighbour", "weight"), os.path.join(output_path, "item_similarities"))
        users, recs = RC.recommend(recommend_method, nb, train, num_recommendations)
    elif algorithm == "als":
        users, recs = RC.recommend(recommend_method, None, train, num_recommendations)
    else:
        raise ValueError(f"unknown algorithm: {algorithm}")
    recs = materialize(recs, "recommendations")
    users = materialize(users, "rec-users")
    if output_path:
        write_tsv(recs.select("user_id", "item", "score"), os.path.join(output_path, "user_recommendations"))
    pr = EV.precision_recall(test, users, recs)
    cov = EV.coverage(train, recs).select("coverage").scalar()
    pop = EV.popularity(train, recs).select("popularity").scalar()
    return pr.select("*", cov.alias("coverage"), pop.alias("popularity"))
