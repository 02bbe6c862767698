"""The corpus pipeline: five stages over ``documents``, each working on all that its predecessor kept.

1. quality classifier: documents that importance resampling doesn't select go;
2. line dedup: lines similar to an earlier line go, and documents that had only such lines;
3. near-dedup: of each group of near-duplicates one document stays;
4. mixing: documents taken 0 times go, those taken twice or three times are repeated;
5. SentencePiece: the ids of every text, and the text that they decode to.

A stage's result is written as Parquet in the shared folder and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import dartminhash, importance, line_dedup, mixing, sentencepiece
from tessera.llm.queries import read
from tessera.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return importance.select_good(docs, read(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dartminhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, mixing.label_weights(docs, read(spark, sf_dir, "labels")))


def sentencepiece_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    content = sentencepiece.model_content(spark, sentencepiece.model_path(spark))
    return sentencepiece.encode(docs, content, passed=["lang", "source"])


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", sentencepiece_encode),
]

#: The first stage fits models that SQL cannot express; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage: ``doc_id, lang, source, ids, n_ids, round_trip, decoded``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir).select(*docs.columns), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
