"""From raw documents to token ids: quality, near copies, the mix, encoding.

Each stage works on all rows its predecessor kept and, but for the last, returns
the columns of ``documents``. ``run`` applies the stages in order; every result
is written to the shared folder and read back.

Null texts count as empty ones in all stages: the classifier scores them by its
bias alone, near-dedup keeps one of them, the mix takes none of them as they have
no words. Rows without id are kept like others; of repeated rows near-dedup keeps
one. An empty table passes through as an empty one, columns beside those of
``documents`` are carried to the mix whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from groundshift.llm import mixing, pieces, quality, simhash
from groundshift.llm.scratch import columns, fresh, shipped, stored


@shipped
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    (score,) = fresh(docs, "quality_score")
    rows = quality.score(docs, model, docs.columns)
    return rows.where(F.col(score) >= quality.ACCEPT).select(*columns(docs))


@shipped
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash of three-word shingles, at most three bits apart."""
    return simhash.deduplicated(docs, radius=3, shingle=3)


@shipped
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in its order."""
    return mixing.mixed(docs, weights=(1, 2, 3), budget_share=1.0, epochs=3)


@shipped
def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, the N best scores and crc32s, and a digest of the text decoded from the ids."""
    found = pieces.encode(docs, public_tokenizers.path(pieces.MODEL), nbest=3, ids=True)
    return found.select("doc_id", "n_pieces", "score", "scores", "crcs", F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", one_of_each),
    ("mixing sources", mix_sources),
    ("SentencePiece", to_pieces),
]

#: A learned classifier and the lattice search are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-").lower())
    return docs
