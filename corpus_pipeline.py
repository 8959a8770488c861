"""From documents to packed token sequences, in five stages.

Each stage takes what the one before it kept. All but the last return the columns of
documents. Rows without an id, or with an id of other rows, are told apart by all their
columns, so each follows its own verdict.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.llm import exact, packing, quality, simhash, substring_tree
from logtide.llm.queries import vocabulary_path
from logtide.llm.shared import documents, stored, whole_text

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns of documents and `_key`: the id, or a number from the whole row where rows have none or share it.

    So every row follows its own verdict; rows alike in all columns are one. Such numbers
    come after all usual ids.
    """
    rows = docs.select(*COLUMNS)
    ids = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Stored, so that Spark knows how few they usually are and sends them to the rows.
    shared = stored(ids.select(F.col("doc_id").alias("_id"), F.lit(True).alias("_shared")), "shared-ids")
    hashed = F.shiftrightunsigned(F.xxhash64(*COLUMNS), 2)
    named = rows.join(shared, F.col("doc_id") == F.col("_id"), "left")
    key = F.when(F.col("doc_id").isNull() | F.col("_shared"), hashed + F.lit(1 << 62)).otherwise(F.col("doc_id"))
    return named.select(*COLUMNS, key.alias("_key"))


def _as_ids(keyed: DataFrame) -> DataFrame:
    """Rows under their keys, as operators take them."""
    return keyed.select(F.col("_key").alias("doc_id"), *COLUMNS[1:])


def _keep(keyed: DataFrame, verdicts: DataFrame, kept: Column) -> DataFrame:
    """The documents whose verdict, by their key, is to keep them."""
    keys = verdicts.filter(kept).select(F.col("doc_id").alias("_kept")).distinct()
    return keyed.join(keys, F.col("_key") == F.col("_kept"), "left_semi").select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule."""
    keyed = _keyed(docs)
    return _keep(keyed, quality.judge(_as_ids(keyed)), F.col("kept"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, repeated rows included."""
    kept = exact.exact_groups(docs).filter("kept").select(F.col("doc_id").alias("_kept"), "text_sha256").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.sha2(whole_text(), 256) == F.col("text_sha256"))
    return docs.select(*COLUMNS).join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"]).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near duplicates."""
    keyed = _keyed(docs)
    groups = simhash.near_groups(_as_ids(keyed))
    return _keep(keyed, groups, F.col("doc_id") == F.col("component_id"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 20 words that also start earlier.

    Texts that have none stay as they are; documents with no word left go.
    """
    cut = substring_tree.remove_repeats(docs, carry=["lang", "source", "n_chars"], as_is=True)
    left = cut.filter(F.col("n_words") > F.col("n_removed"))
    length = F.length("kept_text").cast(cut.schema["n_chars"].dataType)
    n_chars = F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars")).alias("n_chars")
    return left.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", n_chars)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens: one row per piece of a document."""
    return packing.pack(packing.token_pieces(docs, vocabulary_path()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Graph components and packing are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
