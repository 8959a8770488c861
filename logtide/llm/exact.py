"""Exact duplicates by a 128-bit hash, with bytes compared inside the groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.shared import stored, whole_text

RESULT = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
#: Rows of a group that are compared with one copy of the text that stays.
COMPARED = 256


def exact_groups(docs: DataFrame, digest: Column | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and the SHA-256 of its text.

    Documents with equal texts form a group, of which the largest doc_id stays; a null
    text counts as empty. Groups come from MD5 (or `digest`, an expression over `text`);
    each text of a group is compared with the one that stays, and groups in which texts
    differ are formed anew by their texts. A null id ranks below all others. Rows that
    repeat an id and its text are one document: each is marked alike and counted in
    `group_size`. No documents give no rows; other columns do not matter.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = rows.withColumn("hash", F.md5("text") if digest is None else digest)
    # Deals members of a group whatever their ids are: they may be null or alike.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    # Ids and counts are combined before the shuffle: a hot text is one row per task.
    size = [F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id")]
    groups = rows.groupBy("hash").agg(*size)
    mixed = stored(_mixed(rows, groups), "mixed")  # empty but for collisions
    light = rows.select("doc_id", "hash", F.sha2("text", 256).alias("text_sha256"))
    plain = light.join(groups, "hash").join(mixed, "hash", "left_anti")
    again = rows.join(mixed, "hash", "left_semi")
    by_text = again.groupBy("hash", "text").agg(*size)
    redone = again.join(by_text, ["hash", "text"]).withColumn("text_sha256", F.sha2("text", 256))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return (
        plain.select("doc_id", "keep_id", "group_size", "text_sha256")
        .unionByName(redone.select("doc_id", "keep_id", "group_size", "text_sha256"))
        .select("doc_id", "keep_id", "group_size", kept, "text_sha256")
    )


def _mixed(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Hashes shared by different texts.

    Members meet a copy of the text that stays. The copies are as many as a group's size
    asks for, so that a text of a third of all rows is compared by many tasks.
    """
    salts = F.ceil(F.col("group_size") / COMPARED).cast("int")
    members = rows.join(groups.filter("group_size > 1"), "hash")
    spread = members.withColumn("salt", F.pmod(F.xxhash64("row"), salts).cast("int"))
    stays = members.filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("hash", "group_size")
    copies = stays.agg(F.max("text").alias("keep_text")).select(
        "hash", "keep_text", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")
    )
    compared = spread.join(copies, ["hash", "salt"]).filter(F.col("text") != F.col("keep_text"))
    return compared.select("hash").distinct()
