"""Exact duplicates by progressive refinement: length, then a hash of the first characters, then the full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.session import materialise

HEAD_CHARS = 256
#: Surviving (length, head) keys are broadcast only while there are at most this many (about 16 bytes each).
BROADCAST_KEYS = 250_000


def exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", *, head_chars: int = HEAD_CHARS,
                 broadcast_keys: int = BROADCAST_KEYS, hash_all: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical; a null text counts as empty.  Of equal texts the row with the largest key stays.
    A null key loses against any other and stays only where no row of the group has one.  Rows that repeat both text
    and key cannot be told apart: all are returned, exactly one of them stays.  ``text_sha256`` is null for texts that
    a cheaper level proved unique, unless ``hash_all``.

    Levels: lengths that occur once are settled by a count; of the rest, (length, hash of the first characters) that
    occur once are settled too; only what is left is hashed in full.  Text never enters a shuffle: surviving keys are
    broadcast after their number was checked; beyond the bound every text is hashed where it is read and the hashes
    are joined to the keys by shuffle, with the same result.  Large
    groups are counted on the map side, and the decisions are joined to written rows, so a hot group can be split.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), body.alias("body"), F.octet_length(body).alias("len"),
                       F.xxhash64(F.substring(body, 1, head_chars)).alias("head"))
    lengths = materialise(rows.groupBy("len").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("len"),
                          "lengths")
    heads = materialise(rows.join(lengths, "len", "left_semi").groupBy("len", "head")
                        .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("len", "head"), "heads")
    full = F.sha2("body", 256)
    slim = ["doc_id", "len", "hit", F.when(F.lit(hash_all) | F.col("hit"), F.col("text_sha256")).alias("text_sha256")]
    marks = heads.withColumn("hit", F.lit(True))
    hit = F.coalesce("hit", F.lit(False))
    if heads.count() <= broadcast_keys:
        marked = rows.join(F.broadcast(marks), ["len", "head"], "left").withColumn("hit", hit)
        hashed = marked.withColumn("text_sha256", full if hash_all else F.when(F.col("hit"), full)).select(*slim)
    else:
        # hashing a text where it is read costs less than sending it to its key; only the hashes are joined
        hashed = rows.select("doc_id", "len", "head", full.alias("text_sha256")).join(marks, ["len", "head"], "left") \
            .withColumn("hit", hit).select(*slim)
    hashed = materialise(hashed, "hashed")

    alone = hashed.where(~F.col("hit")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    counted = materialise(hashed.where("hit").groupBy("len", "text_sha256", "doc_id")
                          .agg(F.count(F.lit(1)).alias("n")), "counted")
    groups = materialise(counted.groupBy("len", "text_sha256").agg(
        F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size")), "groups")
    decided = counted.join(groups, ["len", "text_sha256"]).withColumn("copy", F.explode(F.sequence(F.lit(1), "n")))
    decided = decided.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id"))
                                                                 & (F.col("copy") == 1)).alias("kept"), "text_sha256")
    return alone.unionByName(decided)
