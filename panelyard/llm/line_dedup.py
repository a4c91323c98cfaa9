"""Line deduplication across documents by a deletion-neighbourhood join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.session import materialise

LEAST_WORDS = 3         # shorter lines are never removed
NEAR_WORDS = 8          # lines of at least so many words are also matched within one edit
BATCH_ROWS = 1 << 19
#: Lines whose words are fetched from the documents are broadcast (about 20 bytes each) only up to this number.
BROADCAST_LINES = 250_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# ---- one line


def halves(words: list[bytes]) -> list[int]:
    """Hashes of the halves that a line within one edit shares with this one.

    Of two lines at most one word apart, cut where the shorter one has its middle, the first halves or the second
    halves are equal.  A line is cut for its own length and, as the longer one, for a length less.
    """
    n, out = len(words), []
    for length in (n, n - 1):
        cut = length // 2
        out.append(xxhash.xxh64_intdigest(b" ".join(words[:cut]), 2 * length))
        out.append(xxhash.xxh64_intdigest(b" ".join(words[n - (length - cut):]), 2 * length + 1))
    return out


def variants(words: list[bytes]) -> tuple[np.ndarray, int]:
    """Hashes of the line without each of its words, in order, and of the whole line.

    The hash is a polynomial over word hashes, so all deletions together cost as much as one pass over the line.
    """
    h = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.r_[np.uint64(1), np.full(len(h) - 1, _BASE)], dtype=np.uint64)
        upto = np.r_[np.uint64(0), np.cumsum(h * powers, dtype=np.uint64)]
        return upto[:-1] + (upto[-1] - upto[1:]) * _INVERSE, int(upto[-1])


def one_edit(a: list[bytes], b: list[bytes]) -> bool:
    """Whether one word put in, left out or replaced, or none, turns one line into the other."""
    if abs(len(a) - len(b)) > 1:
        return False
    front = 0
    while front < min(len(a), len(b)) and a[front] == b[front]:
        front += 1
    skip_a, skip_b = (1, 1) if len(a) == len(b) else (1, 0) if len(a) > len(b) else (0, 1)
    return a[front + skip_a:] == b[front + skip_b:]


# ---- passes over the documents


def _lines_of(least: int, near: int):
    signed = lambda v: v - (1 << 64) if v >> 63 else v

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers, keys, cuts, repeats = [], [], [], [], []
            for row, text in enumerate(batch.column(2)):
                seen = set()
                for number, line in enumerate((text.as_py() or b"").split(b"\n")):
                    words = line.split()
                    if len(words) < least:
                        continue
                    key = xxhash.xxh3_128_digest(b" ".join(words))
                    rows.append(row), numbers.append(number), keys.append(key), repeats.append(key in seen)
                    cuts.append([signed(h) for h in halves(words)] if len(words) >= near and key not in seen else [])
                    seen.add(key)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(numbers, pa.int32()), pa.array(keys, pa.binary()),
                 pa.array(repeats, pa.bool_()), pa.array(cuts, pa.list_(pa.int64()))],
                ["doc_id", "mark", "line", "key", "repeated", "halves"])

    return run


def _variants_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(variant, place, order of the line): ``place`` is the deleted word's, or -1 for the whole line."""
    def packed(parts: list) -> pa.RecordBatch:
        variant, place, owner = (np.concatenate(p) for p in zip(*parts))
        return pa.RecordBatch.from_arrays([pa.array(variant.view(np.int64)), pa.array(place), pa.array(owner)],
                                          ["variant", "place", "owner"])

    for batch in batches:
        parts, size = [], 0
        for owner, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            less, whole = variants(text.as_py().split())
            parts.append((np.r_[less, np.uint64(whole)], np.r_[np.arange(len(less), dtype=np.int32), np.int32(-1)],
                          np.full(len(less) + 1, owner, np.int64)))
            size += len(less) + 1
            if size >= BATCH_ROWS:
                yield packed(parts)
                parts, size = [], 0
        if parts:
            yield packed(parts)


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by variant, place, owner: links (later, earlier), each line to the earliest of its group.

    Lines equal but for the word at one place form a group; so do a whole line and the lines that become it by one
    deletion.  Only the groups' first owners are carried from row to row, so a group of any size streams through.
    """
    variant = place = whole = first = least = None
    for batch in batches:
        later, earlier = [], []
        for v, p, owner in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if v != variant:
                variant, place, whole, least = v, None, None, None
            if p != place:
                place, first = p, owner
            elif owner != first:
                later.append(owner), earlier.append(first)
            if p == -1:
                whole = owner if whole is None else whole
            elif whole is not None and owner != whole:
                if owner > whole:
                    later.append(owner), earlier.append(whole)
                elif least is None or owner < least:
                    least = owner
                    later.append(whole), earlier.append(owner)
        yield pa.RecordBatch.from_arrays([pa.array(later, pa.int64()), pa.array(earlier, pa.int64())],
                                         ["later", "earlier"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = [one_edit(a.as_py().split(), b.as_py().split()) for a, b in zip(batch.column(1), batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good, pa.bool_()))], ["later"])


def duplicate_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", *, least_words: int = LEAST_WORDS,
                    near_words: int = NEAR_WORDS) -> DataFrame:
    """``doc_id, mark, line``: the lines (numbered from 0) of the documents that an earlier line makes superfluous.

    Lines are split at line feeds and compared by their words (between ASCII white space).  A line goes if an earlier
    one, by document key (null last), ``mark`` and line number, has the same words, or, from ``near_words`` words on, is one
    word inserted, deleted or replaced away.  Lines of fewer than ``least_words`` words stay.  Null texts have no
    lines.  ``mark`` is a hash of the text, so rows that share a key but not the text are told apart; rows equal in
    both share their decisions.

    Equal lines are one class (a 128-bit hash) before anything else happens.  A class can only have a neighbour if it
    shares one of its halves with another class, so the deletion neighbourhood is emitted for those alone; equal
    variants meet by a shuffle on their hash and are linked to the earliest, never pairwise; each link is confirmed
    on the words themselves.
    """
    slim = docs.select(F.col(key).cast("long").alias("doc_id"), _mark(text).alias("mark"),
                       F.col(text).cast("binary").alias("body"))
    lines = materialise(slim.mapInArrow(_lines_of(least_words, near_words),
                                        "doc_id long, mark long, line int, key binary, repeated boolean, halves array<long>"),
                        "lines")
    once = lines.where("not repeated")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark", "line")
    first = F.min(F.struct(place.alias("at"), "halves"))     # the halves ride along; equal lines have the same
    classes = materialise(once.groupBy("key").agg(first.alias("first")).select(
        F.monotonically_increasing_id().alias("cid"), "key", "first.at", "first.halves"), "classes")

    parts = classes.select("cid", F.explode("halves").alias("half"))
    # a line of any length may have the same half twice; that is no second line
    shared = materialise(parts.groupBy("half").agg(F.min("cid").alias("a"), F.max("cid").alias("b"))
                         .where("a < b").select("half"), "shared")
    suspects = parts.join(shared, "half", "left_semi").select("cid").distinct().join(
        classes.drop("halves"), "cid")
    # an order by first place that one number can carry: rows are numbered within sorted ranges
    suspects = materialise(suspects.repartitionByRange("at").sortWithinPartitions("at").select(
        F.monotonically_increasing_id().alias("owner"), "key", "at"), "suspects")

    wanted = suspects.groupBy(F.col("at.doc_id").alias("d"), F.col("at.mark").alias("m")).agg(
        F.collect_list(F.struct("at.line", "owner")).alias("wanted"))
    if suspects.count() <= BROADCAST_LINES:
        wanted = F.broadcast(wanted)
    bodies = slim.join(wanted, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("m") == F.col("mark"))).select(
        F.split(F.col("body").cast("string"), "\n").alias("all"), "wanted").select(F.explode(F.transform(
            "wanted", lambda w: F.struct(w.owner.alias("owner"), F.get("all", w.line).cast("binary").alias("body"))))
        .alias("w")).select("w.owner", "w.body")
    bodies = materialise(bodies.dropDuplicates(["owner"]), "bodies")    # rows equal in key and text bring it twice

    spread = bodies.mapInArrow(_variants_of, "variant long, place int, owner long")
    links = materialise(spread.repartition("variant").sortWithinPartitions("variant", "place", "owner").mapInArrow(
        _matches, "later long, earlier long").distinct(), "links")
    pairs = links.join(bodies.select(F.col("owner").alias("later"), F.col("body").alias("a")), "later").join(
        bodies.select(F.col("owner").alias("earlier"), F.col("body").alias("b")), "earlier").select("later", "a", "b")
    near = materialise(pairs.mapInArrow(_confirmed, "later long").distinct(), "near")
    gone = suspects.join(near, F.col("owner") == F.col("later"), "left_semi").select("key", F.lit(True).alias("gone"))

    labels = materialise(classes.join(gone, "key", "left").select(
        "key", "at", F.coalesce("gone", F.lit(False)).alias("gone")), "labels")
    drops = once.join(labels, "key").where(F.col("gone") | (place != F.col("at"))).select("doc_id", "mark", "line")
    return drops.unionByName(lines.where("repeated").select("doc_id", "mark", "line")).distinct()


def _mark(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("binary"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", *, least_words: int = LEAST_WORDS,
                near_words: int = NEAR_WORDS) -> DataFrame:
    """Every document with its superfluous lines left out of ``text``, and ``n_lines``, ``n_removed`` added.

    Existing columns of those names are replaced.  A null text stays null and has no lines.  The remaining lines keep
    their order; the text is otherwise unchanged.
    """
    drops = duplicate_lines(docs, key, text, least_words=least_words, near_words=near_words)
    drops = materialise(drops.groupBy(F.col("doc_id").alias("drop_key"), F.col("mark").alias("drop_mark")).agg(
        F.collect_set("line").alias("drop_lines")), "drops")
    # the decisions grow with the documents, so they are never broadcast
    rows = docs.drop("n_lines", "n_removed").join(drops.hint("merge"), F.col(key).eqNullSafe(F.col("drop_key")) & (
        F.col("drop_mark") == _mark(text)), "left")
    lines = F.split(F.col(text), "\n")
    count = F.coalesce(F.when(F.length(text) == 0, 0).otherwise(F.size(lines)), F.lit(0))
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.array_except(numbers, "drop_lines")
    left = F.when(F.col("drop_lines").isNull(), F.col(text)).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    removed = F.when(F.col("drop_lines").isNull(), 0).otherwise(F.size(lines) - F.size(kept))
    return rows.withColumn("n_lines", count.cast("long")).withColumn(
        "n_removed", F.coalesce(removed, F.lit(0)).cast("long")).withColumn(text, left).drop("drop_key", "drop_mark", "drop_lines")
