"""Mixing sources to target weights with nested hash thresholds found from histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelyard.session import materialise

#: White space of the word definition (space and tab to carriage return); a word is a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the selection hash that each histogram level resolves: 63 in all, so the last level is exact.
LEVELS = (12, 12, 12, 12, 15)


def word_count(text: Column) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``sources(source, source_size)`` with ``target``.

    Sources in code point order, null last, weigh ``weights`` in turn and share the whole size.  A target above
    ``most`` times its source's size stops there and the excess is shared again by weight until none is above.
    Sources without words get 0.  The result has one row per source; numbering it is one ordered pass.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    number = (F.row_number().over(order) - 1) % len(weights)
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), number + 1)
    table = materialise(sizes.withColumn("weight", pick), "weights")
    level, full = 0.0, -1
    limit = F.lit(most) * F.col("source_size")
    while True:
        stopped = limit <= F.col("weight") * F.lit(level)
        total, held, free, count = table.agg(
            F.sum("source_size"), F.sum(F.when(stopped, limit)), F.sum(F.when(~stopped, F.col("weight"))),
            F.count(F.when(stopped, 1))).first()
        if count == full or not free:
            break
        level, full = max(level, ((total or 0) - (held or 0.0)) / free), count
    return table.select("source", "source_size", F.least(limit, F.col("weight") * F.lit(level)).alias("target"))


def _budgets(rows: DataFrame, targets: DataFrame, cut: bool) -> DataFrame:
    """Per source: ``whole`` copies of everything and the ``bound`` below which a hash gets one copy more.

    Level by level: sums by hash prefix inside the interval still open, a running sum over at most 2^15 prefixes of a
    source, and the one prefix that crosses the budget is opened further.  At the last level the document at the
    bound gives the ``share`` of its words that is still missing (``cut``), or is taken when that brings the sum
    nearer to the budget.
    """
    open_ = materialise(targets.select(
        "source", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        .cast("long").alias("whole"), "source_size", "target"), "targets")
    open_ = open_.select("source", "whole", (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"),
                         F.lit(0).cast("long").alias("prefix"))
    left = 63
    for bits in LEVELS:
        inner = rows if left == 63 else rows.join(
            open_.select(F.col("source").alias("s"), "prefix"),
            F.col("s").eqNullSafe(F.col("source")) & (F.col("prefix") == F.shiftrightunsigned("pick", left)), "left_semi")
        left -= bits
        cells = inner.groupBy("source", F.shiftrightunsigned("pick", left).alias("cell")).agg(F.sum("size").alias("n"))
        running = F.sum("n").over(Window.partitionBy("source").orderBy("cell"))
        cells = cells.withColumn("upto", running)
        near = F.col("n") if left or cut else F.col("n") / 2
        joined = open_.alias("o").join(cells.alias("c"), F.expr(
            "o.source <=> c.source" + ("" if left == 63 - bits else f" and shiftrightunsigned(c.cell, {bits}) = o.prefix")),
            "left").select("o.source", "o.whole", "o.rest", "o.prefix", "c.cell", "c.n", "c.upto")
        # A cell is closed (taken whole) while its running sum fits; the first that does not fit is opened.
        fits = F.col("upto") - F.col("n") + near <= F.col("rest")
        open_ = materialise(joined.groupBy("source", "whole", "rest", "prefix").agg(
            F.max(F.when(fits, F.col("upto"))).alias("taken"),
            F.min_by("n", F.when(~fits, F.col("cell"))).alias("crossing"),
            F.min(F.when(~fits, F.col("cell"))).alias("first")).select(
            "source", "whole", (F.col("rest") - F.coalesce("taken", F.lit(0))).alias("rest"), "crossing",
            # nothing left to open: everything of this interval is taken, so the bound is its end
            F.coalesce("first", F.shiftleft(F.col("prefix") + 1, bits)).alias("prefix")), "budget")
    share = F.coalesce(F.col("rest") / F.col("crossing"), F.lit(0.0)) if cut else F.lit(0.0)
    return open_.select("source", "whole", F.col("prefix").alias("bound"), share.alias("share"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", *,
        weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, cut: bool = True,
        carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, size, source, source_size, target, copies, taken`` and the ``carry`` columns.

    ``copies`` says how often the mix takes the whole document.  A source gets every document
    ``floor(target / source_size)`` times and those whose hash lies below the source's bound once more, so a smaller
    budget always takes a subset.  The document at the bound gives its first words only (``cut``): ``taken`` is then
    ``copies * size`` and those words, and a source's sum meets its target to within a word.  Without ``cut`` only
    whole documents are taken and the sum comes within half of the document at the bound.

    The hash covers key, source and text, so reruns agree and null or repeated keys spread; rows equal in all three
    share one decision.  Texts without words have size 0 and are taken 0 words.  Hot sources cost no more than
    others: only map-side sums by (source, prefix) are shuffled and nothing is sorted.
    """
    pick = F.shiftrightunsigned(F.xxhash64(F.col(key), F.col(source), F.col(text)), 1)
    rows = docs.select(F.col(key).alias("doc_id"), word_count(F.col(text)).alias("size"),
                       F.col(source).alias("source"), pick.alias("pick"),
                       *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)])
    slim = materialise(rows.drop(*[f"carry_{i}" for i in range(len(carry))]), "sizes")
    targets = materialise(source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights,
                                         most), "shares")
    plan = targets.join(_budgets(slim, targets, cut).withColumnRenamed("source", "s"),
                        F.col("source").eqNullSafe(F.col("s"))).drop("s")
    plan = materialise(plan.withColumnRenamed("source", "s"), "plan")
    took = (rows if carry else slim).join(plan, F.col("s").eqNullSafe(F.col("source")), "left")
    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(
        F.col("whole") + F.when(F.col("pick") < F.col("bound"), 1).otherwise(0)).cast("long")
    part = F.when(F.col("pick") == F.col("bound"), F.floor(F.col("share") * F.col("size") + 1e-6)).otherwise(0)
    return took.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"),
                       (copies * F.col("size") + part).cast("long").alias("taken"),
                       *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)])

