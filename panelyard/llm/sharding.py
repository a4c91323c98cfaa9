"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelyard.session import materialise

RING_BITS = 12          # the ring is looked up in 2^12 equal sections
NODES = 128             # virtual nodes of a shard
CELL_ROWS = 5_000       # rows ranked together, on average


def ring(spark: SparkSession, shards: int, nodes: int = NODES) -> DataFrame:
    """Virtual nodes: ``(pos, shard)``, unique positions; its size is ``shards * nodes`` whatever the data."""
    return spark.range(shards).select(
        F.col("id").cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))).alias("node")).select(
        F.xxhash64(F.lit("ring"), "shard", "node").alias("pos"), "shard").groupBy("pos").agg(
        F.min("shard").alias("shard"))


def _sections(nodes: DataFrame) -> DataFrame:
    """For each section of the ring its nodes in order, then the first node after it (round the end)."""
    section = F.shiftright("pos", 64 - RING_BITS)
    inside = nodes.groupBy(section.alias("section")).agg(F.sort_array(F.collect_list("pos")).alias("inside"))
    first = nodes.agg(F.min("pos").alias("origin"))
    every = nodes.sparkSession.range(-(1 << RING_BITS - 1), 1 << RING_BITS - 1).select(F.col("id").alias("section"))
    after = F.min("low").over(Window.orderBy("section").rowsBetween(1, Window.unboundedFollowing))
    table = every.join(inside, "section", "left").withColumn("low", F.element_at("inside", 1))
    origin = first.first().origin
    return table.select("section", F.coalesce("inside", F.array().cast("array<bigint>")).alias("inside"),
                        F.coalesce(after, F.lit(origin)).alias("after"))


def _walk(arcs: DataFrame, total: int, shards: int, slack: float) -> DataFrame:
    """Clockwise walk over the arcs: who keeps how many of its own rows, and who takes the overflow.

    A full shard's surplus queues up and is taken, first in first out, by the next shards with room; a second turn
    places what queued past the end.  Returns pieces ``(arc, low, high, shard, slot)``: rows ranked ``low`` to
    ``high`` of an arc go to ``shard``, at slots from ``slot``.  All tables here have the size of the ring.
    """
    # without slack the capacities add up to the rows, so counts differ by one at most
    cap = [int((1 + slack) * total / shards) + 1 if slack else total // shards + (s < total % shards)
           for s in range(shards)]
    caps = F.array(*[F.lit(c).cast("long") for c in cap])
    lists = arcs.agg(F.sort_array(F.collect_list(F.struct("arc", "shard", "rows"))).alias("turn"))
    again = F.transform("turn", lambda a: F.struct(a.arc.alias("arc"), a.shard.alias("shard"),
                                                   F.lit(0).cast("long").alias("rows")))
    step_type = "array<struct<arc:bigint,shard:int,rows:bigint,kept:bigint,taken:bigint>>"
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("load"),
                     F.lit(0).cast("long").alias("queue"), F.array().cast(step_type).alias("steps"))

    def visit(state, node):
        room = F.get(caps, node.shard) - F.get(state.load, node.shard)
        kept = F.least(node.rows, room)
        taken = F.least(state.queue, room - kept)
        return F.struct(
            F.transform(state.load, lambda v, i: F.when(i == node.shard, v + kept + taken).otherwise(v)).alias("load"),
            (state.queue + node.rows - kept - taken).alias("queue"),
            F.concat(state.steps, F.array(F.struct(
                node.arc.alias("arc"), node.shard.alias("shard"), node.rows.alias("rows"), kept.alias("kept"),
                taken.alias("taken")))).cast(step_type).alias("steps"))

    steps = lists.select(F.posexplode(F.aggregate(F.concat("turn", again), start, visit).steps).alias("step", "s"))
    steps = materialise(steps.select("step", "s.*"), "walk")

    order = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    upto = lambda c: F.coalesce(F.sum(c).over(order), F.lit(0))
    over = steps.withColumn("over", F.col("rows") - F.col("kept"))
    out = over.where("over > 0").withColumn("at", upto("over"))
    into = steps.where("taken > 0").withColumn("at", upto("taken"))
    # both cut the queue into intervals; between two cuts both ends are the last ones seen
    cuts = out.select("at", "arc", F.col("kept").alias("low"), F.lit(None).cast("int").alias("shard")).unionByName(
        into.select("at", F.lit(None).cast("long").alias("arc"), F.lit(None).cast("long").alias("low"), "shard"))
    cuts = cuts.groupBy("at").agg(F.max("arc").alias("arc"), F.max("low").alias("low"), F.max("shard").alias("shard"))
    seen, nxt = Window.orderBy("at"), F.lead("at").over(Window.orderBy("at"))
    start_at = F.when(F.col("arc").isNotNull(), F.col("at"))
    moved = cuts.select(
        "at", F.coalesce(nxt, F.lit(out.agg(F.sum("over")).first()[0] or 0)).alias("end"),
        F.last("arc", True).over(seen).alias("arc"), F.last("low", True).over(seen).alias("base"),
        F.last(start_at, True).over(seen).alias("from"), F.last("shard", True).over(seen).alias("shard"))
    moved = moved.select("arc", (F.col("base") + F.col("at") - F.col("from")).alias("low"),
                         (F.col("base") + F.col("end") - F.col("from")).alias("high"), "shard")
    pieces = steps.where("kept > 0").select("arc", F.lit(0).cast("long").alias("low"), F.col("kept").alias("high"),
                                            "shard").unionByName(moved)
    slots = Window.partitionBy("shard").orderBy("arc", "low").rowsBetween(Window.unboundedPreceding, -1)
    return materialise(pieces.withColumn("slot", F.coalesce(F.sum(F.col("high") - F.col("low")).over(slots),
                                                            F.lit(0))), "pieces")


def ring_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", *, nodes: int = NODES,
                slack: float = 0.0, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, shard, slot``.

    A row belongs to the first virtual node clockwise from the hash of its key.  A shard holds at most
    ``(1 + slack) * rows / shards`` rows (without slack counts differ by one at most); rows beyond that continue
    clockwise to the next shard with room, so growing the ring moves the new shard's arcs and the overflow only.
    ``slot`` counts a shard's rows from 0 without gaps.  ``size`` is the UTF-8 length of the text plus 8 (null text:
    8, checksum of the empty text).  A null key has a hash of its own.  Rows equal in key, size and checksum are
    interchangeable and counted first, so even one key with most of the rows is split over many shards.

    Rows are ranked inside an arc in cells of about ``cell_rows``: cell sums give the offsets, so no task sorts an
    arc.  Everything else has the size of the ring (``shards * nodes``), which does not grow with the data.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    unit = docs.select(F.col(key).alias("doc_id"), (F.octet_length(body) + 8).cast("long").alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"))
    spark = docs.sparkSession
    virtual = materialise(ring(spark, shards, nodes), "ring")
    place = F.xxhash64(F.lit("key"), "doc_id")
    spread = F.xxhash64("doc_id", "size", "text_crc32")
    found = F.coalesce(F.get(F.filter("inside", lambda p: p >= F.col("pos")), 0), F.col("after"))
    units = unit.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    units = units.withColumn("pos", place).withColumn("section", F.shiftright("pos", 64 - RING_BITS)).join(
        F.broadcast(_sections(virtual)), "section").select("doc_id", "size", "text_crc32", "n", "pos",
                                                           found.alias("arc"))
    units = materialise(units, "units")
    distinct, total = units.agg(F.count(F.lit(1)), F.sum("n")).first()
    total = total or 0
    cells = max(1, round((distinct or 0) / (shards * nodes) / cell_rows))
    cell = F.pmod(spread, F.lit(cells))
    units = units.withColumn("cell", cell)

    sums = units.groupBy("arc", "cell").agg(F.sum("n").alias("rows"))
    arcs = virtual.select(F.col("pos").alias("arc"), "shard").join(
        sums.groupBy("arc").agg(F.sum("rows").alias("rows")), "arc", "left").select(
        "arc", "shard", F.coalesce("rows", F.lit(0)).alias("rows"))
    pieces = _walk(arcs, total, shards, slack)

    before = Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("arc", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("arc", "cell").orderBy("pos", "doc_id", "size", "text_crc32").rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = units.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(offsets, ["arc", "cell"])
    first = F.col("offset") + F.col("ahead")
    lists = pieces.groupBy("arc").agg(F.sort_array(F.collect_list(F.struct("low", "high", "shard", "slot")))
                                      .alias("pieces"))
    # the pieces a unit of n equal rows touches, each with the part of its rows that lies inside
    touched = F.filter("pieces", lambda p: (p.low < first + F.col("n")) & (p.high > first))
    parts = ranked.withColumn("first", first).join(F.broadcast(lists), "arc").withColumn("p", F.explode(touched))
    low, high = F.greatest("p.low", "first"), F.least("p.high", F.col("first") + F.col("n"))
    rows = parts.withColumn("rank", F.explode(F.sequence(low, high - 1)))
    return rows.select("doc_id", "size", "text_crc32", F.col("p.shard").alias("shard"),
                       (F.col("p.slot") + F.col("rank") - F.col("p.low")).alias("slot"))
