"""Staged publication: write a candidate once, read it back, check it, then switch the table to it.

The candidate is written into new folders of the table.  Its fingerprint is observed while it is written, gates read
the written files, and one manifest file then makes them the live ones (see ``versions``): partitions are replaced
together or not at all, nothing is written twice, and readers never meet a folder that changes.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelyard.operators.gates import GateRefused, require_all
from panelyard.plans import versions as V
from panelyard.schemas import missing_to_null


@dataclass(frozen=True)
class Ends:
    """What is kept of every entity and partition beside the rows: first and last date, last value, number of rows."""

    entity: str
    date: str
    value: str

    def of(self, rows: DataFrame, partition: str) -> DataFrame:
        return rows.groupBy(self.entity, partition).agg(
            F.min(self.date).alias("first"), F.max(self.date).alias("last"),
            F.max_by(self.value, self.date).alias("last_value"), F.count(F.lit(1)).alias("rows"))


@dataclass(frozen=True)
class Table:
    """A stored table: where it lives, its key and its partition column (None for a small unpartitioned one).

    With ``ends`` every publication stores the ends of the entities in the partitions it writes.
    """

    path: str
    schema: T.StructType
    keys: Sequence[str]
    partition: str | None = None
    codec: str = "snappy"
    ends: Ends | None = None

    @property
    def full_schema(self) -> T.StructType:
        if self.partition and self.partition not in self.schema.names:
            return T.StructType([*self.schema.fields, T.StructField(self.partition, T.IntegerType())])
        return self.schema

    def manifest(self, spark: SparkSession) -> V.Manifest:
        """The live version: the newest manifest, or plain folders landed by others, or nothing."""
        return V.latest(spark, self.path) or V.landed(spark, self.path, self.partition) or V.Manifest()

    def read(self, spark: SparkSession, written: str | None = None) -> DataFrame:
        """The live version's rows; NaN reads as NULL, a table never written is empty.

        ``written`` adds a column of that name that orders rows by when they were written.
        """
        return missing_to_null(self._scan(spark, self.manifest(spark).data, self.full_schema, written))

    def _scan(self, spark: SparkSession, folders: dict[str, str], schema: T.StructType, written: str | None = None,
              ) -> DataFrame:
        """One scan of versioned folders and one of landed ones; partition filters prune both before files are listed."""
        out = None
        at = F.struct("_metadata.file_modification_time", "_metadata.file_name", "_metadata.row_index")
        for part in ("data/", "summary/", ""):
            paths = [f"{self.path}/{f}" for f in folders.values() if (f.startswith(part) if part else "/" not in f)]
            if paths:
                base = f"{self.path}/{part}".rstrip("/")
                rows = spark.read.schema(schema).option("basePath", base).parquet(*paths)
                rows = rows.select(*schema.names, *([at.alias(written)] if written else []))
                out = rows if out is None else out.unionByName(rows)
        if out is None:
            out = spark.createDataFrame([], schema)
            out = out.withColumn(written, F.lit(0)) if written else out
        return out

    def read_ends(self, spark: SparkSession) -> DataFrame:
        """Ends of every entity and partition, as stored; of partitions others landed, derived from their rows."""
        live = self.manifest(spark)
        schema = self.ends.of(spark.createDataFrame([], self.full_schema), self.partition).schema
        stored = self._scan(spark, live.summary, schema)
        landed = {k: f for k, f in live.data.items() if k not in live.summary}
        if not landed:
            return stored
        return stored.unionByName(self.ends.of(missing_to_null(self._scan(spark, landed, self.full_schema)), self.partition))

    def create(self, spark: SparkSession) -> None:
        """Make the empty table; an existing one is left alone."""
        if not V.latest(spark, self.path) and not V.landed(spark, self.path, self.partition):
            V.commit(spark, self.path, V.Manifest(V.next_number(spark, self.path)))


def _fingerprint(df: DataFrame, columns: Sequence[str]) -> list:
    """Row count and an order-free hash over values and NULL positions."""
    cells = [F.col(c) for c in columns]
    code = F.xxhash64(*cells, *[c.isNull() for c in cells])
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(code.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("code")]


def stage(df: DataFrame, table: Table, version: str) -> DataFrame:
    """Write the candidate into the table's folder of a version and return it read back; refuse when it differs.

    Rows are rebalanced by partition value (Spark splits an oversized year and joins tiny ones) and sorted by key
    inside each file, which keeps later key filters cheap.
    """
    spark = df.sparkSession
    columns = list(df.columns)
    path = f"{table.path}/data/{version}"
    by = [table.partition] if table.partition else []
    seen = Observation(f"stage-{version}")
    laid_out = df.hint("rebalance", *by).sortWithinPartitions(*by, *table.keys)
    writer = laid_out.observe(seen, *_fingerprint(laid_out, columns)).write.option("compression", table.codec)
    (writer.partitionBy(*by) if by else writer).parquet(path)
    back = spark.read.schema(df.schema).option("basePath", f"{table.path}/data").parquet(path).select(*columns)
    found = back.agg(*_fingerprint(back, columns)).first()
    wrote = seen.get
    if (found["rows"], found["code"]) != (wrote["rows"], wrote["code"]):
        raise GateRefused("staged_readback", {"wrote": str(wrote), "found": str(found)})
    return back


def _folders(spark: SparkSession, table: Table, part: str, version: str) -> dict[str, str]:
    """Partition folders that a version wrote."""
    if not table.partition:
        return {"": f"{part}/{version}"}
    written = V.names(spark, f"{table.path}/{part}/{version}")
    return {n: f"{part}/{version}/{n}" for n in written if n.startswith(f"{table.partition}=")}


def publish(candidate: DataFrame, table: Table, gates=(), partitions: Sequence | None = None) -> DataFrame:
    """Stage, run the gates on the staged rows, switch.  ``gates`` are (name, staged -> verdict).

    The partitions written take the place of the stored ones in one step, others stay.  ``partitions`` are the values
    the candidate stands for: one of them that has no row left is empty afterwards.  A refusal or a crash at any point
    leaves the version before as it was; so does another publication that was faster.  Returns the staged rows.
    """
    spark = candidate.sparkSession
    number = V.next_number(spark, table.path)       # taken before the version is read: whoever comes between is noticed
    before = table.manifest(spark)
    version = f"_version={number}-{uuid.uuid4().hex[:8]}"
    try:
        staged = stage(candidate, table, version)
        require_all([(name, gate(staged)) for name, gate in gates])
        ends = {}
        if table.ends:
            summary = table.ends.of(staged, table.partition).hint("rebalance", table.partition)
            summary.write.partitionBy(table.partition).parquet(f"{table.path}/summary/{version}")
            ends = _folders(spark, table, "summary", version)
        gone = [f"{table.partition}={v}" for v in partitions or ()]
        V.commit(spark, table.path, before.following(number, _folders(spark, table, "data", version), ends, gone))
    except Exception:
        for part in ("data", "summary"):
            V.delete(spark, f"{table.path}/{part}/{version}")
        raise
    return staged


def preview(candidate: DataFrame, gates=()) -> DataFrame:
    """The same path without the write: gates run, the lazy candidate is returned."""
    require_all([(name, gate(candidate)) for name, gate in gates])
    return candidate


def partition_values(rows: DataFrame, partition: str) -> list:
    """The partition values of some rows: as many as the table has partitions, at most."""
    return sorted(r[0] for r in rows.select(partition).distinct().collect() if r[0] is not None)


def pruned(table: DataFrame, partition: str, values: Sequence) -> DataFrame:
    """Stored rows of the named partitions; the filter is static, so other partitions' files are never listed."""
    return table.where(F.col(partition).isin(*values) if values else F.lit(False))


def touched(table: DataFrame, incoming: DataFrame, partition: str) -> DataFrame:
    """Stored rows of the partitions a feed touches."""
    return pruned(table, partition, partition_values(incoming, partition))


def upsert_state(state: Table, rows: DataFrame) -> None:
    """Replace a small side table; called only after the data was published."""
    publish(rows, state)


def append_log(log: DataFrame, entry: DataFrame) -> DataFrame:
    """Settlement log with one more entry; readers take the newest with ``keep_newest``.  An entry without changes is
    not logged."""
    changes = F.col("rows_added") + F.col("rows_replaced") + F.coalesce("rows_dropped", F.lit(0))
    return log.unionByName(entry.where(changes > 0), allowMissingColumns=True)


def set_boundary(boundary: DataFrame, year: int, through: DataFrame) -> DataFrame:
    """Boundary table with one year's official date set.  Ordinary saves never call this, so they cannot erase it."""
    row = through.select(F.lit(year).cast("int").alias("year"), "official_through")
    return boundary.where(F.col("year") != year).select("year", "official_through").unionByName(row)
