"""Keyed merge policies: which value wins when a key arrives twice.

Keep-one rules are ``row_number() = 1`` windows.  Spark plans a group limit below the shuffle for that shape, so
a key holding a large share of the rows is cut to one row per input partition before anything moves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelyard.functions import finite, strip_blank
from panelyard.schemas import value_columns

INCOMING = "incoming"                          # incoming wins, even when NULL
KEEP_IF_NULL = "keep_if_null"                  # stored value survives a NULL
KEEP_IF_NULL_OR_ZERO = "keep_if_null_or_zero"  # stored value survives a NULL or a 0
KEEP_VALID = "keep_valid"                      # stored value survives a NULL when it is finite and >= 0
STORED_FIRST = "stored_first"                  # stored value wins whenever it exists

# Columns of the KR bar table whose stored value outlives an unobserved one.
KR_POLICY = {
    "Name": KEEP_IF_NULL, "Dept": KEEP_IF_NULL, "ChangeCode": KEEP_IF_NULL, "Market": KEEP_IF_NULL,
    "MarketId": KEEP_IF_NULL, "Marcap": KEEP_IF_NULL_OR_ZERO, "Stocks": KEEP_IF_NULL_OR_ZERO,
    "Rank": KEEP_IF_NULL_OR_ZERO, "Amount": KEEP_IF_NULL,
}
KR_POLICY_PRICES_ONLY = {**KR_POLICY, "Amount": STORED_FIRST}


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order (give a total order for a deterministic choice)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _stack(sources: Sequence[DataFrame]) -> DataFrame:
    """Union by name, numbering the sources 0, 1, ... in ``_src``."""
    out = sources[0].withColumn("_src", F.lit(0))
    for n, df in enumerate(sources[1:], start=1):
        out = out.unionByName(df.withColumn("_src", F.lit(n)), allowMissingColumns=True)
    return out


def merge_last(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], seq: str | None = None) -> DataFrame:
    """Last writer wins: one row per key, incoming NULLs overwrite.  ``seq`` orders repeated keys in the feed."""
    order = [F.col("_src").desc()] + ([F.col(seq).desc_nulls_last()] if seq else [])
    return keep_one(_stack([existing, incoming]), keys, order).drop("_src")


def first_source(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Source priority: a key is taken from the first source that has it."""
    return keep_one(_stack(sources), keys, [F.col("_src").asc()]).drop("_src")


def dedup_feed(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the last row of each key in a feed; ``order`` is the arrival order, oldest first."""
    return keep_one(df, keys, [c.desc_nulls_last() for c in order])


def merge_coalesce(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union of keys and columns; per cell the incoming value wins when it is present."""
    keys = list(keys)
    columns = value_columns(incoming, keys) + [c for c in value_columns(existing, keys) if c not in incoming.columns]
    old, new = existing.alias("old"), incoming.alias("new")

    def cell(name: str) -> Column:
        sides = [F.col(f"{s}.{name}") for s, df in (("new", incoming), ("old", existing)) if name in df.columns]
        return F.coalesce(*sides).alias(name)

    return old.join(new, keys, "full").select(*keys, *[cell(c) for c in columns])


def resolve(policy: str, new: Column, old: Column) -> Column:
    """The value one policy stores for a key present on both sides."""
    if policy == INCOMING:
        return new
    if policy == KEEP_IF_NULL:
        return F.coalesce(new, old)
    if policy == KEEP_IF_NULL_OR_ZERO:
        return F.when(new.isNull() | (new == 0), old).otherwise(new)
    if policy == KEEP_VALID:
        return F.coalesce(new, F.when(finite(old) & (old >= 0), old))
    if policy == STORED_FIRST:
        return F.coalesce(old, new)
    raise ValueError(f"unknown merge policy: {policy}")


def merge_policy(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], policy: Mapping[str, str], seq: str | None = None
) -> DataFrame:
    """Column-wise merge in one full join: ``policy`` names the columns that may keep a stored value.

    A column only the feed knows passes through; a protected column the feed lacks keeps its stored value.
    Both sides must be unique per key; pass ``seq`` to keep the last of repeated incoming keys first.
    """
    keys = list(keys)
    if seq:
        incoming = dedup_feed(incoming, keys, [F.col(seq)]).drop(seq)
    known_new, known_old = set(incoming.columns), set(existing.columns)
    columns = value_columns(existing, keys) + [c for c in value_columns(incoming, keys) if c not in known_old]
    old = existing.withColumn("_stored", F.lit(True)).alias("old")
    new = incoming.withColumn("_fed", F.lit(True)).alias("new")

    def cell(name: str) -> Column:
        dtype = (existing if name in known_old else incoming).schema[name].dataType
        stored = F.col(f"old.{name}") if name in known_old else F.lit(None).cast(dtype)
        fed = F.col(f"new.{name}").cast(dtype) if name in known_new else F.lit(None).cast(dtype)
        both = F.col("new._fed") & F.col("old._stored")
        merged = resolve(policy.get(name, INCOMING), fed, stored)
        return F.when(both, merged).when(F.col("new._fed"), fed).otherwise(stored).alias(name)

    return old.join(new, keys, "full").select(*keys, *[cell(c) for c in columns])


def preserve_measure(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Fill a missing incoming measure from the stored row of the same key; an explicit 0 is a value."""
    keys = list(keys)
    dtype = existing.schema[measure].dataType
    feed = incoming if measure in incoming.columns else incoming.withColumn(measure, F.lit(None).cast(dtype))
    stored = existing.select(*keys, F.col(measure).alias("_stored"))
    filled = resolve(KEEP_VALID, F.col(measure), F.col("_stored")).alias(measure)
    return feed.join(stored, keys, "left").select(*[filled if c == measure else F.col(c) for c in feed.columns])


def _entity_key(c: Column) -> Column:
    return F.upper(strip_blank(c.cast("string")))


def drop_entities(df: DataFrame, targets: DataFrame, entity: str) -> DataFrame:
    """Rows of entities not named in ``targets`` (matched without case or surrounding blanks)."""
    named = targets.select(_entity_key(F.col(entity)).alias("_entity")).distinct()
    return (df.withColumn("_entity", _entity_key(F.col(entity))).join(named, "_entity", "left_anti")
            .select(*df.columns))


def only_entities(df: DataFrame, targets: DataFrame, entity: str) -> DataFrame:
    """Rows of entities named in ``targets`` (matched the same way)."""
    named = targets.select(_entity_key(F.col(entity)).alias("_entity")).distinct()
    return (df.withColumn("_entity", _entity_key(F.col(entity))).join(named, "_entity", "left_semi")
            .select(*df.columns))


def replace_entities(
    existing: DataFrame, incoming: DataFrame, targets: DataFrame, keys: Sequence[str], entity: str,
    measure: str | None = None, seq: str | None = None,
) -> DataFrame:
    """Drop every stored row of the targets, then merge: purged values cannot come back through a merge."""
    kept = drop_entities(existing, targets, entity)
    feed = preserve_measure(kept, incoming, keys, measure) if measure else incoming
    return merge_last(kept, feed, keys, seq)


def latest_by(sources: Sequence[DataFrame], keys: Sequence[str], stamp: str) -> DataFrame:
    """The newest observation per key; on equal stamps the later source wins."""
    order = [F.col(stamp).desc_nulls_last(), F.col("_src").desc()]
    return keep_one(_stack(sources), keys, order).drop("_src")


def preserve_failed_fields(
    candidate: DataFrame, prior: DataFrame, failures: DataFrame, key: str, fields: Sequence[str],
    stamp: str = "updated_at",
) -> DataFrame:
    """Restore stored fields (and the stored stamp) of rows whose observation failed.

    ``failures`` is (key, fields array).  A row without history gets '' for each failed field, keeps its stamp.
    """
    stored = prior.select(key, F.lit(True).alias("_known"), F.col(stamp).alias("_stamp"),
                          *[F.col(f).alias(f"_old_{f}") for f in fields])
    failed = failures.select(key, F.col("fields").alias("_failed"))
    joined = candidate.join(failed, key, "left").join(stored, key, "left")

    def cell(name: str) -> Column:
        if name in fields:
            lost = F.array_contains(F.col("_failed"), F.lit(name))
            return F.when(F.coalesce(lost, F.lit(False)), F.coalesce(F.col(f"_old_{name}"), F.lit("")))\
                .otherwise(F.col(name)).alias(name)
        if name == stamp:
            touched = F.coalesce(F.size("_failed") > 0, F.lit(False)) & F.coalesce(F.col("_known"), F.lit(False))
            return F.when(touched, F.col("_stamp")).otherwise(F.col(name)).alias(name)
        return F.col(name)

    return joined.select(*[cell(c) for c in candidate.columns])


def unknown_failed_fields(failures: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Failure records naming a field that cannot be restored; must be empty."""
    extra = F.array_except("fields", F.array(*[F.lit(f) for f in fields]))
    return failures.where(F.size(extra) > 0).withColumn("unknown", extra)


def delete_rows(
    df: DataFrame, dates: DataFrame | None = None, rows: DataFrame | None = None, date: str = "Date",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Remove whole dates and single keys, by anti joins."""
    if dates is not None:
        df = df.join(dates.select(date).distinct(), date, "left_anti").select(*df.columns)
    if rows is not None:
        df = df.join(rows.select(*keys).distinct(), list(keys), "left_anti").select(*df.columns)
    return df


def lost_keys(existing: DataFrame, merged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored keys a merge would lose; must be empty before publishing."""
    return existing.select(*keys).join(merged.select(*keys), list(keys), "left_anti")


def union_sets(*frames: DataFrame) -> DataFrame:
    """Set union of pending lists (local, remote, new)."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out.distinct()
