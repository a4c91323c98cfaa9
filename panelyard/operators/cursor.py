"""Incremental cursors: how far a day-by-day feed is proven complete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.operators.aggregates import first_seen, latest_names, session_counts
from panelyard.operators.gates import SHRINK_TOLERANCE_PCT
from panelyard.operators.ordered import entity_spans

# Look-back and waiting limits.
LOOKBACK_DAYS = 7
SPARSE_MIN_PCT = 50.0
MAX_HOLD_DAYS = 7
STALE_DAYS = 3


def lookback_start(last_date: Column, days: int = LOOKBACK_DAYS) -> Column:
    """The first day of the window that is read again (later reads win)."""
    return F.date_sub(last_date, days - 1)


def sparse_dates(df: DataFrame, entity: str, date: str, min_pct: float = SPARSE_MIN_PCT) -> DataFrame:
    """Dates reported by less than ``min_pct`` percent of the frame's entities."""
    universe = df.agg(F.countDistinct(entity)).scalar()
    counts = session_counts(df, entity, date).withColumn("universe", universe)
    return counts.where(F.col("n") < F.col("universe") * min_pct / 100.0)


def cursor_entities(
    df: DataFrame, required: DataFrame, failed: DataFrame, entity: str, date: str, cohort: str
) -> DataFrame:
    """One row per required or delivered entity, with the labels the cursor decision reads.

    ``required`` and ``failed`` hold entities; ``cohort`` is a column of ``df`` (entities sharing a calendar).
    """
    feed = df.groupBy(entity).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(date).alias("dates"))
    wanted = required.select(entity).distinct().withColumn("_required", F.lit(True))
    lost = failed.select(entity).distinct().withColumn("_failed", F.lit(True))
    known = (wanted.join(feed, entity, "full").join(lost, entity, "left").select(
        entity, F.coalesce("_required", F.lit(False)).alias("required"),
        F.col("rows").isNotNull().alias("delivered"), F.coalesce("_failed", F.lit(False)).alias("failed"),
        (F.col("rows") > F.col("dates")).alias("repeated")))
    known = known.withColumn("verified", F.col("required") & F.col("delivered") & ~F.col("failed"))
    sound = df.select(entity, date, cohort).join(required.select(entity), entity, "left_semi").join(
        failed.select(entity), entity, "left_anti")
    spans = entity_spans(sound, entity, date, [cohort])
    newest = spans.where(F.col("holes") == 0).groupBy(cohort).agg(F.max("last_date").alias("_newest"))
    flags = spans.join(newest, cohort, "left").select(
        entity, "last_date", (F.col("holes") > 0).alias("holed"),
        (F.datediff("_newest", "last_date") > STALE_DAYS).alias("stale"))
    return known.join(flags, entity, "left")


def completeness_cursor(
    df: DataFrame, required: DataFrame, failed: DataFrame, entity: str, date: str, cohort: str,
    previous: Column, today: Column, tolerance_pct: float = SHRINK_TOLERANCE_PCT,
    sparse_min_pct: float = SPARSE_MIN_PCT, max_hold_days: int = MAX_HOLD_DAYS,
) -> DataFrame:
    """One row: the new cursor, or the reason the feed is refused.

    Refused: nothing delivered, an entity nobody asked for, a repeated (entity, date), too many missing entities,
    or only entities with holes.  Otherwise the cursor is the earliest last date of the sound entities, never
    before ``previous``; it waits in front of the first sparse date until ``max_hold_days`` have passed.
    """
    entities = cursor_entities(df, required, failed, entity, date, cohort)
    missing = F.col("required") & ~F.col("verified")
    live = F.col("verified") & ~F.coalesce(F.col("holed"), F.lit(False))
    stale = live & F.coalesce(F.col("stale"), F.lit(False))
    facts = entities.agg(
        F.count_if("required").alias("required"), F.count_if("delivered").alias("delivered"),
        F.count_if(F.col("delivered") & ~F.col("required")).alias("unexpected"),
        F.count_if("repeated").alias("repeated"), F.count_if(missing).alias("missing"),
        F.count_if(F.coalesce(F.col("holed"), F.lit(False))).alias("holed"), F.count_if(live).alias("live"),
        F.count_if(stale).alias("stale"), F.min(F.when(live & ~stale, F.col("last_date"))).alias("_fresh"),
        F.min(F.when(live, F.col("last_date"))).alias("_any"))
    proven = F.when(F.col("stale") < F.col("live"), F.col("_fresh")).otherwise(F.col("_any"))
    status = (F.when(F.col("delivered") == 0, "empty_unverified")
              .when(F.col("unexpected") > 0, "unexpected_entity")
              .when((F.col("missing") > F.col("required") * tolerance_pct / 100.0)
                    | (F.col("missing") >= F.col("required")), "incomplete")
              .when(F.col("repeated") > 0, "invalid_dates")
              .when(F.col("live") == 0, "session_unverified").otherwise("ok"))
    # Sparse dates are at most the calendar days of the feed, so they travel as one array.
    sparse = sparse_dates(df, entity, date, sparse_min_pct).agg(F.collect_list(date)).scalar()
    held = F.col("_previous")
    out = (facts.withColumn("_previous", previous).withColumn("status", status)
           .withColumn("_reached", F.greatest(held, proven))
           .withColumn("_sparse", sparse)
           .withColumn("_gap", F.array_min(F.filter(
               "_sparse", lambda d: (d > held) & (d <= F.col("_reached"))))))
    holds = F.col("_gap").isNotNull() & (F.datediff(today, held) <= max_hold_days)
    cursor = F.when(holds, F.greatest(held, F.date_sub("_gap", 1))).otherwise(F.col("_reached"))
    return out.select(
        "status", F.when(F.col("status") == "ok", cursor).alias("cursor"), "required", "delivered", "missing",
        "holed", "stale", (holds & (F.col("status") == "ok")).alias("held"), (F.col("status") == "ok").alias("ok"))


def backfill_candidates(universe: DataFrame, known: DataFrame, pending: DataFrame, entity: str) -> DataFrame:
    """Universe entities never stored ('new') or still pending ('retry'); other columns of the universe stay."""
    stored = known.select(entity).distinct().withColumn("_known", F.lit(True))
    waiting = pending.select(entity).distinct().withColumn("_pending", F.lit(True))
    joined = universe.join(stored, entity, "left").join(waiting, entity, "left")
    return joined.where(F.col("_known").isNull() | F.col("_pending")).select(
        *universe.columns, F.when(F.col("_pending"), "retry").otherwise("new").alias("kind"))


def backfill_audit(df: DataFrame, pending: DataFrame, entity: str, date: str, after: Column) -> DataFrame:
    """Entities first seen after a cut-off, split into newly suspected and already pending."""
    late = first_seen(df, entity, date).where(F.col("first_date") > after)
    waiting = pending.select(entity).distinct().withColumn("_pending", F.lit(True))
    return late.join(waiting, entity, "left").select(
        entity, "first_date", F.when(F.col("_pending"), "pending").otherwise("new").alias("state"))


def missing_today(
    history: DataFrame, today_rows: DataFrame, entity: str, date: str, today: Column, name: str, market: str,
    days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Entities seen in the last days but not today, with their latest name and market."""
    recent = history.where(F.col(date) >= F.date_sub(today, days)).select(entity).distinct()
    gone = recent.join(today_rows.select(entity), entity, "left_anti")
    return latest_names(history.join(gone, entity, "left_semi"), entity, date, name, market)


def pending_after(
    pending: DataFrame, intent: DataFrame, resolved: DataFrame, keys: Sequence[str] = ("market", "kind", "ticker")
) -> DataFrame:
    """Pending list after a run: earlier entries and new intent, without what was resolved."""
    keys = list(keys)
    return pending.select(*keys).unionByName(intent.select(*keys)).distinct().join(resolved, keys, "left_anti")


def advance_state(
    state: DataFrame, run: DataFrame, subset: bool = False, key: str = "market"
) -> DataFrame:
    """Cursor table after a run.  A subset backfill may lower ``oldest_date`` but never move ``last_updated``."""
    both = state.alias("s").join(run.alias("r"), key, "full")
    cursor = (F.coalesce(F.col("s.last_updated"), F.col("r.last_updated")) if subset
              else F.greatest(F.col("s.last_updated"), F.col("r.last_updated")))
    return both.select(
        key, cursor.alias("last_updated"),
        F.coalesce(F.col("r.ticker_count"), F.col("s.ticker_count")).alias("ticker_count"),
        F.least(F.col("s.oldest_date"), F.col("r.oldest_date")).alias("oldest_date"),
        F.coalesce(F.col("r.updated_at"), F.col("s.updated_at")).alias("updated_at"))


def accept_prefix(verdict: DataFrame, date: str) -> DataFrame:
    """Missed sessions filled in order: the dates before the first one that failed."""
    first_bad = verdict.agg(F.min(F.when(~F.col("ok"), F.col(date)))).scalar()
    return verdict.withColumn("_bad", first_bad).where(
        F.col("_bad").isNull() | (F.col(date) < F.col("_bad"))).select(date)
