"""Quality gates.

A gate is lazy: it returns a small verdict frame (one row per partition year, date or run) with an ``ok`` column.
``require`` is the only place where a gate touches the driver, and it fetches a single offending row.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelyard.functions import finite, is_close, same_value, strip_blank, tick_size
from panelyard.operators.aggregates import entity_count, session_counts
from panelyard.operators.ordered import BASELINE_SESSIONS, coverage_baseline, day_over_day

# Default thresholds of the gates.
SHRINK_TOLERANCE_PCT = 5.0
COVERAGE_DROP_PCT = 10.0
MIN_UNIVERSE = 100
CLOSE_SHIFT_PCT = 5.0
MAX_SHIFTED_SHARE_PCT = 20.0
CLOSED_COPY_MIN_PCT = 99.0
CLOSED_PAIR_MIN_SHARE = 0.9
STALE_AFTER_SESSIONS = 10
REBASE_KEEP_RATIO = 0.9
SESSION_CAP_SHARE = 0.9


class GateRefused(RuntimeError):
    """A verdict said no; nothing may be published."""

    def __init__(self, gate: str, row: dict):
        self.gate, self.row = gate, row
        super().__init__(f"{gate}: {row}")


def require(gate: str, verdict: DataFrame) -> None:
    """Raise when any verdict row is not ok."""
    bad = verdict.where(~F.coalesce(F.col("ok"), F.lit(True))).limit(1).collect()
    if bad:
        raise GateRefused(gate, bad[0].asDict())


def require_all(gates: Sequence[tuple[str, DataFrame]]) -> None:
    """Judge several verdicts in one job; the first gate in the list that refuses is raised."""
    if not gates:
        return
    refused = None
    for place, (gate, verdict) in enumerate(gates):
        bad = verdict.where(~F.coalesce(F.col("ok"), F.lit(True))).limit(1).select(
            F.lit(place).alias("place"), F.lit(gate).alias("gate"), F.to_json(F.struct("*")).alias("row"))
        refused = bad if refused is None else refused.unionByName(bad)
    rows = sorted(refused.collect())                       # at most one row per gate
    if rows:
        raise GateRefused(rows[0]["gate"], json.loads(rows[0]["row"]))


def shrink_guard(
    before: DataFrame, after: DataFrame, entity: str, by: Sequence[str] = (), exempt: DataFrame | None = None,
    tolerance_pct: float = SHRINK_TOLERANCE_PCT,
) -> DataFrame:
    """Entities may not fall by more than the tolerance; a partition without history passes."""
    old = entity_count(before, entity, exempt, by).withColumnRenamed("n", "before_n")
    new = entity_count(after, entity, exempt, by).withColumnRenamed("n", "after_n")
    if by:
        both = old.join(new, list(by), "full")
    else:
        both = old.withColumn("after_n", new.scalar())
    both = both.withColumn("before_n", F.coalesce("before_n", F.lit(0))).withColumn(
        "after_n", F.coalesce("after_n", F.lit(0)))
    floor = F.col("before_n") * (1 - tolerance_pct / 100)
    return both.withColumn("ok", (F.col("before_n") == 0) | (F.col("after_n") >= floor))


def coverage_continuity(
    df: DataFrame, entity: str, date: str, drop_pct: float = COVERAGE_DROP_PCT, min_universe: int = MIN_UNIVERSE,
    only_dates: DataFrame | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """Entities per date against the previous date.  ``only_dates`` limits a subset merge to known dates.

    With ``by`` (partition columns) the first date of each partition has no predecessor.  ``judged`` is False where
    there is none or it has fewer than ``min_universe`` entities; such dates pass.
    """
    rows = df if only_dates is None else df.join(only_dates.select(date).distinct(), date, "left_semi")
    daily = day_over_day(session_counts(rows, entity, date, by), date, by=by)
    judged = F.coalesce(F.col("n_prev") >= min_universe, F.lit(False))
    return daily.withColumn("judged", judged).withColumn("ok", ~(judged & F.coalesce(
        F.col("pct") <= -drop_pct, F.lit(False))))


def write_coverage(
    merged: DataFrame, existing: DataFrame, write_dates: DataFrame, entity: str, date: str,
    drop_pct: float = COVERAGE_DROP_PCT, min_universe: int = MIN_UNIVERSE, extra: DataFrame | None = None,
    sessions: int = BASELINE_SESSIONS,
) -> DataFrame:
    """Entities on each written date against the median of neighbouring sessions that are not being written.

    ``extra`` (the previous year) joins the baseline while the stored year has fewer than ``sessions`` sessions.
    ``verified`` is False where no baseline exists, ``judged`` where it is below ``min_universe``; such dates pass.
    """
    base = session_counts(existing, entity, date)
    if extra is not None:
        short = base.agg(F.count(F.lit(1)) < sessions).scalar()
        base = (base.unionByName(session_counts(extra, entity, date).where(short))
                .groupBy(date).agg(F.max("n").alias("n")))
    targets = write_dates.select(date).distinct()
    after = session_counts(merged.join(targets, date, "left_semi"), entity, date)
    judged = (targets.join(after, date, "left").join(coverage_baseline(base, targets, date), date, "left")
              .withColumn("n", F.coalesce("n", F.lit(0))))
    wide = F.coalesce(F.col("baseline") >= min_universe, F.lit(False))
    short = wide & (F.col("n") * 100 < F.col("baseline") * (100 - drop_pct))
    return (judged.withColumn("ratio_pct", F.try_divide(F.col("n") * 100.0, F.col("baseline")))
            .withColumn("verified", F.col("baseline").isNotNull()).withColumn("judged", wide)
            .withColumn("ok", ~F.coalesce(short, F.lit(False))))


def daily_coverage(today: DataFrame, reference: DataFrame, entity: str, date: str, **limits) -> DataFrame:
    """The same rule for the newest date of a feed, before it is saved."""
    newest = today.agg(F.max(date).alias(date))
    return write_coverage(today, reference, newest, entity, date, **limits)


def price_drift(
    stored: DataFrame, incoming: DataFrame, entity: str, date: str, close: str = "Close",
    prices: Sequence[str] = ("Open", "High", "Low", "Close"), exempt: DataFrame | None = None,
    unsettled_as_of: Column | None = None, tolerance_pct: float = SHRINK_TOLERANCE_PCT,
) -> DataFrame:
    """Closes re-read on stored keys must agree, except for a tolerated share of entities.

    ``exempt`` names entities with corporate actions or under replacement.  With ``unsettled_as_of`` the last
    bars of each entity (from one day before the earlier of that date and its last stored date) are not compared.
    Non-finite prices refuse outright.
    """
    old = stored.select(entity, date, *[F.col(c).alias(f"_old_{c}") for c in prices])
    both = incoming.select(entity, date, *prices).join(old, [entity, date])
    if exempt is not None:
        both = both.join(exempt.select(entity).distinct(), entity, "left_anti")
    if unsettled_as_of is not None:
        last = stored.groupBy(entity).agg(F.max(date).alias("_last"))
        both = both.join(last, entity).where(
            F.col(date) < F.date_sub(F.least(unsettled_as_of, F.col("_last")), 1))
    broken = F.lit(False)
    for c in prices:
        broken = broken | ~finite(F.col(c)) | ~finite(F.col(f"_old_{c}"))
    differs = ~is_close(F.col(f"_old_{close}"), F.col(close))
    per_entity = both.groupBy(entity).agg(
        F.bool_or(broken).alias("broken"), F.bool_or(F.coalesce(differs, F.lit(False))).alias("drifts"),
        F.min(F.when(differs, F.col(date))).alias("first_bad"), F.max(F.when(differs, F.col(date))).alias("last_bad"))
    out = per_entity.agg(
        F.count(F.lit(1)).alias("compared"), F.count_if("drifts").alias("mismatched"),
        F.count_if("broken").alias("unreadable"), F.min("first_bad").alias("mismatch_from"),
        F.max("last_bad").alias("mismatch_to"))
    return out.withColumn("ok", (F.col("unreadable") == 0) & (
        F.col("mismatched") <= F.col("compared") * tolerance_pct / 100.0))


def verify_entities(
    candidate: DataFrame, reference: DataFrame, entity: str, date: str, close: str = "Close",
    tolerance: Column | None = None,
) -> DataFrame:
    """Per candidate entity: 'verified' when all overlapping closes agree, 'rejected' when one does not,
    'unmatched' without an overlap.  The default tolerance is one quotation step of the reference price."""
    ref = (reference.where(F.col(close).isNotNull()).groupBy(entity, date)
           .agg(F.max(close).alias("_ref")))
    allowed = (tick_size(F.col("_ref")) if tolerance is None else tolerance) + 1e-6
    agrees = F.abs(F.col(close) - F.col("_ref")) <= allowed
    overlap = candidate.select(entity, date, close).join(ref, [entity, date]).groupBy(entity).agg(
        F.every(F.coalesce(agrees, F.lit(False))).alias("_agrees"), F.count(F.lit(1)).alias("overlap"))
    state = F.when(F.col("_agrees"), "verified").when(F.col("_agrees").isNull(), "unmatched").otherwise("rejected")
    return (candidate.select(entity).distinct().join(overlap, entity, "left")
            .select(entity, F.coalesce("overlap", F.lit(0)).alias("overlap"), state.alias("state")))


def accepted_rows(
    candidate: DataFrame, states: DataFrame, entity: str, date: str, keep_from: Column | None = None
) -> DataFrame:
    """Rows of verified entities, from ``keep_from`` on."""
    good = states.where(F.col("state") == "verified").select(entity)
    rows = candidate.join(good, entity, "left_semi")
    return rows if keep_from is None else rows.where(F.col(date) >= keep_from)


def evidence(states: DataFrame) -> DataFrame:
    """One row with the verified / rejected / unmatched counts."""
    return states.agg(*[F.count_if(F.col("state") == s).alias(s) for s in ("verified", "rejected", "unmatched")])


def mass_change(
    joined: DataFrame, date: str, stored_close: str, official_close: str, shift_pct: float = CLOSE_SHIFT_PCT,
    max_share_pct: float = MAX_SHIFTED_SHARE_PCT,
) -> DataFrame:
    """Per date: share of comparable closes that move by at least ``shift_pct``; too wide a move refuses."""
    old, new = F.col(stored_close), F.col(official_close)
    both = (old > 0) & new.isNotNull()
    moved = F.when(old > 0, F.abs(new / old - 1) * 100 >= shift_pct)
    daily = joined.groupBy(date).agg(F.count_if(both).alias("comparable"), F.count_if(both & moved).alias("shifted"))
    pct = F.try_divide(F.col("shifted") * 100.0, F.col("comparable"))
    return daily.withColumn("shifted_pct", pct).withColumn(
        "ok", F.coalesce(F.col("shifted_pct") <= max_share_pct, F.lit(True)))


def closed_copies(
    stored: DataFrame, official: DataFrame, dates: DataFrame, status: DataFrame, entity: str, date: str,
    close: str = "Close", volume: str = "Volume", min_pct: float = CLOSED_COPY_MIN_PCT,
    min_pair_share: float = CLOSED_PAIR_MIN_SHARE,
) -> DataFrame:
    """Evidence that a stored date is a closed day's copy of the session before it.

    ``status`` is the calendar (date, status, reason).  Every listed date gets a row; ``ok`` means it may be
    deleted: the calendar is closed, the official source reaches past it and lacks it, the date has rows, 90 % of
    its entities pair with the previous kept session and 99 % of those closes are equal.
    """
    drops = dates.select(date).distinct().withColumn("_drop", F.lit(True))
    axis = stored.select(date).distinct().join(drops, date, "full")
    kept = F.when(F.col("_drop").isNull(), F.col(date))
    before = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    prev = axis.withColumn("previous", F.max(kept).over(before)).where("_drop").select(date, "previous")

    rows = stored.join(prev, date).select(date, "previous", entity, close, volume)
    past = stored.select(F.col(date).alias("previous"), entity, F.col(close).alias("_c"), F.col(volume).alias("_v"),
                         F.lit(True).alias("_paired"))
    pairs = rows.join(past, ["previous", entity], "left").groupBy(date).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("_paired").alias("pairs"),
        F.count_if(F.col("_paired") & same_value(F.col(close), F.col("_c"))).alias("_close_same"),
        F.count_if(F.col("_paired") & same_value(F.col(volume), F.col("_v"))).alias("_volume_same"))
    official_days = official.select(date).distinct().withColumn("_official", F.lit(True))
    through = official.agg(F.max(date)).scalar()
    out = (prev.join(pairs, date, "left").join(official_days, date, "left")
           .join(status.select(F.col("date").alias(date), "status", "reason"), date, "left")
           .withColumn("close_match_pct", F.try_divide(F.col("_close_same") * 100.0, F.col("pairs")))
           .withColumn("volume_match_pct", F.try_divide(F.col("_volume_same") * 100.0, F.col("pairs"))))
    good = ((F.col("status") == "closed") & (F.col("rows") > 0) & (F.col(date) < through)
            & F.col("_official").isNull() & F.col("previous").isNotNull()
            & (F.col("pairs") >= F.col("rows") * min_pair_share) & (F.col("close_match_pct") >= min_pct))
    return out.select(date, "previous", "reason", "rows", "pairs", "close_match_pct", "volume_match_pct",
                      F.coalesce(good, F.lit(False)).alias("ok"))


def prelisting_rows(
    stored: DataFrame, official: DataFrame, keys: DataFrame, entity: str, date: str, volume: str = "Volume"
) -> DataFrame:
    """Evidence that single stored rows predate a listing: exactly one row without volume, the official source
    published the date, and the entity appears there only later."""
    wanted = keys.select(entity, date).distinct()
    found = stored.join(wanted, [entity, date], "left_semi").groupBy(entity, date).agg(
        F.count(F.lit(1)).alias("rows"), F.every(F.coalesce(F.col(volume), F.lit(0)) == 0).alias("_idle"),
        F.max(volume).alias("stored_volume"))
    days = official.select(date).distinct().withColumn("_published", F.lit(True))
    listed = official.groupBy(entity).agg(F.min(date).alias("official_first_date"))
    out = wanted.join(found, [entity, date], "left").join(days, date, "left").join(listed, entity, "left")
    good = ((F.col("rows") == 1) & F.col("_idle") & F.col("_published")
            & (F.col("official_first_date") > F.col(date)))
    return out.select(entity, date, F.coalesce("rows", F.lit(0)).alias("rows"), "stored_volume",
                      "official_first_date", F.coalesce(good, F.lit(False)).alias("ok"))


def provisional_sessions(
    stored: DataFrame, boundary: DataFrame, date: str, floor: Column, limit: int = STALE_AFTER_SESSIONS
) -> DataFrame:
    """Sessions since the floor that the official source has not reached; too many means it is late."""
    through = boundary.agg(F.max("official_through")).scalar()
    late = F.when(F.col(date) > F.coalesce(through, F.date_sub(floor, 1)), F.col(date))
    return stored.where(F.col(date) >= floor).agg(F.countDistinct(late).alias("provisional")).withColumn(
        "ok", F.col("provisional") <= limit)


def rebase_safe(
    existing: DataFrame, incoming: DataFrame, targets: DataFrame, failed: DataFrame, entity: str, period: Column,
    keep_ratio: float = REBASE_KEEP_RATIO,
) -> DataFrame:
    """Which targets may have their history replaced: no hard failure, and in every period with stored rows at
    least 90 % as many new ones."""
    key = F.upper(strip_blank(F.col(entity).cast("string"))).alias("_e")
    wanted = targets.select(key).distinct()
    old = existing.select(key, period.alias("_p")).join(wanted, "_e", "left_semi").groupBy("_e", "_p").agg(
        F.count(F.lit(1)).alias("_old"))
    new = incoming.select(key, period.alias("_p")).join(wanted, "_e", "left_semi").groupBy("_e", "_p").agg(
        F.count(F.lit(1)).alias("_new"))
    fits = F.col("_new").isNotNull() & (F.col("_new") >= F.col("_old") * keep_ratio)
    kept = old.join(new, ["_e", "_p"], "left").groupBy("_e").agg(F.bool_and(fits).alias("_fits"))
    lost = failed.select(key).distinct().withColumn("_failed", F.lit(True))
    out = wanted.join(kept, "_e", "left").join(lost, "_e", "left")
    return out.select(F.col("_e").alias(entity), (
        F.col("_failed").isNull() & F.coalesce("_fits", F.lit(True))).alias("safe"))


def session_acceptance(df: DataFrame, date: str, cap: str, min_share: float = SESSION_CAP_SHARE) -> DataFrame:
    """A past session counts only when nearly all its rows carry a market cap (closed-day files have none)."""
    share = F.avg(F.when(F.col(cap) > 0, 1.0).otherwise(0.0))
    return df.groupBy(date).agg(F.count(F.lit(1)).alias("rows"), share.alias("cap_share")).withColumn(
        "ok", F.col("cap_share") >= min_share)


def worst(verdict: DataFrame, by: Column, key: str) -> DataFrame:
    """The row of a verdict with the smallest score."""
    return verdict.agg(F.min_by(key, by).alias(key), F.min(by).alias("score"))
