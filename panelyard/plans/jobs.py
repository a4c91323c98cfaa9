"""Jobs: landed frames in, published tables and a small report frame out.

Each job follows one order: read what the feed touches, merge lazily, stage once, judge the staged rows, promote,
and only then move state.  ``apply=False`` runs the same path without writing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.functions import finite, same_value
from panelyard.operators import aggregates as A
from panelyard.operators import calendar as C
from panelyard.operators import cursor as CU
from panelyard.operators import fundamentals as FU
from panelyard.operators import gates as G
from panelyard.operators import merge as M
from panelyard.operators import ordered as O
from panelyard.operators import rows as R
from panelyard.operators import settlement as S
from panelyard.plans import reports as RP
from panelyard.plans.lake import Lake, by_month, by_year
from panelyard.plans.publish import (
    Table, append_log, partition_values, preview, pruned, publish, set_boundary, touched, upsert_state,
)
from panelyard.schemas import BARS, FINANCIALS, KR_BARS, RATIOS, TAGS, conform
from panelyard.session import materialise
from panelyard.sources.checks import (
    infinity_to_null, undated_rows, validate_fundamentals, validate_keys, validate_official, validate_snapshot,
    validate_tags,
)

Gate = tuple[str, Callable[[DataFrame], DataFrame]]


@dataclass(frozen=True)
class Limits:
    """Gate thresholds of a run; the defaults are the production ones."""

    shrink_pct: float = G.SHRINK_TOLERANCE_PCT
    drop_pct: float = G.COVERAGE_DROP_PCT
    min_universe: int = G.MIN_UNIVERSE
    allow_shrink: bool = False
    allow_gap: bool = False


def _save(candidate: DataFrame, table: Table, gates: Sequence[Gate], apply: bool = True,
          partitions: Sequence[int] | None = None) -> DataFrame:
    return publish(candidate, table, gates, partitions) if apply else preview(candidate, gates)


def _key_gate(table: Table, date: str) -> Gate:
    year = F.col(table.partition)
    return "keys", lambda rows: validate_keys(rows, table.keys, year, F.year(date))


def _bar_gates(current: DataFrame, table: Table, limits: Limits, exempt: DataFrame | None = None,
               only_dates: DataFrame | None = None) -> list[Gate]:
    """Validity, shrink and continuity of US and crypto bars, in the order that decides the refusal."""
    gates = [_key_gate(table, "Date")]
    if not limits.allow_shrink:
        gates.append(("shrink", lambda rows: G.shrink_guard(current, rows, "Ticker", ["year"], exempt,
                                                            limits.shrink_pct)))
    if not limits.allow_gap:
        gates.append(("continuity", lambda rows: G.coverage_continuity(
            rows, "Ticker", "Date", limits.drop_pct, limits.min_universe, only_dates, by=["year"])))
    return gates


def _home_days(rows: DataFrame, market: str) -> DataFrame:
    """Home-calendar rule of the US panel."""
    return R.split_orphan_dates(rows, "Ticker", "Date")[0] if market == "us" else rows


def _with_ratio(rows: DataFrame) -> DataFrame:
    """Percent change of every row to the entity's row before it."""
    return O.with_changes(rows.drop("ChangesRatio"), "Ticker", "Date", "Close", "_change", "ChangesRatio")


def _ends(rows: DataFrame) -> DataFrame:
    """First and last bar of each entity and year; three columns of the table are enough."""
    return rows.groupBy("Ticker", "year").agg(F.min("Date").alias("first"), F.max("Date").alias("last"),
                                              F.max_by("Close", "Date").alias("last_close"))


@dataclass(frozen=True)
class Merge:
    """A candidate with the stored rows of the same partitions and their values."""

    candidate: DataFrame
    current: DataFrame
    years: list[int]


def _merge_bars(
    lake: Lake, market: str, feed: DataFrame, replace: DataFrame | None = None, carry_caps: bool = False
) -> Merge:
    """Candidate rows for every year a merge changes.

    Those are the feed's years, the years that store a row of ``replace`` (dropped first; their market caps survive
    only with ``carry_caps``, a rebase, not when they belonged to another instrument) and the years whose first change
    has a new predecessor.  Only these years are read; of the others the stored ends: which entities they hold, and
    each entity's last bar, as predecessor.
    """
    table = lake.bars(market)
    stored, ends = lake.read(table), lake.ends(table).withColumnRenamed("last_value", "last_close")
    years = set(partition_values(feed, "year"))
    if replace is not None:
        years |= set(partition_values(M.only_entities(ends, replace, "Ticker"), "year"))
    context = pruned(stored, "year", sorted(years))
    kept = context if replace is None else M.drop_entities(context, replace, "Ticker")
    filled = M.preserve_measure(context if carry_caps else kept, feed, ["Ticker", "Date"], "MarketCap")
    merged = materialise(by_year(conform(_home_days(M.merge_last(kept, filled, ["Ticker", "Date"]), market), BARS),
                                 "Date"), "merged")

    others = materialise(ends.where(~F.col("year").isin(*years)) if years else ends, "ends")
    old, new = _ends(context), _ends(merged)
    moved = old.select("Ticker", "year", "last", "last_close").exceptAll(
        new.select("Ticker", "year", "last", "last_close")).unionByName(
        new.select("Ticker", "year", "last", "last_close").exceptAll(
            old.select("Ticker", "year", "last", "last_close"))).select("Ticker", F.col("year").alias("_y")).distinct()
    after = moved.join(others, "Ticker").where(F.col("year") > F.col("_y")).groupBy("Ticker", "_y").agg(
        F.min("year").alias("year"))
    later = partition_values(after, "year")
    rows = merged.unionByName(pruned(stored, "year", later).select(*merged.columns)).withColumn("_edge", F.lit(False))
    edges = others.where(~F.col("year").isin(*later)) if later else others
    edges = edges.select("Ticker", F.col("last").alias("Date"), F.col("last_close").alias("Close"), F.lit(True).alias("_edge"))
    changed = _with_ratio(rows.unionByName(edges, allowMissingColumns=True)).where(~F.col("_edge"))
    every = sorted(years | set(later))
    return Merge(by_year(conform(changed, BARS), "Date"), pruned(stored, "year", every), every)


def finalise_feed(raw: DataFrame, seq: str | None = None) -> tuple[DataFrame, list[tuple[str, DataFrame]], DataFrame]:
    """(bars, gates, acted): provider rows in shape, what must hold for them, entities with a corporate action.

    A row in which every provider column is missing is padding and goes first.  Of what is left the evidence of
    dividends, splits and (where delivered) capital gains must be complete, every price a number, and each key
    delivered once; with ``seq``, the arrival order, the last of repeated keys counts.
    """
    provider = [c for c in raw.columns if c not in ("Ticker", "Date", seq)]
    rows = R.drop_empty_rows(raw, [f"`{c}`" for c in provider])
    gains = "`Capital Gains`" if "Capital Gains" in raw.columns else None
    actions = materialise(A.corporate_actions(rows, "Ticker", "Dividends", "`Stock Splits`" if "Stock Splits" in raw.columns
                                              else "Splits", gains), "actions")
    broken = R.nonfinite_rows(rows).unionByName(rows.where(R.all_missing(R.PRICES)))
    if seq:
        rows = M.dedup_feed(rows, ["Ticker", "Date"], [F.col(seq)])
    repeated = A.duplicate_keys(rows, ["Ticker", "Date"])
    shaped = conform(R.positive_close(rows).withColumn("Amount", F.col("Close") * F.col("Volume")).withColumn(
        "Dividends", F.lit(0.0)).withColumn("Splits", F.lit(1.0)), BARS)
    gates = [("actions", actions.agg(F.coalesce(F.bool_and("complete"), F.lit(True)).alias("ok"))),
             ("price_values", _no_rows(broken)),
             ("feed_keys", repeated.withColumn("ok", F.col("duplicate_rows") == 0))]
    return by_year(shaped, "Date"), gates, actions.where("action").select("Ticker")


def _basis_gate(market: str, stored: DataFrame, feed: DataFrame, acted: DataFrame, named: DataFrame | None = None,
                today: Column | None = None) -> Gate:
    """Stored closes must agree with the feed, but for entities that acted or are replaced, and, of crypto, the bars
    not settled by ``today``.  One rule for every way of writing bars."""
    exempt = acted if named is None else acted.unionByName(named.select("Ticker"))
    unsettled = (F.current_date() if today is None else today) if market == "crypto" else None
    return "price_basis", G.price_drift(touched(stored, feed, "year"), feed, "Ticker", "Date", exempt=exempt,
                                        unsettled_as_of=unsettled)


def _no_rows(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("ok", F.col("rows") == 0)


def _refuse_rows(gate: str, rows: DataFrame) -> None:
    G.require(gate, _no_rows(rows))


def _set_pending(lake: Lake, intent: DataFrame, resolved: DataFrame) -> None:
    table = lake.pending()
    upsert_state(table, CU.pending_after(lake.read(table), intent, resolved))


def _listed(tickers: DataFrame, market: str, kind: str) -> DataFrame:
    return tickers.select(F.lit(market).alias("market"), F.lit(kind).alias("kind"), F.col("Ticker").alias("ticker"))


def update_bars(
    lake: Lake, market: str, raw: DataFrame, universe: DataFrame, failed: DataFrame, today: Column,
    caps: DataFrame | None = None, overrides: DataFrame | None = None, limits: Limits = Limits(), apply: bool = True,
    seq: str | None = None,
) -> DataFrame:
    """Incremental update of US or crypto bars.

    ``raw`` is the re-read window with provider columns (Dividends and 'Stock Splits' included), ``universe`` and
    ``failed`` hold Ticker, ``caps`` is (Ticker, MarketCap) of today, ``overrides`` (ticker) names symbols under
    correction.  Returns the cursor row.
    """
    table = lake.bars(market)
    table.create(lake.spark)
    lake.cursors().create(lake.spark)
    lake.pending().create(lake.spark)
    bars, gates, acted = finalise_feed(raw, seq)
    G.require_all(gates)
    feed = materialise(bars.withColumn("_cohort", _cohort(market)), "feed")

    state = lake.read(lake.cursors()).where(F.col("market") == market)
    previous = F.coalesce(state.agg(F.max("last_updated")).scalar(), F.lit("1900-01-01").cast("date"))
    proof = materialise(CU.completeness_cursor(feed, universe, failed, "Ticker", "Date", "_cohort", previous, today,
                                               limits.shrink_pct), "cursor")
    G.require("cursor", proof)
    dense = R.exclude_dates(feed.drop("_cohort"), CU.sparse_dates(feed, "Ticker", "Date"), "Date")

    named = None if overrides is None else overrides.select(F.col("ticker").alias("Ticker"))
    stored = lake.read(table)
    G.require(*_basis_gate(market, stored, dense, acted, named, today))
    if caps is not None:
        dense = (dense.drop("MarketCap").join(caps.select("Ticker", F.col("MarketCap").alias("_cap")), "Ticker", "left")
                 .withColumn("MarketCap", R.only_on(F.col("Date"), today, F.col("_cap"))).drop("_cap"))
    merge = _merge_bars(lake, market, dense)
    _save(merge.candidate, table, _bar_gates(merge.current, table, limits), apply, merge.years)
    if apply:
        run = proof.select(
            F.lit(market).alias("market"), F.col("cursor").alias("last_updated"),
            universe.agg(F.countDistinct("Ticker")).scalar().alias("ticker_count"),
            dense.agg(F.min("Date")).scalar().alias("oldest_date"), F.current_timestamp().alias("updated_at"))
        upsert_state(lake.cursors(), CU.advance_state(lake.read(lake.cursors()), run))
        waiting = _listed(acted, market, "rebase")
        _set_pending(lake, waiting, waiting.where(F.lit(False)))
    return proof


def _cohort(market: str) -> Column:
    from panelyard.functions import cohort_of
    return cohort_of(F.col("Ticker"), market) if market == "us" else F.lit(market)


def backfill_bars(
    lake: Lake, market: str, raw: DataFrame, failed: DataFrame, overrides: DataFrame | None = None,
    limits: Limits = Limits(), apply: bool = True, today: Column | None = None, seq: str | None = None,
) -> DataFrame:
    """Backfill of whole years.  Rows of overridden symbols that did not fail are replaced, in every year that stores
    one, others merged."""
    from panelyard.operators.identity import purge_targets
    table = lake.bars(market)
    table.create(lake.spark)
    lake.pending().create(lake.spark)
    bars, gates, acted = finalise_feed(raw, seq)
    G.require_all(gates)
    feed = materialise(bars, "feed")
    named = feed.select("Ticker").where(F.lit(False)) if overrides is None else purge_targets(
        overrides, failed.select(F.col("Ticker").alias("ticker"))).select(F.col("ticker").alias("Ticker"))
    G.require(*_basis_gate(market, lake.read(table), feed, acted, named, today))
    merge = _merge_bars(lake, market, feed, named)
    _save(merge.candidate, table, _bar_gates(merge.current, table, limits, named), apply, merge.years)
    if apply:
        lost, got = _listed(failed, market, "backfill"), _listed(feed.select("Ticker").distinct(), market, "backfill")
        _set_pending(lake, lost, got.join(lost, ["market", "kind", "ticker"], "left_anti"))
    return A.year_summary(feed, "Ticker", "Date")


def backfill_new(
    lake: Lake, market: str, raw: DataFrame, universe: DataFrame, failed: DataFrame, limits: Limits = Limits(),
    today: Column | None = None, seq: str | None = None,
) -> DataFrame:
    """History of entities that are new or still pending.

    Intent is published first, so a run that dies leaves them pending.  Only stored dates are judged for
    continuity, and the cursor does not move.  Returns the candidates.
    """
    table = lake.bars(market)
    for t in (table, lake.cursors(), lake.pending()):
        t.create(lake.spark)
    stored = lake.read(table)
    waiting = lake.queue(market, "backfill")
    candidates = materialise(CU.backfill_candidates(
        universe, A.known_entities(lake.ends(table), "Ticker"), waiting, "Ticker"), "candidates")
    intent = _listed(candidates, market, "backfill")
    _set_pending(lake, intent, intent.where(F.lit(False)))
    bars, gates, acted = finalise_feed(raw.join(candidates.select("Ticker"), "Ticker", "left_semi"), seq)
    G.require_all(gates)
    feed = materialise(bars, "feed")
    G.require(*_basis_gate(market, stored, feed, acted, today=today))
    merge = _merge_bars(lake, market, feed)
    _save(merge.candidate, table, _bar_gates(merge.current, table, limits, only_dates=merge.current),
          partitions=merge.years)
    _refuse_rows("backfill_incomplete", failed.join(candidates, "Ticker", "left_semi"))
    run = feed.agg(F.max("Date").alias("last_updated"), F.min("Date").alias("oldest_date")).select(
        F.lit(market).alias("market"), "last_updated",
        universe.agg(F.countDistinct("Ticker")).scalar().alias("ticker_count"), "oldest_date",
        F.current_timestamp().alias("updated_at"))
    upsert_state(lake.cursors(), CU.advance_state(lake.read(lake.cursors()), run, subset=True))
    _set_pending(lake, intent.where(F.lit(False)), intent)
    return candidates


def rebase_bars(
    lake: Lake, market: str, raw: DataFrame, failed: DataFrame, limits: Limits = Limits(), apply: bool = True,
    targets: DataFrame | None = None, seq: str | None = None,
) -> DataFrame:
    """Replace the full history of entities with corporate actions, entity by entity all or nothing.

    Stored market caps carry over.  Without ``targets`` the queued ones are taken.  Returns (Ticker, safe).
    """
    table = lake.bars(market)
    lake.pending().create(lake.spark)
    named = lake.queue(market, "rebase") if targets is None else targets.select("Ticker")
    bars, gates, _ = finalise_feed(raw.join(named, "Ticker", "left_semi"), seq)
    G.require_all(gates)
    stored = lake.read(table)
    kept_years = partition_values(lake.ends(table), "year")
    feed = materialise(bars.where(F.col("year").isin(*kept_years) if kept_years else F.lit(False)), "feed")
    decision = materialise(G.rebase_safe(stored, feed, named, failed, "Ticker", F.year("Date")), "rebase")
    safe = decision.where("safe").select("Ticker")
    fresh = R.target_entities(feed, safe, "Ticker")
    merge = _merge_bars(lake, market, fresh, safe, carry_caps=True)
    _save(merge.candidate, table, _bar_gates(merge.current, table, limits, safe), apply, merge.years)
    if apply:
        done = _listed(safe, market, "rebase")
        later = _listed(decision.where(~F.col("safe")), market, "rebase")
        _set_pending(lake, later, done)
    return decision


def _kr_gates(current: DataFrame, table: Table, dates: DataFrame, limits: Limits, extra: DataFrame | None) -> list[Gate]:
    gates = [_key_gate(table, "Date"), ("lost_keys", lambda rows: M.lost_keys(current, rows, ["Code", "Date"]).agg(
        F.count(F.lit(1)).alias("lost")).withColumn("ok", F.col("lost") == 0))]
    if not limits.allow_gap:
        gates.append(("write_coverage", lambda rows: G.write_coverage(
            rows, current, dates, "Code", "Date", limits.drop_pct, limits.min_universe, extra)))
    return gates


def save_kr_bars(
    lake: Lake, feed: DataFrame, prices_only: bool = False, limits: Limits = Limits(), apply: bool = True,
    drop_dates: DataFrame | None = None, drop_keys: DataFrame | None = None, seq: str | None = None,
) -> DataFrame:
    """Column-policy merge of KR bars with deletions, the lost-key rule and the write-date coverage gate."""
    table = lake.bars("kr")
    table.create(lake.spark)
    rows = by_year(conform(feed, KR_BARS, keep_extra=bool(seq)), "Date")
    years = set(partition_values(rows, "year"))
    for gone in (drop_dates, drop_keys):
        if gone is not None:
            years |= set(partition_values(gone.select(F.year("Date").alias("year")), "year"))
    stored, years = lake.read(table), sorted(years)
    current = M.delete_rows(pruned(stored, "year", years), drop_dates, drop_keys, "Date", ["Code", "Date"])
    extra = pruned(stored, "year", [y - 1 for y in years])
    policy = M.KR_POLICY_PRICES_ONLY if prices_only else M.KR_POLICY
    merged = M.merge_policy(current.drop("year"), rows.drop("year"), ["Code", "Date"], policy, seq)
    candidate = by_year(conform(merged, KR_BARS), "Date")
    return _save(candidate, table, _kr_gates(current, table, rows.select("Date"), limits, extra), apply, years)


def settle_kr(
    lake: Lake, official: DataFrame, year: int, floor: Column, status: DataFrame | None = None,
    drop_dates: DataFrame | None = None, drop_keys: DataFrame | None = None, limits: Limits = Limits(),
    apply: bool = True, first_year: int = 2026, open_year: int | None = None,
) -> DataFrame:
    """Settle one year by official rows; plan only with ``apply=False``.  Returns the report with reconciliation.

    Deletions need evidence: ``drop_dates`` a closed session copied from the one before (``status`` is the
    calendar), ``drop_keys`` an idle row before the listing.  Years before ``first_year`` are closed.
    """
    spark = lake.spark
    if year < first_year:
        return spark.range(1).select(F.lit(year).alias("year"), F.lit("closed_year").alias("skipped"))
    table = lake.bars("kr")
    for t in (table, lake.boundary(), lake.settlement_log()):
        t.create(spark)
    source = materialise(conform(official.where(F.year("Date") == year), KR_BARS), "official")
    G.require("official_rows", validate_official(source))
    held = lake.read(table).where(F.col("year") == year).drop("year")
    if drop_dates is not None:
        if status is None:
            raise G.GateRefused("closed_session", {"reason": "no calendar given for the dates to drop"})
        G.require("closed_session", G.closed_copies(held, source, drop_dates, status, "Code", "Date"))
    if drop_keys is not None:
        G.require("prelisting_row", G.prelisting_rows(held, source, drop_keys, "Code", "Date"))
    kept = M.delete_rows(held, drop_dates, drop_keys, "Date", ["Code", "Date"])
    rules = S.kr_rules()
    both = source.where(F.col("Date") >= floor).select("Code", "Date", F.col("Close").alias("_new")).join(
        kept.select("Code", "Date", F.col("Close").alias("_old")), ["Code", "Date"])
    G.require("mass_change", G.mass_change(both, "Date", "_old", "_new"))

    compared = materialise(S.compare_settlement(kept, source, rules, floor), "settlement")
    write = S.rows_to_write(compared, rules)
    report = S.settlement_report(compared, source, rules, floor).withColumn(
        "rows_dropped", held.agg(F.count(F.lit(1))).scalar() - kept.agg(F.count(F.lit(1))).scalar())
    report = materialise(report.select(F.lit(year).cast("int").alias("year"), "*"), "report")
    facts = report.first()
    recorded = S.boundary_of(lake.read(lake.boundary()), year).first()["official_through"]
    work = facts["rows_added"] + facts["rows_replaced"] + facts["rows_dropped"] > 0
    moved = year == open_year and facts["official_through"] != recorded
    known = facts["official_through"] is not None
    final = held
    if known and (work or not apply):
        final = save_kr_bars(lake, write, limits=limits, apply=apply, drop_dates=drop_dates, drop_keys=drop_keys)
    if known and apply and (work or moved):
        through = report.select("official_through")
        upsert_state(lake.boundary(), set_boundary(lake.read(lake.boundary()), year, through))
        entry = report.select("year", F.current_timestamp().alias("at"), "official_through", "rows_added",
                              "rows_replaced", "rows_dropped", "first_date", "last_date")
        upsert_state(lake.settlement_log(), append_log(lake.read(lake.settlement_log()), entry))
    if not known:
        return report
    checked = S.reconcile(final, source, ["Code", "Date"], "Date", ["Open", "High", "Low", "Close", "Volume"], floor)
    return _beside(report.withColumn("written", F.lit(bool(apply and (work or moved)))), checked)


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row frames side by side."""
    return left.select("*", *[right.select(c).scalar().alias(c) for c in right.columns])


def settle_kr_years(
    lake: Lake, official: DataFrame, years: Sequence[int], floor: Column, limits: Limits = Limits(), apply: bool = True,
    first_year: int = 2026, open_year: int | None = None, refuse: bool = True,
) -> DataFrame:
    """Settle any number of years in one plan; a report row per year with its verdict.

    Years are values in the keys of every step: one comparison, one judgement, one publication, one reconciliation,
    whatever their number.  ``refused`` names the first gate a year fails (its official rows, too wide a move of
    closes, too few entities on a written date); such a year is left out and the others are settled.  Years before
    ``first_year`` are ``closed_year``.  With ``refuse`` the refusals are raised after the others were published.
    """
    spark, table = lake.spark, lake.bars("kr")
    for t in (table, lake.boundary(), lake.settlement_log()):
        t.create(spark)
    asked = spark.range(1).select(F.explode(F.array(*[F.lit(y).cast("int") for y in sorted(set(years))])).alias("year"))
    named = [y for y in sorted(set(years)) if y >= first_year]
    source = materialise(by_year(conform(official.where(F.year("Date").isin(*named) if named else F.lit(False)), KR_BARS),
                                 "Date"), "official")
    held = pruned(lake.read(table), "year", named)
    rules = S.kr_rules()

    def failed(gate: str, verdict: DataFrame, year: Column) -> DataFrame:
        return verdict.where(~F.coalesce("ok", F.lit(False))).select(year.cast("int").alias("year"), F.lit(gate).alias("gate"))

    both = source.where(F.col("Date") >= floor).select("Code", "Date", F.col("Close").alias("_new")).join(
        held.select("Code", "Date", F.col("Close").alias("_old")), ["Code", "Date"])
    bad = failed("1 official_rows", validate_official(source.drop("year")), F.col("partition")).unionByName(
        failed("2 mass_change", G.mass_change(both, "Date", "_old", "_new"), F.year("Date")))

    compared = materialise(by_year(S.compare_settlement(held.drop("year"), source.drop("year"), rules, floor), "Date"),
                           "settlement")
    write = S.rows_to_write(compared, rules)
    dates = write.select("Date").distinct()
    counted = held.select("Code", "Date").unionByName(write.select("Code", "Date"))
    extra = pruned(lake.read(table), "year", sorted({y - 1 for y in named} - set(named)))
    wide = G.write_coverage(counted, held, dates, "Code", "Date", limits.drop_pct, limits.min_universe, extra)
    bad = bad if limits.allow_gap else bad.unionByName(failed("3 write_coverage", wide, F.year("Date")))
    refused = materialise(bad.groupBy("year").agg(F.substring(F.min("gate"), 3, 99).alias("refused")), "refused")

    touched_on = F.when(F.col("added") | F.col("changed"), F.col("Date"))
    changes = compared.groupBy("year").agg(
        F.count_if("added").alias("rows_added"), F.count_if(F.col("changed") & ~F.col("added")).alias("rows_replaced"),
        F.min(touched_on).alias("first_date"), F.max(touched_on).alias("last_date"))
    bounds = source.groupBy("year").agg(F.max("Date").alias("official_through"))
    recorded = lake.read(lake.boundary()).groupBy("year").agg(F.max("official_through").alias("_recorded"))
    zero = F.lit(0).cast("long")
    state = F.when(F.col("year") < first_year, "closed_year").when(F.col("refused").isNotNull(), F.col("refused")) \
        .when(F.col("official_through").isNull(), "no_official_rows")
    work = F.coalesce(F.col("rows_added") + F.col("rows_replaced"), zero) > 0
    moved = (F.col("year") == F.lit(open_year)) & ~F.col("official_through").eqNullSafe(F.col("_recorded"))
    report = asked.join(bounds, "year", "left").join(changes, "year", "left").join(recorded, "year", "left").join(
        refused, "year", "left").select(
        "year", state.alias("refused"), "official_through", F.coalesce("rows_added", zero).alias("rows_added"),
        F.coalesce("rows_replaced", zero).alias("rows_replaced"), zero.alias("rows_dropped"), "first_date", "last_date",
        (F.lit(apply) & state.isNull() & F.coalesce(work | moved, F.lit(False))).alias("written"))
    report = materialise(report, "report")
    settled = report.where(F.col("refused").isNull())
    final = held
    facts = settled.select("year", "rows_added", "rows_replaced", "written").collect()         # a row per year
    busy = [r.year for r in facts if r.rows_added + r.rows_replaced > 0]
    if busy:
        good = write.where(F.year("Date").isin(*busy))
        final = save_kr_bars(lake, good, limits=limits, apply=apply).unionByName(
            pruned(held, "year", [y for y in named if y not in busy]), allowMissingColumns=True)
    if any(r.written for r in facts):
        now = settled.where("written")
        kept = lake.read(lake.boundary()).join(now, "year", "left_anti").select("year", "official_through")
        upsert_state(lake.boundary(), materialise(kept.unionByName(now.select("year", "official_through")), "boundary"))
        entry = now.select("year", F.current_timestamp().alias("at"), "official_through", "rows_added", "rows_replaced",
                           "rows_dropped", "first_date", "last_date")
        upsert_state(lake.settlement_log(), append_log(lake.read(lake.settlement_log()), entry))
    checked = _reconciled_years(final, source, bounds, floor)
    out = materialise(report.join(checked, "year", "left"), "settled")
    wrong = out.where(F.col("refused").isNotNull() & ~F.col("refused").isin("closed_year", "no_official_rows"))
    if refuse and (first := wrong.orderBy("year").first()):
        raise G.GateRefused(first.refused, {k: str(v) for k, v in first.asDict().items()})
    return out


def _reconciled_years(final: DataFrame, source: DataFrame, bounds: DataFrame, floor: Column) -> DataFrame:
    """Stored rows against official ones, a row per year: missing, extra and differing keys up to the year's boundary."""
    values = ["Open", "High", "Low", "Close", "Volume"]
    mine = by_year(final.where(F.col("Date") >= floor).select("Code", "Date", *values), "Date").join(bounds, "year").where(
        F.col("Date") <= F.col("official_through")).withColumn("_f", F.lit(True)).alias("f")
    wanted = source.where(F.col("Date") >= floor).select("Code", "Date", "year", *values).withColumn(
        "_o", F.lit(True)).alias("o")
    rows = wanted.join(mine, ["Code", "Date", "year"], "full")
    differs = F.lit(False)
    for v in values:
        differs = differs | ~same_value(F.col(f"o.{v}"), F.col(f"f.{v}"))
    both = F.col("_o").isNotNull() & F.col("_f").isNotNull()
    return rows.groupBy("year").agg(
        F.count_if(F.col("_f").isNull()).alias("missing_rows"), F.count_if(F.col("_o").isNull()).alias("extra_rows"),
        F.count_if(both & differs).alias("mismatched_rows"))


def kr_daily(
    lake: Lake, today: str, status: DataFrame, snapshot: DataFrame | None, archive: DataFrame, secondary: DataFrame,
    official: DataFrame | None = None, floor: Column | None = None, limits: Limits = Limits(),
    proof: DataFrame | None = None,
) -> DataFrame:
    """One KR day: fill missed sessions, save today's snapshot with supplements, settle, report.

    ``archive`` holds past snapshots, ``secondary`` candidate rows of the second provider (any dates), ``snapshot``
    today's rows or None when the source failed, ``proof`` (source_date) the date its source declared; with it the
    snapshot must carry that date, and codes and markets of a snapshot must be of the known forms.  Returns the calendar status on a closed day.
    """
    spark, day = lake.spark, F.lit(today).cast("date")
    session = status.where(F.col("date") == day)
    if session.where(F.col("status") == "closed").limit(1).count():
        return session
    table = lake.bars("kr")
    table.create(spark)
    year = int(today[:4])

    last = materialise(lake.ends(table).agg(F.max("last").alias("date")), "last")     # over all years
    held_from = last.select(F.year("date")).first()[0]

    def reference() -> DataFrame:
        """Stored rows of the years from the one before the last stored session on: what baselines look at."""
        return lake.read(table).where(F.col("year") >= min(held_from or year, year) - 1).drop("year")

    def same_dates(rows: DataFrame) -> DataFrame:
        """Stored rows of the years some rows lie in, however long ago: what their closes are compared with."""
        return pruned(lake.read(table), "year", partition_values(rows.select(F.year("Date").alias("year")), "year")).drop("year")

    missed = materialise(C.gap_since_last(last, status, day).select(F.col("date").alias("Date")), "missed")
    past = archive.join(missed, "Date", "left_semi")
    accepted = G.session_acceptance(past, "Date", "Marcap").select("Date", F.col("ok").alias("_full"))
    covered = G.write_coverage(past, reference(), missed, "Code", "Date", limits.drop_pct, limits.min_universe)
    judged = missed.join(accepted, "Date", "left").join(covered.select("Date", F.col("ok").alias("_wide")), "Date", "left")
    verdict = judged.select("Date", (F.coalesce("_full", F.lit(False)) & F.coalesce("_wide", F.lit(False))).alias("ok"))
    filled = materialise(CU.accept_prefix(verdict, "Date"), "filled")
    if filled.limit(1).count():
        save_kr_bars(lake, past.join(filled, "Date", "left_semi"), limits=limits)
    rest = missed.join(filled, "Date", "left_anti")
    if rest.limit(1).count():
        window = secondary.join(rest, "Date", "left_semi")
        gap_rows = _verified(secondary, same_dates(secondary), window)
        if gap_rows.limit(1).count():
            save_kr_bars(lake, gap_rows, prices_only=True, limits=limits)

    fallback = snapshot is None or not snapshot.limit(1).count()
    current = secondary.where(F.col("Date") == day)
    if not fallback:
        checks = [("snapshot", validate_snapshot(snapshot, "Code", "MarketId", F.col("Date")))]
        if proof is not None:
            checks.append(("source_date", undated_rows(snapshot, proof, "Date")))
        G.require_all(checks)
    if fallback:
        rows = _verified(secondary, same_dates(secondary), current)
    else:
        gone = CU.missing_today(reference(), snapshot, "Code", "Date", day, "Name", "Market").select("Code")
        extra = _verified(secondary, same_dates(secondary), current.join(gone, "Code", "left_semi"))
        ranked = O.rank_within(snapshot.drop("Rank").withColumn("Market", R.market_name(F.col("MarketId"))),
                               ["Date", "Market"], "Marcap", "Rank")
        rows = M.first_source([conform(ranked, KR_BARS), conform(extra, KR_BARS)], ["Code", "Date"])
    rows = materialise(conform(rows, KR_BARS), "today")
    G.require("nothing_collected", rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("ok", F.col("rows") > 0))
    verdict = materialise(G.daily_coverage(rows, reference(), "Code", "Date", drop_pct=limits.drop_pct,
                                           min_universe=limits.min_universe), "coverage")
    G.require("daily_coverage", verdict)
    save_kr_bars(lake, rows, prices_only=fallback, limits=limits)
    if official is not None:
        years = [year - 1, year] if today[5:7] == "01" else [year]
        settle_kr_years(lake, official, years, floor, limits=limits, open_year=year)
        held = lake.read(table).where(F.col("year") == year)
        bound = lake.read(lake.boundary()).where(F.col("year") == year)
        G.require("official_late", G.provisional_sessions(held, bound, "Date", floor))
    return RP.coverage_metrics(verdict, "Date")


def _verified(candidate: DataFrame, reference: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted rows of entities whose earlier closes agree with the stored ones."""
    states = G.verify_entities(candidate, reference, "Code", "Date")
    good = states.where(F.col("state") == "verified").select("Code")
    return wanted.join(good, "Code", "left_semi")


def kr_backfill(
    lake: Lake, candidate: DataFrame, start: Column, end: Column, keep_from: Column | None = None,
    limits: Limits = Limits(), official: DataFrame | None = None, floor: Column | None = None,
) -> DataFrame:
    """Past KR bars of the second provider, kept for entities that agree with stored closes.

    With ``official`` the years written are settled afterwards.  Returns evidence.
    """
    table = lake.bars("kr")
    table.create(lake.spark)
    derived = O.with_changes(candidate.drop("Changes", "ChangesRatio"), "Code", "Date", "Close", "Changes",
                             "ChangesRatio").withColumn("Amount", F.col("Close") * F.col("Volume"))
    rows = materialise(R.positive_close(derived), "candidate")
    dated = partition_values(rows.select(F.year("Date").alias("year")), "year")
    states = materialise(G.verify_entities(rows, pruned(lake.read(table), "year", dated), "Code", "Date"), "states")
    kept = G.accepted_rows(rows, states, "Code", "Date", start if keep_from is None else keep_from)
    _refuse_rows("dates_outside_request", R.outside_range(kept, "Date", start, end))
    save_kr_bars(lake, kept, prices_only=True, limits=limits)
    if official is not None:
        years = partition_values(kept.select(F.year("Date").alias("year")), "year")
        settle_kr_years(lake, official, years, floor, limits=limits)
    return G.evidence(states)


def save_fundamentals(lake: Lake, market: str, kind: str, feed: DataFrame, apply: bool = True) -> DataFrame:
    """Coalesce-merge financials or ratios; every touched year is validated before any is written."""
    ratios = kind == "ratios"
    table = lake.ratios(market) if ratios else lake.financials(market)
    table.create(lake.spark)
    date, schema = ("SnapDate", RATIOS) if ratios else ("PeriodDate", FINANCIALS)
    measures = [f.name for f in schema.fields if f.dataType.typeName() == "double"]
    year, quarter = (None, None) if ratios else ("Year", "Quarter")
    rows = conform(feed, schema)
    rows = infinity_to_null(rows, measures) if ratios else rows
    G.require("feed", validate_fundamentals(rows, "Ticker", date, measures, year, quarter))
    feed_rows = by_year(rows, date, table.partition)
    current = touched(lake.read(table), feed_rows, table.partition)
    merged = M.merge_coalesce(current.drop(table.partition), rows, ["Ticker", date])
    candidate = by_year(conform(merged, schema), date, table.partition)
    return _save(candidate, table, [("candidate", lambda staged: validate_fundamentals(
        staged, "Ticker", date, measures, year, quarter))], apply)


def kr_fundamentals(
    lake: Lake, accounts: DataFrame, universe: DataFrame, today: Column, apply: bool = True,
    requests: DataFrame | None = None, proof: DataFrame | None = None,
) -> DataFrame:
    """Quarterly fundamentals of the verified universe from landed account rows, in one plan.

    ``accounts`` are response rows (code, year, report_key, statement columns); ``universe`` is (Code, Stocks).
    ``proof`` is the verdict of ``verify_universe`` on it and ``requests`` (failed) says which requests brought
    nothing: an unproven universe, or failures at the limit, refuse the run before anything is read or written.
    """
    if proof is not None:
        G.require("universe", proof)
    if requests is not None:
        G.require("failure_rate", A.failure_rate(requests, F.col("failed")))
    table = lake.financials("kr")
    table.create(lake.spark)
    chosen = accounts.join(universe.select(F.col("Code").alias("code")), "code", "left_semi")
    due = FU.target_quarters(chosen.select("year").distinct(), today).select(
        "year", F.col("Quarter").alias("report_key"))
    sums = FU.extract_accounts(chosen, ["code", "year", "report_key"], FU.QUARTER_ACCOUNTS)
    existing = lake.read(table).select("Ticker", "Year", "Quarter")
    rows = FU.quarterly_rows(sums, existing, universe, today)
    ready = rows.join(due.select(F.col("year").alias("Year"), F.col("report_key").alias("Quarter")),
                      ["Year", "Quarter"], "left_semi")
    return save_fundamentals(lake, "kr", "financials", ready, apply)


def save_tags(
    lake: Lake, market: str, observed: DataFrame, failures: DataFrame, limits: Limits = Limits(), apply: bool = True,
) -> DataFrame:
    """Instrument tags with failed observations restored; an empty or shrunken collection is refused."""
    table = lake.tags(market)
    table.create(lake.spark)
    prior = lake.read(table)
    fields = ["Sector", "Industry", "QuoteType"]
    _refuse_rows("unknown_field", M.unknown_failed_fields(failures, fields))
    rows = M.preserve_failed_fields(conform(observed, TAGS), prior, failures, "Ticker", fields)
    gates: list[Gate] = [("tags", validate_tags), ("empty", lambda df: df.agg(
        F.count(F.lit(1)).alias("rows")).withColumn("ok", F.col("rows") > 0))]
    if not limits.allow_shrink:
        gates.append(("shrink", lambda df: G.shrink_guard(prior, df, "Ticker", tolerance_pct=limits.shrink_pct)))
    return _save(rows, table, gates, apply)


def save_month_prices(lake: Lake, prices: DataFrame) -> DataFrame:
    """Month-partitioned prices, last writer wins; rows without a positive close are dropped."""
    return _upsert_months(lake, lake.month_prices(), prices.where(finite(F.col("close")) & (F.col("close") > 0)))


def _upsert_months(lake: Lake, table: Table, rows: DataFrame) -> DataFrame:
    table.create(lake.spark)
    feed = by_month(conform(rows, table.schema))
    merged = M.merge_last(touched(lake.read(table), feed, "yyyymm"), feed, table.keys)
    return publish(merged, table)


def month_snapshots(lake: Lake, daily: DataFrame, first: str, last: str) -> DataFrame:
    """Month-end snapshots of the months not done yet; ``daily.date`` is YYYYMMDD text, stored as YYYYMM."""
    done = lake.checkpoints()
    done.create(lake.spark)
    finished = lake.read(done)
    wanted = C.missing_months(finished, lake.spark, first, last, "market")
    dated = daily.withColumn("_d", F.to_date("date", "yyyyMMdd"))
    ends = O.month_end_snapshot(dated, "_d").join(wanted.select(F.col("key").alias("yyyymm")), "yyyymm", "left_semi")
    rows = ends.withColumn("date", F.col("yyyymm")).drop("yyyymm", "_d")
    saved = _upsert_months(lake, lake.month_snapshots(), rows)
    fresh = saved.select(F.lit("market").alias("dtype"), F.col("yyyymm").cast("string").alias("key"),
                         F.lit("done").alias("status")).distinct()
    upsert_state(done, M.merge_last(finished, fresh, ["dtype", "key"]))
    return saved


def rewrite(lake: Lake, market: str, limits: Limits = Limits(), apply: bool = True) -> DataFrame:
    """Pass every partition through the current rules; refused while a bad day remains.  Returns the report."""
    table = lake.bars(market)
    before = lake.read(table)
    years = partition_values(before, "year")
    deduped = M.dedup_feed(table.read(lake.spark, "_at"), ["Ticker", "Date"], [F.col("_at")]).drop("_at")    # the row written last stays
    after = by_year(conform(_with_ratio(_home_days(deduped, market)), BARS), "Date")
    report = materialise(RP.rewrite_report(before, after, "Ticker", "Date"), "rewrite")
    G.require("rewrite", report)
    _save(after, table, _bar_gates(before, table, limits), apply, years)
    return report


def audit_backfill(lake: Lake, market: str, after: Column, fix: bool = False) -> DataFrame:
    """Late starters of a market; ``fix`` queues the new ones for backfill."""
    lake.pending().create(lake.spark)
    ends = lake.ends(lake.bars(market))
    found = materialise(CU.backfill_audit(ends, lake.queue(market, "backfill"), "Ticker", "first", after), "audit")
    if fix:
        intent = _listed(found.where(F.col("state") == "new"), market, "backfill")
        _set_pending(lake, intent, intent.where(F.lit(False)))
    return found


def audit_kr(lake: Lake, until: Column) -> tuple[DataFrame, DataFrame]:
    """Year status and gap list of the KR panel."""
    rows = lake.read(lake.bars("kr"))
    return RP.year_report(rows, "Code", "Date", until), RP.gap_list(rows, "Date", until)
