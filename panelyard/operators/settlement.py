"""Settlement: provisional rows are replaced by official ones, column by column and idempotently."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.functions import direction_code, same_value
from panelyard.operators.merge import INCOMING, KEEP_IF_NULL, KEEP_IF_NULL_OR_ZERO, KR_POLICY, resolve
from panelyard.operators.ordered import rank_within
from panelyard.operators.rows import market_name


@dataclass(frozen=True)
class SettlementRules:
    """How each column of an official key is built, and what the merge keeps when a value is missing."""

    keys: Sequence[str]
    date: str
    measured: Sequence[str]                    # official value, else the stored one
    fill_only: Sequence[str] = ()              # stored value, else the official one
    derived: Mapping[str, Column] = field(default_factory=dict)  # from o.* (official), s.* (stored), t.* columns
    rank: str | None = None                    # recomputed by rank_measure within (date, rank_group)
    rank_measure: str | None = None
    rank_group: str | None = None
    policy: Mapping[str, str] = field(default_factory=dict)

    @property
    def values(self) -> list[str]:
        ranked = [self.rank] if self.rank else []
        return [*self.measured, *self.fill_only, *self.derived, *ranked]


# Settlement policy of the KR bar table.
KR_KEYS = ("Code", "Date")
KR_MEASURED = ("Open", "High", "Low", "Close", "Volume", "Amount", "Changes", "ChangesRatio", "Marcap", "Stocks")
KR_FILL_ONLY = ("Name", "Dept", "MarketId")


def kr_rules() -> SettlementRules:
    """Market follows the market id where none is stored; ChangeCode keeps limit codes of the same direction."""
    market = F.coalesce(F.col("s.Market"), market_name(F.coalesce(F.col("s.MarketId"), F.col("o.MarketId"))))
    change = F.coalesce(F.col("o.Changes"), F.col("s.Changes"))
    return SettlementRules(
        keys=KR_KEYS, date="Date", measured=KR_MEASURED, fill_only=KR_FILL_ONLY,
        derived={"Market": market, "ChangeCode": direction_code(change, F.col("s.ChangeCode"))},
        rank="Rank", rank_measure="Marcap", rank_group="Market", policy=KR_POLICY)


def settlement_window(stored: DataFrame, official: DataFrame, rules: SettlementRules, floor: Column) -> DataFrame:
    """Official rows since the floor beside the stored rows of the same dates, as columns ``o.*`` and ``s.*``."""
    window = official.where(F.col(rules.date) >= floor).withColumn("_o", F.lit(True))
    dates = window.select(rules.date).distinct()
    mine = stored.join(dates, rules.date, "left_semi").withColumn("_s", F.lit(True))
    return window.alias("o").join(mine.alias("s"), list(rules.keys), "full")


def compare_settlement(
    stored: DataFrame, official: DataFrame, rules: SettlementRules, floor: Column
) -> DataFrame:
    """Every row of the window as it would be stored, with ``added``, ``changed`` and a flag per changed column.

    Stored rows the source lacks stay and take part in the ranking.  Differences are taken against the value the
    merge would really keep, so settling twice changes nothing.
    """
    keys = list(rules.keys)
    both = settlement_window(stored, official, rules, floor)
    fed, had = F.coalesce(F.col("o._o"), F.lit(False)), F.coalesce(F.col("s._s"), F.lit(False))

    def target(name: str) -> Column:
        if name in rules.measured:
            value = F.coalesce(F.col(f"o.{name}"), F.col(f"s.{name}"))
        elif name in rules.fill_only:
            value = F.coalesce(F.col(f"s.{name}"), F.col(f"o.{name}"))
        else:
            value = rules.derived[name]
        return F.when(fed, value).otherwise(F.col(f"s.{name}")).alias(name)

    plain = [v for v in rules.values if v != rules.rank]
    held = [F.col(f"s.{v}").alias(f"_was_{v}") for v in rules.values]
    rows = both.select(*keys, *[target(v) for v in plain], *held, (~had).alias("added"))
    if rules.rank:
        rows = rank_within(rows, [rules.date, rules.rank_group], rules.rank_measure, rules.rank,
                           cut=True)   # the full join above is computed once
    kept = []
    for v in rules.values:
        dtype = stored.schema[v].dataType
        policy = rules.policy.get(v, INCOMING)
        new, old = F.col(v).cast(dtype), F.col(f"_was_{v}")
        merged = resolve(policy, new, old) if policy in (KEEP_IF_NULL, KEEP_IF_NULL_OR_ZERO) else new
        kept.append(F.when(F.col("added"), new).otherwise(merged).alias(v))
    settled = rows.select(*keys, "added", *kept, *[F.col(f"_was_{v}") for v in rules.values])
    differs = {v: ~F.col("added") & ~same_value(F.col(v), F.col(f"_was_{v}")) for v in rules.values}
    changed = F.lit(False)
    for c in differs.values():
        changed = changed | c
    return settled.select(*keys, *rules.values, "added", changed.alias("changed"),
                          *[c.alias(f"_diff_{v}") for v, c in differs.items()])


def rows_to_write(compared: DataFrame, rules: SettlementRules) -> DataFrame:
    """Only the rows that are new or differ."""
    return compared.where(F.col("added") | F.col("changed")).select(*rules.keys, *rules.values)


def settlement_report(compared: DataFrame, official: DataFrame, rules: SettlementRules, floor: Column) -> DataFrame:
    """One row: boundary, dates, rows added and replaced, first and last changed date, changes per column."""
    touched = F.when(F.col("added") | F.col("changed"), F.col(rules.date))
    out = compared.agg(
        F.count_if("added").alias("rows_added"), F.count_if(F.col("changed") & ~F.col("added")).alias("rows_replaced"),
        F.min(touched).alias("first_date"), F.max(touched).alias("last_date"),
        *[F.count_if(f"_diff_{v}").alias(f"changed_{v}") for v in rules.values])
    bounds = official.agg(F.max(rules.date).alias("official_through"),
                          F.countDistinct(F.when(F.col(rules.date) >= floor, F.col(rules.date))).alias("dates"))
    return out.select(bounds.select("official_through").scalar().alias("official_through"),
                      bounds.select("dates").scalar().alias("dates"), *out.columns)


def reconcile_rows(
    final: DataFrame, official: DataFrame, keys: Sequence[str], date: str, values: Sequence[str], floor: Column
) -> DataFrame:
    """Rows between floor and boundary with their side: 'missing', 'extra' or 'both', and a flag per mismatch."""
    through = official.agg(F.max(date)).scalar()
    window = official.where(F.col(date) >= floor).select(*keys, *values).withColumn("_o", F.lit(True)).alias("o")
    mine = final.where((F.col(date) >= floor) & (F.col(date) <= through)).select(*keys, *values)\
        .withColumn("_f", F.lit(True)).alias("f")
    side = F.when(F.col("f._f").isNull(), "missing").when(F.col("o._o").isNull(), "extra").otherwise("both")
    return window.join(mine, list(keys), "full").select(*keys, side.alias("side"), *[
        ((side == "both") & ~same_value(F.col(f"o.{v}"), F.col(f"f.{v}"))).alias(f"mismatch_{v}") for v in values])


def reconcile(
    final: DataFrame, official: DataFrame, keys: Sequence[str], date: str, values: Sequence[str], floor: Column
) -> DataFrame:
    """One row of counts: missing / extra rows and dates, mismatches per value, repeated keys, final size."""
    rows = reconcile_rows(final, official, keys, date, values, floor)
    daily = rows.groupBy(date).agg(
        F.count_if(F.col("side") == "missing").alias("missing"), F.count_if(F.col("side") == "extra").alias("extra"),
        F.count_if(F.col("side") == "both").alias("both"),
        *[F.count_if(f"mismatch_{v}").alias(f"mismatch_{v}") for v in values])
    counts = final.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("final_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_keys"))
    return daily.agg(
        F.count_if((F.col("missing") > 0) & (F.col("both") + F.col("extra") == 0)).alias("missing_dates"),
        F.count_if((F.col("extra") > 0) & (F.col("both") + F.col("missing") == 0)).alias("extra_dates"),
        F.sum("missing").alias("missing_rows"), F.sum("extra").alias("extra_rows"),
        *[F.sum(f"mismatch_{v}").alias(f"mismatch_{v}") for v in values],
    ).withColumn("duplicate_keys", counts.select("duplicate_keys").scalar()).withColumn(
        "final_rows", counts.select("final_rows").scalar())


def boundary_of(table: DataFrame, year: int) -> DataFrame:
    """The official boundary recorded for a year."""
    return table.where(F.col("year") == year).agg(F.max("official_through").alias("official_through"))
