"""Screens over series: gaps, jumps, runs, spikes, history, cohorts, scales, shifts, swaps and sums. They only report.

Each works on a long panel of `by` (the columns that make a series, entity and code among them), year and value. Windows run
within one series, whose length is the number of its years; nothing is gathered beyond that.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES = ["batch", "table_name", "entity", "code"]


@dataclass(frozen=True)
class Rules:
    """Thresholds of the screens. All are inclusive or strict as their screens say."""

    freq: int = 1
    jump: float = 0.5
    floor: float = 0.0
    near_zero: float = 1e-9
    flat_run: int = 6
    min_history: int = 5
    robust_z: float = 6.0
    factors: tuple[float, ...] = field(default=(1e-6, 1e-3, 1e-2, 1e2, 1e3, 1e6))
    tolerance: float = 0.02
    share: float = 0.8
    min_pairs: int = 10
    swap_years: int = 3
    swap_tolerance: float = 0.02
    improvement: float = 0.8
    reversal: float = 0.1

    def __post_init__(self) -> None:
        for name, v in vars(self).items():
            for x in v if isinstance(v, tuple) else (v,):
                if isinstance(x, bool) or x != x or x in (float("inf"), float("-inf")) or x < 0:
                    raise ValueError(f"{name} must be a finite number that isn't negative")
        for name in ("share", "improvement"):
            if getattr(self, name) > 1:
                raise ValueError(f"{name} can't exceed 1")


def transitions(panel: DataFrame, rules: Rules = Rules(), by: list[str] = SERIES) -> DataFrame:
    """Consecutive non-null observations: years, before, after, delta, relative, ratio, regular and the reason for a null relative."""
    order = Window.partitionBy(*by).orderBy("year")
    pairs = panel.where("value IS NOT NULL").withColumns({"from_year": F.lag("year").over(order), "before": F.lag("value").over(order)}).where("from_year IS NOT NULL")
    a, b = F.col("before"), F.col("value")
    delta = b - a
    finite = F.abs(delta) < F.lit(float("inf"))
    near = F.abs(a) < rules.near_zero
    return pairs.select(
        *by, "from_year", F.col("year").alias("to_year"), "before", b.alias("after"), F.when(finite, delta).alias("delta"),
        F.when(finite & ~near, F.try_divide(delta, F.abs(a))).alias("relative"), F.when(~near, F.try_divide(b, a)).alias("ratio"),
        (F.col("year") - F.col("from_year") == rules.freq).alias("regular"), (F.col("year") - F.col("from_year")).alias("step"),
        F.when(~finite, "arithmetic_overflow").when(near, "near_zero_denominator").alias("no_relative"),
    )


def is_large(delta: Column, relative: Column, rules: Rules) -> Column:
    """A move beyond the floor that is beyond the jump share, or whose share can't be told."""
    return F.coalesce(F.abs(delta) > rules.floor, F.lit(False)) & (relative.isNull() | (F.abs(relative) > rules.jump))


def interval_gaps(moves: DataFrame) -> DataFrame:
    """Pairs of observations that don't follow each other at the table's frequency."""
    return moves.where("NOT regular")


def internal_gaps(moves: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Pairs that lie further apart than the frequency; closer ones are neither gaps nor moves here."""
    return moves.where(F.col("step") > rules.freq)


def temporal_jumps(moves: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return moves.where("regular").where(is_large(F.col("delta"), F.col("relative"), rules))


def sign_changes(moves: DataFrame) -> DataFrame:
    return moves.where("regular").where(F.col("before") * F.col("after") < 0)


def out_of_bounds(panel: DataFrame, least: float | None, most: float | None) -> DataFrame:
    """Observations beyond inclusive bounds, with the rule."""
    why = F.when(F.lit(False), "")
    if least is not None:
        why = why.when(F.col("value") < least, "value_below_bound")
    if most is not None:
        why = why.when(F.col("value") > most, "value_above_bound")
    return panel.withColumn("rule", why).where("rule IS NOT NULL")


def flat_runs(panel: DataFrame, rules: Rules = Rules(), by: list[str] = SERIES) -> DataFrame:
    """One row per run of equal values at the table's frequency, at the observation where it reaches the length."""
    order = Window.partitionBy(*by).orderBy("year")
    step = panel.where("value IS NOT NULL").withColumn("_new", F.coalesce(((F.col("value") != F.lag("value").over(order)) | (F.col("year") - F.lag("year").over(order) != rules.freq)).cast("int"), F.lit(1)))
    island = step.withColumn("_run", F.sum("_new").over(order))
    at = island.withColumn("_k", F.row_number().over(Window.partitionBy(*by, "_run").orderBy("year")))
    return at.where(F.col("_k") == rules.flat_run).select(*by, F.col("year").alias("reached"), "value")


def spike_reversals(moves: DataFrame, rules: Rules = Rules(), by: list[str] = SERIES) -> DataFrame:
    """A large move that the next regular move takes back."""
    order = Window.partitionBy(*by).orderBy("to_year")
    nxt = moves.where("regular").withColumns({"next_delta": F.lead("delta").over(order), "back": F.lead("after").over(order), "next_from": F.lead("from_year").over(order)})
    rest = F.abs(F.col("back") - F.col("before")) / F.greatest(F.abs("delta"), F.lit(rules.near_zero))
    hit = is_large(F.col("delta"), F.col("relative"), rules) & (F.col("next_from") == F.col("to_year")) & (F.col("delta") * F.col("next_delta") < 0) & (rest <= rules.reversal)
    return nxt.where(hit).select(*by, F.col("to_year").alias("year"), "before", F.col("after").alias("spike"), "back")


def unusual_movements(moves: DataFrame, rules: Rules = Rules(), by: list[str] = SERIES) -> DataFrame:
    """Large moves judged by the median and median deviation of the series' own earlier relative moves."""
    past = Window.partitionBy(*by).orderBy("to_year").rowsBetween(Window.unboundedPreceding, -1)
    h = F.array_sort(F.collect_list("relative").over(past))
    told = moves.where("regular AND relative IS NOT NULL").withColumn("history", h).where(F.size("history") >= rules.min_history)

    def bound(c: Column, f: Callable[[Column], Column]) -> Column:
        """f of c, with c computed once rather than wherever f names it."""
        return F.get(F.transform(F.array(c), f), F.lit(0))

    def middle(xs: Column) -> Column:
        at = lambda ys, n: F.get(ys, F.floor(n / 2).cast("int"))
        return bound(xs, lambda ys: (at(ys, F.size(ys) - 1) + at(ys, F.size(ys))) / 2)

    centred = told.withColumn("center", middle(F.col("history")))
    spread = centred.withColumn("mad", bound(F.col("center"), lambda c: middle(F.array_sort(F.transform("history", lambda x: F.abs(x - c))))))
    away = F.abs(F.col("relative") - F.col("center"))
    scored = spread.withColumn("score", F.when(F.col("mad") > rules.near_zero, away / (1.4826 * F.col("mad"))))
    odd = is_large(F.col("delta"), F.col("relative"), rules) & F.when(F.col("score").isNotNull(), F.col("score") > rules.robust_z).otherwise(away > rules.jump)
    return scored.withColumn("flagged", odd).select(*by, "to_year", "relative", "center", "mad", "score", "flagged", F.size("history").alias("history"))


def available_stats(panel: DataFrame, by: list[str]) -> DataFrame:
    """Per cross-section: non-null members, total, mean and median; nulls with a reason where a total isn't finite."""
    got = panel.where("value IS NOT NULL").groupBy(*by, "year").agg(F.count("*").alias("members"), F.sum("value").alias("total"), F.avg("value").alias("mean"), F.median("value").alias("median"))
    fine = F.abs("total") < F.lit(float("inf"))
    return got.withColumns({"reason": F.when(~fine, "arithmetic_overflow"), "total": F.when(fine, F.col("total")), "mean": F.when(fine, F.col("mean")), "median": F.when(fine, F.col("median"))})


def adjacent_years(panel: DataFrame, by: list[str], freq: int) -> DataFrame:
    """Pairs of year columns that follow each other in a table's own list of years and lie freq apart."""
    order = Window.partitionBy(*by).orderBy("year")
    return panel.select(*by, "year").distinct().withColumn("next_year", F.lead("year").over(order)).where(F.col("next_year") - F.col("year") == freq)


def _paired(panel: DataFrame, by: list[str], keys: list[str], freq: int) -> DataFrame:
    pairs = adjacent_years(panel, by, freq)
    a = panel.select(*by, *keys, "year", F.col("value").alias("a"))
    b = panel.select(*by, *keys, F.col("year").alias("next_year"), F.col("value").alias("b"))
    left = pairs.join(a, [*by, "year"])
    right = pairs.join(b, [*by, "next_year"])
    return left.join(right, [*by, "year", "next_year", *keys], "full")


METRICS = ("total", "mean", "median")


def matched_stats(panel: DataFrame, rules: Rules = Rules(), by: list[str] = ["batch", "table_name"], keys: list[str] = ["entity", "code"]) -> DataFrame:
    """Totals and medians of the entities that both of two adjacent years hold, and whether their total jumps; for additive tables."""
    both = _paired(panel, by, keys, rules.freq).where("a IS NOT NULL AND b IS NOT NULL")
    got = both.groupBy(*by, "year", "next_year").agg(F.count("*").alias("members"), F.sum("a").alias("total_before"), F.sum("b").alias("total_after"), F.median("a").alias("median_before"), F.median("b").alias("median_after"))
    delta = F.col("total_after") - F.col("total_before")
    relative = F.when(F.abs("total_before") >= rules.near_zero, F.try_divide(delta, F.abs("total_before")))
    return got.withColumns({"relative": relative, "aggregate_jump": is_large(delta, relative, rules)})


def cohort_changes(panel: DataFrame, additive: bool, rules: Rules = Rules(), by: list[str] = ["batch", "table_name"], keys: list[str] = ["entity", "code"]) -> DataFrame:
    """Changes of total, mean and median between adjacent years, in the available and in the matched cohort.

    available: the entities that each year holds; matched: those that both hold, whose large changes are `aggregate_jump`.
    Totals exist only where additivity is declared; what isn't finite is null.
    """
    both = _paired(panel, by, keys, rules.freq)
    a, b = F.col("a"), F.col("b")
    inside = a.isNotNull() & b.isNotNull()

    def of(v: Column) -> list[Column]:
        total = F.sum(v) if additive else F.lit(None).cast("double")
        return [F.count(v), total, F.avg(v), F.median(v)]

    cohorts = {"available": (a, b), "matched": (F.when(inside, a), F.when(inside, b))}
    named = [c.alias(f"{name}_{side}_{stat}") for name, pair in cohorts.items() for side, v in zip(("before", "after"), pair) for stat, c in zip(("n", *METRICS), of(v))]
    got = both.groupBy(*by, "year", "next_year").agg(*named)
    finite = lambda c: F.when(F.abs(c) < F.lit(float("inf")), c)
    entry = lambda name, m: F.struct(F.lit(name).alias("cohort"), F.lit(m).alias("metric"), F.col(f"{name}_before_n").alias("members_before"), F.col(f"{name}_after_n").alias("members_after"), finite(F.col(f"{name}_before_{m}")).alias("before"), finite(F.col(f"{name}_after_{m}")).alias("after"))
    flat = got.select(*by, "year", "next_year", F.explode(F.array(*[entry(name, m) for name in cohorts for m in METRICS])).alias("_e")).select(*by, "year", "next_year", "_e.*")
    delta = F.col("after") - F.col("before")
    relative = F.when(F.abs("before") >= rules.near_zero, F.try_divide(delta, F.abs("before")))
    jump = (F.col("cohort") == "matched") & F.coalesce(is_large(delta, relative, rules), F.lit(False)) & delta.isNotNull()
    return flat.withColumns({"delta": delta, "relative": relative, "aggregate_jump": jump})


def membership(panel: DataFrame, rules: Rules = Rules(), by: list[str] = ["batch", "table_name"], keys: list[str] = ["entity", "code"]) -> DataFrame:
    """Entities that stay, enter and leave between adjacent years."""
    both = _paired(panel, by, keys, rules.freq)
    a, b = F.col("a").isNotNull(), F.col("b").isNotNull()
    return both.groupBy(*by, "year", "next_year").agg(F.count_if(a & b).alias("matched"), F.count_if(~a & b).alias("entering"), F.count_if(a & ~b).alias("leaving"))


def scale_shares(base: DataFrame, incoming: DataFrame, rules: Rules = Rules(), by: list[str] = ["table_name"], cell: list[str] = ["entity", "code", "year"]) -> DataFrame:
    """Per table and factor: comparable cells, those whose ratio is the factor within tolerance, their share and the status."""
    both = base.select(*by, *cell, F.col("value").alias("a")).join(incoming.select(*by, *cell, F.col("value").alias("b")), [*by, *cell]).where("a IS NOT NULL AND b IS NOT NULL AND a <> 0 AND b <> 0").where(F.abs("a") >= rules.near_zero)
    ratio = F.col("b") / F.col("a")
    hits = [F.count_if(F.abs(ratio / f - 1) <= rules.tolerance).alias(f"_{i}") for i, f in enumerate(rules.factors)]
    got = both.groupBy(*by).agg(F.count("*").alias("eligible"), *hits)
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("factor"), F.col(f"_{i}").alias("support")) for i, f in enumerate(rules.factors)]))
    flat = got.select(*by, "eligible", each.alias("_e")).select(*by, "eligible", "_e.factor", "_e.support")
    share = F.col("support") / F.col("eligible")
    return flat.withColumns({"share": share, "status": F.when(F.col("eligible") < rules.min_pairs, "insufficient_evidence").otherwise("calculated"), "possible_scale_change": (F.col("eligible") >= rules.min_pairs) & (share >= rules.share)})


def close(a: Column, b: Column, rel: float = 1e-9, abs_tol: float = 1e-12) -> Column:
    return F.abs(a - b) <= F.greatest(rel * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_tol))


def year_shifts(base: DataFrame, incoming: DataFrame, rules: Rules = Rules(), by: list[str] = ["table_name"], keys: list[str] = ["entity", "code"]) -> DataFrame:
    """Tables whose incoming values are the base's of the year `offset` earlier: offset, compared, shifted and same cells.

    Summed over all entities that both sides hold and whose base has three different values or more. A cell is compared where
    the base has a value in its own year and in the shifted one.
    """
    old = base.where("value IS NOT NULL").select(*by, *keys, "year", F.col("value").alias("s"))
    varied = old.groupBy(*by, *keys).agg(F.countDistinct("s").alias("_d")).where("_d >= 3").select(*by, *keys)
    here = incoming.where("value IS NOT NULL").select(*by, *keys, "year", F.col("value").alias("v")).join(varied, [*by, *keys], "left_semi").join(old, [*by, *keys, "year"])
    asked = here.withColumn("offset", F.explode(F.array(F.lit(-rules.freq), F.lit(rules.freq)))).withColumn("_y", F.col("year") - F.col("offset"))
    both = asked.join(old.select(*by, *keys, F.col("year").alias("_y"), F.col("s").alias("w")), [*by, *keys, "_y"])
    got = both.groupBy(*by, "offset").agg(F.count("*").alias("compared"), F.count_if(close(F.col("v"), F.col("w"))).alias("shifted"), F.count_if(close(F.col("v"), F.col("s"))).alias("same"))
    return got.where((F.col("compared") >= 5) & (F.col("shifted") / F.col("compared") >= 0.8) & ((F.col("shifted") - F.col("same")) / F.col("compared") >= 0.3))


def misplaced(base: DataFrame, incoming: DataFrame, table: list[str] = ["table_name"]) -> DataFrame:
    """Incoming series that equal, null cells included, exactly one other entity's base series over the shared years."""
    years = base.select(*table, "year").distinct().join(incoming.select(*table, "year").distinct(), [*table, "year"])
    sign = lambda df, name: df.join(years, [*table, "year"]).groupBy(*table, "code").agg(F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct("year", "value")))), 256).alias("sign"), F.count("value").alias("usable"), F.countDistinct("value").alias("distinct_values")).where("usable >= 5 AND distinct_values >= 3").select(*table, F.col("code").alias(name), "sign")
    owners = sign(base, "owner").groupBy(*table, "sign").agg(F.count("*").alias("_n"), F.min("owner").alias("owner")).where("_n = 1")
    met = sign(incoming, "code").join(owners, [*table, "sign"]).where("code <> owner")
    return met.select(*table, "code", "owner")


def swaps(base: DataFrame, incoming: DataFrame, rules: Rules = Rules(), by: list[str] = ["table_name"], min_years: int | None = None) -> DataFrame:
    """Pairs of entities of one table whose series fit the base better when exchanged.

    Not all pairs are looked at. Where the crossed error is within tolerance on average it is so in some year, and there the
    largest of the four values lies within twice the tolerance of its partner across. Values are put into logarithmic
    buckets of that width; a base value meets incoming values of its own and the next buckets only. No pair is lost.
    """
    cells = base.select(*by, "code", "year", F.col("value").alias("o")).join(incoming.select(*by, "code", "year", F.col("value").alias("n")), [*by, "code", "year"]).where("o IS NOT NULL AND n IS NOT NULL")
    width = 1 / max(1e-6, 1 - 2 * rules.swap_tolerance)

    def bucket(v: str) -> tuple[Column, Column]:
        size = F.abs(v)
        log = F.floor(F.ln(F.greatest(size, F.lit(rules.near_zero))) / math.log(width))
        return F.when(size <= rules.near_zero / max(1e-6, 1 - 2 * rules.swap_tolerance), F.lit(0)).otherwise(F.signum(v)).cast("int").alias("sign"), log.alias("bucket")

    left = cells.select(*by, "year", F.col("code").alias("a"), *bucket("o")).withColumn("bucket", F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1)))
    right = cells.select(*by, "year", F.col("code").alias("b"), *bucket("n"))
    met = left.join(right, [*by, "year", "sign", "bucket"]).where("a <> b")
    pairs = met.select(*by, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one = cells.select(*by, "year", F.col("code").alias("a"), F.col("o").alias("x"), F.col("n").alias("u"))
    two = cells.select(*by, "year", F.col("code").alias("b"), F.col("o").alias("y"), F.col("n").alias("v"))
    pair = pairs.join(one, [*by, "a"]).join(two, [*by, "b", "year"])
    s = F.greatest(F.abs("x"), F.abs("y"), F.abs("u"), F.abs("v"), F.lit(rules.near_zero))
    d = (F.abs(F.col("x") / s - F.col("u") / s) + F.abs(F.col("y") / s - F.col("v") / s)) / 2
    c = (F.abs(F.col("x") / s - F.col("v") / s) + F.abs(F.col("y") / s - F.col("u") / s)) / 2
    got = pair.groupBy(*by, "a", "b").agg(F.count("*").alias("years"), F.avg(d).alias("direct"), F.avg(c).alias("crossed"))
    gain = F.try_divide(F.col("direct") - F.col("crossed"), F.col("direct"))
    return got.where((F.col("years") >= (rules.swap_years if min_years is None else min_years)) & (F.col("crossed") <= rules.swap_tolerance) & (F.col("direct") > rules.swap_tolerance) & (gain >= rules.improvement))


def sum_rule(panel: DataFrame, total: str, parts: list[str], keys: list[str], rel: float = 1e-6, abs_tol: float = 1e-6) -> DataFrame:
    """Cells of the total table checked against the sum of its parts: checked, inconsistent, or skipped where any is null."""
    named = panel.where(F.col("table_name").isin(total, *parts))
    pick = lambda t: F.max(F.when(F.col("table_name") == t, F.col("value")))
    # Cells that the total table doesn't have aren't checked.
    got = named.groupBy(*keys, "year").agg(F.max(F.col("table_name") == total).alias("_there"), pick(total).alias("total"), *[pick(p).alias(f"_{i}") for i, p in enumerate(parts)]).where("_there")
    added = sum((F.col(f"_{i}") for i in range(len(parts))), F.lit(0.0))
    state = F.when(F.col("total").isNull() | added.isNull(), "skipped").when(close(F.col("total"), added, rel, abs_tol), "consistent").otherwise("inconsistent")
    return got.select(*keys, "year", "total", added.alias("sum_of_parts"), state.alias("status"))


def boundary_jumps(merged: DataFrame, rules: Rules = Rules(), by: list[str] = ["table_name", "entity", "code"]) -> DataFrame:
    """Jumps of a merged panel between two observations of different origin."""
    order = Window.partitionBy(*by).orderBy("year")
    origin = merged.where("value IS NOT NULL").withColumn("from_origin", F.lag("origin").over(order)).select(*by, F.col("year").alias("to_year"), "from_origin", "origin")
    return temporal_jumps(transitions(merged, rules, by), rules).join(origin, [*by, "to_year"]).where("from_origin <> origin").select(*by, "from_year", "to_year", "before", "after", "from_origin", "origin")


def empty_findings(panel: DataFrame, by: list[str] = ["batch", "table_name"], keys: list[str] = ["entity", "code"]) -> DataFrame:
    """Entities and years of a table without any observation: rule (all_null_country, all_null_year), table, entity, code and year."""
    none = F.count("value") == 0
    who = panel.groupBy(*by, *keys).agg(none.alias("_none")).where("_none").select(F.lit("all_null_country").alias("rule"), *by, *keys, F.lit(None).cast("int").alias("year"))
    empty = [F.lit(None).cast("string").alias(k) for k in keys]
    when = panel.groupBy(*by, "year").agg(none.alias("_none")).where("_none").select(F.lit("all_null_year").alias("rule"), *by, *empty, "year")
    return who.unionByName(when)


def lost_findings(base: DataFrame, incoming: DataFrame, by: list[str] = ["table_name"], keys: list[str] = ["entity", "code"]) -> DataFrame:
    """What an incoming panel lacks or brings anew: new_table, historical_years_absent (base years without a column), and
    lost_observation (cells of entities and years that the incoming table has, but empty)."""
    tables = incoming.select(*by).distinct()
    old = base.select(*by).distinct()
    blank = [F.lit(None).cast("string").alias(k) for k in keys]
    fresh = tables.join(old, by, "left_anti").select(F.lit("new_table").alias("rule"), *by, *blank, F.lit(None).cast("int").alias("year"))
    years = base.select(*by, "year").distinct().join(tables, by, "left_semi").join(incoming.select(*by, "year").distinct(), [*by, "year"], "left_anti")
    absent = years.select(F.lit("historical_years_absent").alias("rule"), *by, *blank, "year")
    held = base.where("value IS NOT NULL").select(*by, *keys, "year").join(incoming.where("value IS NULL").select(*by, *keys, "year"), [*by, *keys, "year"], "left_semi")
    return fresh.unionByName(absent).unionByName(held.select(F.lit("lost_observation").alias("rule"), *by, *keys, "year"))


def sum_coverage(checked: DataFrame) -> DataFrame:
    """How many cells a sum rule checked, found inconsistent and skipped."""
    return checked.agg(F.count_if(F.col("status") != "skipped").alias("checked"), F.count_if(F.col("status") == "inconsistent").alias("inconsistent"), F.count_if(F.col("status") == "skipped").alias("skipped"))
