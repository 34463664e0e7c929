"""The delivery pipeline: screen batches, skip bad tables, merge, verify, report, and gate a release on decisions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.columns import salted_lookup
from panelforge.operators import compare, merge, panel, screens
from panelforge.operators.screens import Rules


@dataclass(frozen=True)
class Delivery:
    """Lazy results of one merge."""

    merged: DataFrame
    events: DataFrame
    skipped: DataFrame
    counts: DataFrame
    findings: DataFrame
    mismatches: DataFrame


def ordered(batches: DataFrame, order: list[str]) -> DataFrame:
    """Batches with seq by the given order; the base is 0. The order must name every batch once, however many there are."""
    if len(order) != len(set(order)):
        raise ValueError("the order names a batch twice")
    places = batches.sparkSession.createDataFrame([("base", 0), *[(b, i + 1) for i, b in enumerate(order)]], "batch string, seq long")
    named = batches.select("batch").distinct()
    odd = named.join(places, "batch", "left_anti").unionByName(places.where("seq > 0").select("batch").join(named, "batch", "left_anti")).limit(5).collect()
    if odd:
        raise ValueError(f"the order must name each batch once; it differs in {sorted(str(r[0]) for r in odd)}")
    return salted_lookup(batches.drop("seq"), places, ["batch"])


#: Findings that no decision waives, and those that need none. All others are for review.
ERRORS = ("repeated_cell", "blank_or_untrimmed_key", "repeated_key", "name_with_several_codes", "code_with_several_names", "no_valid_series")
INFOS = ("all_null_year", "sum_rule_coverage", "missing_by_class")


def severity(rule: Column) -> Column:
    return F.when(rule.isin(*ERRORS), "error").when(rule.isin(*INFOS), "info").otherwise("review")


def _finding(df: DataFrame, rule: str | None, year: str | None) -> DataFrame:
    """Rows as findings; their other columns, numbers above all, are the evidence, which names no batch."""
    kept = [c for c in df.columns if c not in ("batch", "rule", "role")]
    told = df.select(F.lit(rule).alias("rule") if rule else F.col("rule"), "batch", "table_name", F.col("code") if "code" in df.columns else F.lit(None).cast("string").alias("code"),
                     F.col(year).cast("int").alias("year") if year else F.lit(None).cast("int").alias("year"), F.to_json(F.struct(*kept)).alias("evidence"))
    return told


def _identified(parts: list[DataFrame]) -> DataFrame:
    every = reduce(DataFrame.unionByName, parts)
    key = F.to_json(F.struct("rule", "batch", "table_name", "code", "year", "evidence"))
    return every.withColumns({"severity": severity(F.col("rule")), "id": F.substring(F.sha2(key, 256), 1, 16)}).dropDuplicates(["id"])


def order_conflicts(batches: DataFrame, order: DataFrame, established: DataFrame) -> DataFrame:
    """Pairs of overlapping batches that a new order (batch, seq) turns round, or leaves undecided, against earlier decisions.

    established: earlier, later. A pair overlaps if both batches supply a table; pairs are told per table and never beyond it.
    """
    place = order.select("batch", F.col("seq").alias("at"))
    one = batches.where("batch <> 'base'").select("table_name", "batch").distinct().join(place, "batch", "left")
    known = established.select("earlier", "later").distinct()
    held = known.join(one.select(F.col("batch").alias("earlier"), "table_name", F.col("at").alias("a")), "earlier").join(one.select(F.col("batch").alias("later"), "table_name", F.col("at").alias("b")), ["later", "table_name"])
    turned = held.where("a > b").select("table_name", "earlier", "later", F.lit("order_turned_round").alias("why"))
    several = one.groupBy("table_name").agg(F.count("*").alias("n"), F.count("at").alias("placed"), F.min("batch").alias("earlier"), F.max("batch").alias("later")).where("n > 1 AND placed < n")
    return turned.unionByName(several.select("table_name", "earlier", "later", F.lit("overlap_without_order").alias("why"))).distinct()


def findings_of(rows: DataFrame, rules: Rules = Rules(), least: float | None = None, most: float | None = None, additive: bool = True) -> DataFrame:
    """Findings of every screen on the series of all batches: rule, severity, batch, table_name, code, year, evidence, a stable id."""
    moves = screens.transitions(rows, rules)
    return _identified([
        _finding(screens.interval_gaps(moves), "interval_gap", "to_year"), _finding(screens.internal_gaps(moves, rules), "internal_gap", "to_year"),
        _finding(screens.temporal_jumps(moves, rules), "temporal_jump", "to_year"), _finding(screens.sign_changes(moves), "sign_change", "to_year"),
        _finding(screens.spike_reversals(moves, rules), "spike_reversal", "year"), _finding(screens.flat_runs(rows, rules), "flat_run", "reached"),
        _finding(screens.unusual_movements(moves, rules).where("flagged"), "unusual_country_movement", "to_year"),
        _finding(screens.out_of_bounds(rows, least, most).drop("seq"), None, "year"), _finding(screens.empty_findings(rows), None, "year"),
        _finding(screens.cohort_changes(rows, additive, rules).where("aggregate_jump"), "aggregate_jump", "next_year"),
    ])


def comparison_findings(base: DataFrame, incoming: DataFrame, final: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Findings from holding panels against each other, final with origin: large revisions, cells that are missing, lost or new,
    scales, shifts, misplaced and exchanged entities, and jumps where origins meet."""
    cell = ["table_name", "entity", "code", "year"]
    both = compare.outcomes(base, incoming)
    delta = F.col("after") - F.col("before")
    revised = both.where("outcome = 'revised'").withColumns({"delta": delta, "relative": F.when(F.abs("before") >= rules.near_zero, F.try_divide(delta, F.abs("before")))})
    large = revised.where(screens.is_large(F.col("delta"), F.col("relative"), rules))
    named = lambda df, batch: df.withColumn("batch", F.lit(batch))
    swapped = screens.swaps(base, incoming, rules).withColumn("code", F.concat_ws(" <> ", "a", "b"))
    return _identified([
        _finding(named(large, "incoming"), "large_revision", "year"), _finding(named(both.where("outcome = 'incoming_missing'").select(*cell, "before"), "incoming"), "incoming_missing", "year"),
        _finding(named(screens.lost_findings(base, incoming), "incoming"), None, "year"),
        _finding(named(screens.scale_shares(base, incoming, rules).where("possible_scale_change"), "incoming"), "possible_scale_change", None),
        _finding(named(screens.year_shifts(base, incoming, rules), "incoming"), "possible_year_shift", None),
        _finding(named(screens.misplaced(base, incoming), "incoming"), "possible_country_misplacement", None),
        _finding(named(swapped, "incoming"), "possible_country_swap", None),
        _finding(named(screens.boundary_jumps(final, rules), "final"), "blending_boundary_jump", "to_year"),
    ])


def deliver(batches: DataFrame, rules: Rules = Rules(), skipped_before: DataFrame | None = None, discarded: DataFrame | None = None) -> Delivery:
    """Merge batches (batch, seq, table_name, entity, code, year, value); a table with a violation is skipped in its batch.

    Tables skipped in an earlier run (`skipped_before`: batch, table_name) stay skipped. Batches in `discarded` (batch,
    reason) are left out of a merge rebuilt from the base; a discard without a reason is an error.
    """
    if discarded is not None:
        if not discarded.where("coalesce(trim(reason), '') = ''").isEmpty():
            raise ValueError("a discarded batch needs a reason")
        batches = batches.join(discarded.select("batch").distinct(), "batch", "left_anti").select(*batches.columns)
    violations = panel.identity_violations(batches.select("batch", "table_name", "entity", "code", "year").distinct().select("batch", "table_name", "entity", "code").distinct(), ["batch", "table_name"])
    repeated = batches.groupBy("batch", "table_name", "entity", "code", "year").agg(F.count("*").alias("n")).where("n > 1").select("batch", "table_name", F.lit("repeated_cell").alias("rule"), F.concat_ws(" | ", "entity", "code").alias("key"), "n")
    skipped = violations.unionByName(repeated)
    if skipped_before is not None:
        skipped = skipped.unionByName(skipped_before.select("batch", "table_name", F.lit("skipped_before").alias("rule"), F.lit("").alias("key"), F.lit(None).cast("bigint").alias("n")))
    good = panel.without_violating(batches, skipped)
    merged = merge.consolidate(good)
    return Delivery(merged, merge.events(good), skipped, merge.batch_counts(good), findings_of(good, rules), merge.unequal(merge.replay(good), merged))


def quality(base: DataFrame, incoming: DataFrame, final: DataFrame, rules: Rules = Rules(), additive: bool = False) -> dict[str, DataFrame]:
    """The evidence collections of a quality run, as tables: summary, coverage, aggregates, comparisons, scales, swaps, checks,
    findings, observations. final may hold the origin of its cells; totals are told of tables declared additive only."""
    role = lambda df, r: df.select("table_name", "entity", "code", "year", "value").withColumns({"batch": F.lit(r), "role": F.lit(r)})
    every = role(base, "base").unionByName(role(incoming, "incoming")).unionByName(role(final, "final"))
    origin = final if "origin" in final.columns else final.withColumn("origin", F.lit(None).cast("string"))
    found = findings_of(every.drop("role"), rules, additive=additive).unionByName(comparison_findings(base, incoming, origin, rules))
    classified = compare.classify_findings(found.select(F.col("batch").alias("role"), "rule", F.col("evidence").alias("signature")))
    scales = screens.scale_shares(base, incoming, rules)
    moves = screens.transitions(every.drop("role"), rules)
    history = screens.unusual_movements(moves, rules).groupBy("batch", "table_name", "code").agg(F.count("*").alias("evaluated"))
    status = F.when(F.col("evaluated") > 0, "calculated").otherwise("insufficient_evidence")
    told = every.select("batch", "table_name", "code").distinct().join(history, ["batch", "table_name", "code"], "left").select("table_name", F.concat_ws(":", F.lit("historical_variability"), "batch", "code").alias("rule"), F.coalesce("evaluated", F.lit(0)).alias("evaluated"))
    checks = told.withColumn("status", status).unionByName(scales.select("table_name", F.concat(F.lit("scale:"), F.col("factor").cast("string")).alias("rule"), F.col("eligible").alias("evaluated"), "status"))
    return {
        "summary": every.groupBy("role", "table_name").agg(F.countDistinct("code").alias("entities"), F.count("value").alias("cells"), F.min("year").alias("first_year"), F.max("year").alias("last_year")),
        "coverage": compare.coverage(every, ["role", "table_name"]),
        "membership": screens.membership(every.drop("role"), rules),
        "aggregates": screens.cohort_changes(every.drop("role"), additive, rules),
        "available": screens.available_stats(every, ["role", "table_name"]),
        "comparisons": compare.outcomes(base, incoming),
        "scales": scales,
        "swaps": screens.swaps(base, incoming, rules),
        "checks": checks,
        "findings": found,
        "classified": classified,
        "observations": every.drop("batch"),
    }


#: What may be decided about a table. `hold` keeps the gate shut.
ACTIONS = ("prefer_new_non_null", "replace", "keep_old", "hold")


def gate(findings: DataFrame, decisions: DataFrame, accepted: DataFrame) -> DataFrame:
    """What keeps a release shut, as table_name, id and why; no row opens it. Nothing is taken to the driver.

    findings: id, severity, table_name. decisions: table_name, action, reason. accepted: id of review findings that were
    accepted. An error can't be waived; a review finding must be accepted; a table with findings needs one decision with an
    action, a reason, and not to be held; what is accepted must be a review finding.
    """
    one = findings.select("id", "severity", "table_name").distinct()
    taken = accepted.select("id").distinct()
    blank = F.lit(None).cast("string")
    errors = one.where("severity = 'error'").select("table_name", "id", F.lit("error").alias("why"))
    review = one.where("severity = 'review'")
    open_ = review.join(taken, "id", "left_anti").select("table_name", "id", F.lit("review finding not accepted").alias("why"))
    unknown = taken.join(review.select("id"), "id", "left_anti").select(blank.alias("table_name"), "id", F.lit("accepted, but no review finding").alias("why"))
    fine = F.col("action").isin(*ACTIONS) & (F.trim(F.coalesce("reason", F.lit(""))) != "")
    made = decisions.groupBy("table_name").agg(F.count("*").alias("n"), F.count_if(fine).alias("fine"), F.count_if(F.col("action") == "hold").alias("held"))
    asked = one.select("table_name").where("table_name IS NOT NULL").distinct().join(made, "table_name", "full")
    why = F.when(F.col("n").isNull(), "no decision").when(F.col("n") > 1, "several decisions").when(F.col("held") > 0, "held").when(F.col("fine") < 1, "no action or reason")
    undecided = asked.select("table_name", blank.alias("id"), why.alias("why")).where("why IS NOT NULL")
    return errors.unionByName(open_).unionByName(unknown).unionByName(undecided)


def report(delivery: Delivery, base: DataFrame, incoming: DataFrame, title: str, first: int = 40) -> str:
    """A short Markdown report: changes per table, counts by severity and rule, and the first findings that need attention.

    Tables are as many rows as the delivery has tables; only the list of findings, which is the report's feature, is cut.
    """
    changes = compare.change_counts(base, incoming, delivery.merged).orderBy("table_name").toLocalIterator()
    counts = delivery.findings.groupBy("severity", "rule").agg(F.count("*").alias("n")).orderBy("severity", "rule").collect()
    shown = delivery.findings.where("severity <> 'info'").orderBy("rule", "batch", "table_name", "code", "year").limit(first).collect()
    lines = [f"# {title}", "", "| table | added | revised | removed |", "|-|-|-|-|", *[f"| {r['table_name']} | {r['added']} | {r['revised']} | {r['removed']} |" for r in changes], "", "| severity | rule | findings |", "|-|-|-|", *[f"| {r['severity']} | {r['rule']} | {r['n']} |" for r in counts], ""]
    lines += [f"- [{r['severity']}] {r['rule']}: {r['batch']} {r['table_name']} {r['code']} {r['year']}" for r in shown]
    return "\n".join(lines) + "\n"
