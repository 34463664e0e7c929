"""Queries over the population series and their snapshots: merging, comparing and screening whole tables, each with SQL.

The snapshots of a table are ordered batches of the years 2022 and 2023; the wide series are one panel of twenty years.
Codes are the keys, trimmed and in upper case; of rows sent twice the last received counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import compare, merge, metadata, preparation, screens
from panelforge.operators.screens import Rules
from panelforge.plans.reference import Query
from panelforge.session import table
from panelforge.sources import files
from panelforge.sources.recipes import Indicator, Recipe

YEARS = [str(y) for y in range(2004, 2024)]
KEY = ["batch", "table_name", "entity", "code"]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str):
    def keep(f: Query) -> Query:
        _queries[f.__name__], _sql[f.__name__] = f, sql
        return f

    return keep


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def _long(rows: DataFrame, keys: list[str], years: list[str]) -> DataFrame:
    """Of rows with equal keys the last received, as cells."""
    coded = rows.withColumn("code", F.upper(F.trim("FIPS_CODE"))).where("code <> ''")
    last = coded.groupBy(*keys, "code").agg(F.max(F.struct("received_at", "row_id", *[F.col(f"`{y}`") for y in years])).alias("_r"))
    wide = last.select(*keys, "code", *[F.col(f"_r.`{y}`").alias(y) for y in years])
    return wide.unpivot([*keys, "code"], [F.col(f"`{y}`") for y in years], "year", "value").withColumns({"year": F.col("year").cast("int"), "entity": F.col("code")})


def snapshots(spark: SparkSession, d: str) -> DataFrame:
    """batch, seq, table_name, entity, code, year, value of all snapshots; the first is the base."""
    cells = _long(table(spark, d, "seriesdemopopulation_snapshots"), ["table_name", "snapshot_no"], ["2022", "2023"])
    name = F.when(F.col("snapshot_no") == 0, "base").otherwise(F.format_string("s%03d", "snapshot_no"))
    return cells.select(name.alias("batch"), F.col("snapshot_no").alias("seq"), "table_name", "entity", "code", "year", "value")


def series(spark: SparkSession, d: str) -> DataFrame:
    return _long(table(spark, d, "seriesdemopopulation"), ["table_name"], YEARS).select(F.lit("base").alias("batch"), "table_name", "entity", "code", "year", "value")


def _part(rows: DataFrame, batch: str) -> DataFrame:
    return rows.where(F.col("batch") == batch).drop("batch", "seq")


SNAP = """
last_ AS (SELECT table_name, snapshot_no, upper(trim(FIPS_CODE)) AS code, "2022", "2023" FROM seriesdemopopulation_snapshots WHERE upper(trim(FIPS_CODE)) <> ''
  QUALIFY row_number() OVER (PARTITION BY table_name, snapshot_no, upper(trim(FIPS_CODE)) ORDER BY received_at DESC, row_id DESC) = 1),
bt AS (SELECT CASE snapshot_no WHEN 0 THEN 'base' ELSE printf('s%03d', snapshot_no) END AS batch, snapshot_no AS seq, table_name, code AS entity, code, y.year, CASE y.year WHEN 2022 THEN "2022" ELSE "2023" END AS value
  FROM last_, (SELECT CAST(unnest([2022, 2023]) AS INT) AS year) y),
old AS (SELECT * FROM bt WHERE batch = 'base'), new AS (SELECT * FROM bt WHERE batch = 's001'),
mg AS (SELECT table_name, entity, code, year, max_by(value, seq) FILTER (WHERE value IS NOT NULL) AS value, coalesce(max_by(batch, seq) FILTER (WHERE value IS NOT NULL), 'base') AS origin FROM bt GROUP BY ALL)"""

POP = f"""
w AS (SELECT table_name, upper(trim(FIPS_CODE)) AS code, {', '.join(f'"{y}"' for y in YEARS)} FROM seriesdemopopulation WHERE upper(trim(FIPS_CODE)) <> ''
  QUALIFY row_number() OVER (PARTITION BY table_name, upper(trim(FIPS_CODE)) ORDER BY received_at DESC, row_id DESC) = 1),
p AS (SELECT table_name, code, CAST(unnest([{', '.join(YEARS)}]) AS INT) AS year, unnest([{', '.join(f'"{y}"' for y in YEARS)}]) AS value FROM w),
v AS (SELECT *, lag(year) OVER o AS fy, lag(value) OVER o AS bv FROM p WHERE value IS NOT NULL WINDOW o AS (PARTITION BY table_name, code ORDER BY year)),
mv AS (SELECT table_name, code, fy AS from_year, year AS to_year, bv AS before, value AS after, value - bv AS delta, CASE WHEN abs(bv) >= 1e-9 THEN (value - bv) / abs(bv) END AS rel FROM v WHERE fy IS NOT NULL)"""
_LARGE = "abs(delta) > 0 AND (rel IS NULL OR abs(rel) > 0.5)"


# Snapshots as ordered batches ----------------------------------------------------------------------------------------


@query(f"WITH {SNAP} SELECT table_name, code, year, value, origin FROM mg")
def snapshots_merged(spark: SparkSession, d: str) -> DataFrame:
    return merge.consolidate(snapshots(spark, d)).drop("entity")


@query(f"""WITH {SNAP}, k AS (SELECT table_name, code, year, value, batch, row_number() OVER (PARTITION BY table_name, code, year ORDER BY CASE WHEN value IS NULL THEN 1 ELSE 0 END, seq DESC) AS n FROM bt),
r AS (SELECT table_name, code, year, value, CASE WHEN value IS NULL THEN 'base' ELSE batch END AS origin FROM k WHERE n = 1)
SELECT table_name, count(*) AS cells, count(*) FILTER (WHERE m.value IS DISTINCT FROM r.value OR m.origin IS DISTINCT FROM r.origin) AS unequal_cells FROM mg m FULL JOIN r USING (table_name, code, year) GROUP BY 1""")
def snapshots_verified(spark: SparkSession, d: str) -> DataFrame:
    """Per table the cells of the merge, and those in which its replay in another formulation differs."""
    b = snapshots(spark, d)
    merged = merge.consolidate(b)
    odd = merge.unequal(merged, merge.replay(b)).groupBy("table_name").agg(F.count("*").alias("n"))
    return merged.groupBy("table_name").agg(F.count("*").alias("cells")).join(odd, "table_name", "left").select("table_name", "cells", F.coalesce("n", F.lit(0)).alias("unequal_cells"))


@query(f"""WITH {SNAP}, o AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY table_name, code, year ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM bt)
SELECT batch, table_name, count(*) AS supplied, count(*) FILTER (WHERE b IS DISTINCT FROM value) AS changed, count(*) FILTER (WHERE b IS NULL) AS added, count(*) FILTER (WHERE b <> value) AS revised FROM o WHERE seq > 0 AND value IS NOT NULL GROUP BY ALL""")
def snapshots_batch_counts(spark: SparkSession, d: str) -> DataFrame:
    return merge.batch_counts(snapshots(spark, d))


@query(f"WITH {SNAP} SELECT table_name, code, year, max_by(value, seq) FILTER (WHERE value IS NOT NULL) AS value, coalesce(max_by(batch, seq) FILTER (WHERE value IS NOT NULL), 'base') AS origin FROM bt WHERE batch <> 's002' GROUP BY ALL")
def snapshots_discarded(spark: SparkSession, d: str) -> DataFrame:
    return merge.discard(snapshots(spark, d), ["s002"]).drop("entity")


@query(f"""WITH {SNAP}, j AS (SELECT m.table_name, o.value AS a, n.value AS i, m.value AS b FROM mg m LEFT JOIN old o USING (table_name, code, year) LEFT JOIN new n USING (table_name, code, year))
SELECT table_name, count(*) FILTER (WHERE a IS NULL AND b IS NOT NULL) AS added, count(*) FILTER (WHERE a <> b) AS revised, count(*) FILTER (WHERE a IS NOT NULL AND b IS NULL) AS removed,
count(*) FILTER (WHERE a = b) AS unchanged, count(*) FILTER (WHERE i IS NULL AND a IS NOT NULL AND b IS NOT NULL) AS backfilled, count(*) FILTER (WHERE a <> b AND (a = 0 OR abs(b - a) > 0.5 * abs(a))) AS large_revisions FROM j GROUP BY 1""")
def snapshots_change_counts(spark: SparkSession, d: str) -> DataFrame:
    b = snapshots(spark, d)
    return compare.change_counts(_part(b, "base"), _part(b, "s001"), merge.consolidate(b))


@query(f"""WITH {SNAP}, t AS (SELECT DISTINCT table_name, code FROM new), y AS (SELECT DISTINCT table_name, year FROM new),
j AS (SELECT coalesce(o.table_name, n.table_name) AS table_name, coalesce(o.code, n.code) AS code, coalesce(o.year, n.year) AS year, o.value AS before, n.value AS after FROM old o FULL JOIN new n ON o.table_name = n.table_name AND o.code = n.code AND o.year = n.year)
SELECT j.table_name, j.code, j.year, before, after, CASE WHEN before IS NULL THEN 'added' WHEN t.code IS NULL THEN 'missing_country' WHEN y.year IS NULL THEN 'old_only_year' WHEN after IS NULL THEN 'incoming_null' ELSE 'revised' END AS change_class
FROM j LEFT JOIN t ON t.table_name = j.table_name AND t.code = j.code LEFT JOIN y ON y.table_name = j.table_name AND y.year = j.year WHERE before IS DISTINCT FROM after""")
def snapshots_classes(spark: SparkSession, d: str) -> DataFrame:
    b = snapshots(spark, d)
    return compare.incoming_classes(_part(b, "base"), _part(b, "s001")).drop("entity")


@query(f"""WITH {SNAP}, l AS (SELECT *, lag(year) OVER w AS fy, lag(value) OVER w AS bv, lag(origin) OVER w AS bo FROM mg WHERE value IS NOT NULL WINDOW w AS (PARTITION BY table_name, code ORDER BY year))
SELECT table_name, code, fy AS from_year, year AS to_year, bv AS before, value AS after, bo AS from_origin, origin FROM l WHERE year - fy = 1 AND abs(value - bv) > 0 AND (abs(bv) < 1e-9 OR abs(value - bv) / abs(bv) > 0.05) AND bo <> origin""")
def snapshots_boundaries(spark: SparkSession, d: str) -> DataFrame:
    return screens.boundary_jumps(merge.consolidate(snapshots(spark, d)), Rules(jump=0.05)).drop("entity")


@query(f"""WITH {SNAP}, f AS (SELECT 'new_table' AS rule, table_name, CAST(NULL AS VARCHAR) AS code, CAST(NULL AS INT) AS year FROM (SELECT DISTINCT table_name FROM new) WHERE table_name NOT IN (SELECT table_name FROM old)
UNION ALL SELECT 'historical_years_absent', table_name, NULL, year FROM (SELECT DISTINCT table_name, year FROM old) o WHERE table_name IN (SELECT table_name FROM new) AND NOT EXISTS (SELECT 1 FROM new n WHERE n.table_name = o.table_name AND n.year = o.year)
UNION ALL SELECT 'lost_observation', o.table_name, o.code, o.year FROM old o JOIN new n ON n.table_name = o.table_name AND n.code = o.code AND n.year = o.year WHERE o.value IS NOT NULL AND n.value IS NULL) SELECT * FROM f""")
def snapshots_lost(spark: SparkSession, d: str) -> DataFrame:
    b = snapshots(spark, d)
    return screens.lost_findings(_part(b, "base"), _part(b, "s001")).drop("entity")


# The wide series ------------------------------------------------------------------------------------------------------


@query(f"WITH {POP} SELECT table_name, code, from_year, to_year, before, after FROM mv WHERE to_year - from_year = 1 AND {_LARGE}")
def population_jumps(spark: SparkSession, d: str) -> DataFrame:
    return screens.temporal_jumps(screens.transitions(series(spark, d))).select("table_name", "code", "from_year", "to_year", "before", "after")


@query(f"WITH {POP} SELECT table_name, count(*) FILTER (WHERE to_year - from_year > 1) AS gaps, count(*) FILTER (WHERE to_year - from_year = 1 AND before * after < 0) AS sign_changes, count(*) AS moves FROM mv GROUP BY 1")
def population_moves(spark: SparkSession, d: str) -> DataFrame:
    m = screens.transitions(series(spark, d))
    return m.groupBy("table_name").agg(F.count_if(F.col("step") > 1).alias("gaps"), F.count_if(F.col("regular") & (F.col("before") * F.col("after") < 0)).alias("sign_changes"), F.count("*").alias("moves"))


@query(f"""WITH {POP}, s AS (SELECT *, CASE WHEN value = bv AND year - fy = 1 THEN 0 ELSE 1 END AS brk FROM v), i AS (SELECT *, sum(brk) OVER (PARTITION BY table_name, code ORDER BY year) AS run FROM s),
n AS (SELECT *, row_number() OVER (PARTITION BY table_name, code, run ORDER BY year) AS k FROM i) SELECT table_name, code, year AS reached, value FROM n WHERE k = 4""")
def population_flat_runs(spark: SparkSession, d: str) -> DataFrame:
    return screens.flat_runs(series(spark, d), Rules(flat_run=4)).select("table_name", "code", "reached", "value")


@query(f"""WITH {POP}, r AS (SELECT *, lead(delta) OVER w AS nd, lead(after) OVER w AS back, lead(from_year) OVER w AS nf FROM mv WHERE to_year - from_year = 1 WINDOW w AS (PARTITION BY table_name, code ORDER BY to_year))
SELECT table_name, code, to_year AS year, before, after AS spike, back FROM r WHERE {_LARGE} AND nf = to_year AND delta * nd < 0 AND abs(back - before) / greatest(abs(delta), 1e-9) <= 0.1""")
def population_spikes(spark: SparkSession, d: str) -> DataFrame:
    return screens.spike_reversals(screens.transitions(series(spark, d))).select("table_name", "code", "year", "before", "spike", "back")


@query(f"""WITH {POP}, m AS (SELECT * FROM mv WHERE to_year - from_year = 1 AND rel IS NOT NULL),
h AS (SELECT *, median(rel) OVER q AS center, mad(rel) OVER q AS mad, count(rel) OVER q AS history FROM m WINDOW q AS (PARTITION BY table_name, code ORDER BY to_year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT *, CASE WHEN mad > 1e-9 THEN abs(rel - center) / (1.4826 * mad) END AS score FROM h WHERE history >= 5)
SELECT table_name, code, to_year, round(rel, 6) AS relative, history FROM s WHERE {_LARGE} AND CASE WHEN score IS NOT NULL THEN score > 6 ELSE abs(rel - center) > 0.5 END""")
def population_history(spark: SparkSession, d: str) -> DataFrame:
    told = screens.unusual_movements(screens.transitions(series(spark, d))).where("flagged")
    return told.select("table_name", "code", "to_year", F.round("relative", 6).alias("relative"), F.col("history").cast("bigint").alias("history"))


@query(f"""WITH {POP}, pr AS (SELECT a.table_name, a.year, a.value AS a, b.value AS b FROM p a JOIN p b ON a.table_name = b.table_name AND a.code = b.code AND b.year = a.year + 1),
g AS (SELECT table_name, year, count(a) AS na, count(b) AS nb, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS nm, median(a) AS ma, median(b) AS mb,
 median(a) FILTER (WHERE b IS NOT NULL) AS xa, median(b) FILTER (WHERE a IS NOT NULL) AS xb FROM pr GROUP BY ALL),
u AS (SELECT table_name, year, 'available' AS cohort, na AS members_before, nb AS members_after, ma AS before, mb AS after FROM g UNION ALL SELECT table_name, year, 'matched', nm, nm, xa, xb FROM g)
SELECT *, coalesce(cohort = 'matched' AND abs(after - before) > 0 AND (abs(before) < 1e-9 OR abs(after - before) / abs(before) > 0.5), false) AS aggregate_jump FROM u""")
def population_cohorts(spark: SparkSession, d: str) -> DataFrame:
    """Medians of the available and the matched cohort of adjacent years."""
    got = screens.cohort_changes(series(spark, d), False).where("metric = 'median'")
    return got.select("table_name", "year", "cohort", "members_before", "members_after", "before", "after", "aggregate_jump")


@query(f"WITH {POP}, a AS (SELECT 'all_null_country' AS rule, table_name, code, CAST(NULL AS INT) AS year FROM p GROUP BY table_name, code HAVING count(value) = 0 UNION ALL SELECT 'all_null_year', table_name, NULL, year FROM p GROUP BY table_name, year HAVING count(value) = 0) SELECT * FROM a")
def population_empty(spark: SparkSession, d: str) -> DataFrame:
    return screens.empty_findings(series(spark, d)).drop("batch", "entity")


@query(f"""WITH {POP}, ok AS (SELECT table_name, code FROM p WHERE value IS NOT NULL GROUP BY ALL HAVING count(DISTINCT value) >= 3), inc AS (SELECT table_name, code, year + 1 AS year, value FROM p WHERE value IS NOT NULL),
j AS (SELECT i.table_name, o.off AS offset_, i.value AS v, s.value AS s, w_.value AS w FROM inc i JOIN ok USING (table_name, code) JOIN p s ON s.table_name = i.table_name AND s.code = i.code AND s.year = i.year AND s.value IS NOT NULL, (SELECT unnest([-1, 1]) AS off) o
 JOIN p w_ ON w_.table_name = i.table_name AND w_.code = i.code AND w_.year = i.year - o.off AND w_.value IS NOT NULL),
g AS (SELECT table_name, offset_, count(*) AS compared, count(*) FILTER (WHERE abs(v - w) <= greatest(1e-9 * greatest(abs(v), abs(w)), 1e-12)) AS shifted, count(*) FILTER (WHERE abs(v - s) <= greatest(1e-9 * greatest(abs(v), abs(s)), 1e-12)) AS same FROM j GROUP BY ALL)
SELECT table_name, CAST(offset_ AS INT) AS "offset", compared, shifted, same FROM g WHERE compared >= 5 AND shifted / compared >= 0.8 AND (shifted - same) / compared >= 0.3""")
def population_year_shift(spark: SparkSession, d: str) -> DataFrame:
    """The series moved on by a year against themselves."""
    base = series(spark, d).drop("batch")
    return screens.year_shifts(base, base.withColumn("year", F.col("year") + 1))


@query("""WITH r AS (SELECT import_file, 'Series' || i.indicator AS table_name, c.ifs_fipscode AS code, regexp_replace(w.year, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS y, w.value, i.unit AS want, regexp_replace(w.unit, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS unit
 FROM (SELECT dataset AS import_file, * FROM download) w LEFT JOIN indicators i ON i.indicator = regexp_replace(w.indicator, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') LEFT JOIN country_data c ON c.ifs_fipscode = regexp_replace(w.code, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')),
x AS (SELECT *, regexp_full_match(value, '[ \\t]*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?[ \\t]*') AND isfinite(try_cast(trim(value, ' ' || chr(9)) AS DOUBLE)) AS num FROM r),
z AS (SELECT *, CASE WHEN table_name IS NULL THEN 'indicator' WHEN unit IS DISTINCT FROM want AND want IS NOT NULL THEN 'unit' WHEN code IS NULL THEN 'country' WHEN NOT coalesce(regexp_full_match(y, '[0-9]{4}') AND TRY_CAST(y AS INT) BETWEEN 1000 AND 2999, false) THEN 'year'
 WHEN value IS NOT NULL AND NOT regexp_full_match(value, '[\\s\\p{Z}]*') AND regexp_replace(value, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') <> '..' AND NOT coalesce(num, false) THEN 'value' END AS v FROM x),
d AS (SELECT *, count(*) FILTER (WHERE v IS NULL) OVER (PARTITION BY table_name, code, TRY_CAST(y AS INT)) AS k FROM z)
SELECT table_name, coalesce(v, CASE WHEN k > 1 THEN 'duplicate' END, 'loads') AS outcome, count(*) AS n FROM d GROUP BY ALL
UNION ALL SELECT 'Series' || indicator, 'absent', 1 FROM indicators WHERE indicator NOT IN (SELECT regexp_replace(indicator, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') FROM download WHERE indicator IS NOT NULL)""")
def long_delivery(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of each row of the download read by a strict recipe: per table how many load, or fail by which rule."""
    listed = table(spark, d, "indicators").collect()
    recipe = Recipe({r["indicator"]: Indicator("Series" + r["indicator"], r["unit"]) for r in listed}, missing=("..",))
    roster = table(spark, d, "country_data").select(F.col("ifs_name").alias("entity"), F.col("ifs_fipscode").alias("code"))
    told = files.load_long(table(spark, d, "download"), recipe, roster)
    return told.groupBy("table_name", F.coalesce("violation", F.lit("loads")).alias("outcome")).agg(F.count("*").alias("n"))


@query("SELECT ifs_name AS entity, ifs_fipscode AS code, ifs_fipscode AS source_code FROM country_data")
def country_reference(spark: SparkSession, d: str) -> DataFrame:
    return files.country_reference(table(spark, d, "country_data").select(F.col("ifs_name").alias("Country"), F.col("ifs_fipscode").alias("FIPS_CODE")))


# Metadata and preparation ---------------------------------------------------------------------------------------------


@query("""WITH t AS (SELECT row_id, regexp_replace(value, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS t FROM download),
n AS (SELECT *, coalesce(t = '' OR regexp_full_match(t, '(?i)[+-]?inf(inity)?'), true) AS empty, CASE WHEN regexp_full_match(t, '[+-]?[0-9]+(\\.0*)?') THEN TRY_CAST(regexp_replace(t, '\\.0*$', '') AS BIGINT) WHEN regexp_full_match(t, '[+-]?\\.0+') THEN 0
 WHEN regexp_full_match(t, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)[eE][+-]?[0-9]+') AND TRY_CAST(t AS DECIMAL(38,18)) = floor(TRY_CAST(t AS DECIMAL(38,18))) THEN TRY_CAST(TRY_CAST(t AS DECIMAL(38,18)) AS BIGINT) END AS num FROM t)
SELECT row_id, CASE WHEN NOT empty THEN num END AS number, NOT empty AND num IS NULL AS failed FROM n""")
def metadata_integers(spark: SparkSession, d: str) -> DataFrame:
    """The values of the download read as exact whole numbers."""
    number, failed = metadata.integer(F.col("value"))
    return table(spark, d, "download").select("row_id", number.alias("number"), F.coalesce(failed, F.lit(False)).alias("failed"))


_NEWEST = """nw AS (SELECT "Table", Variable, max("Last IFs Update") AS stamp, min("Last IFs Update") AS first_stamp, count(*) AS n FROM datadict GROUP BY ALL)"""


@query(f'WITH {_NEWEST} SELECT "Table", Variable, stamp, n FROM nw')
def metadata_newest(spark: SparkSession, d: str) -> DataFrame:
    """The update stamp of the newest row of each table and variable, and how many rows there were."""
    rows = table(spark, d, "datadict")
    top = metadata.newest(rows).select("Table", "Variable", F.col("`Last IFs Update`").alias("stamp"))
    return top.join(rows.groupBy("Table", "Variable").agg(F.count("*").alias("n")), ["Table", "Variable"])


@query("""WITH m AS (SELECT "Table" AS t, Variable AS v, count(*) AS n FROM datadict GROUP BY ALL), u AS (SELECT "Table" AS t, Variable AS v, trim(Units) AS u, * FROM datadict),
i AS (SELECT t AS table_name, 'duplicate_source' AS issue FROM m WHERE n > 1 UNION SELECT t, 'duplicate_base' FROM m WHERE n > 1
 UNION SELECT "Table", 'blank_required' FROM datadict WHERE regexp_full_match(coalesce("Table", ''), '\\s*') OR regexp_full_match(coalesce(Variable, ''), '\\s*') OR regexp_full_match(coalesce(Definition, ''), '\\s*') OR regexp_full_match(coalesce(Units, ''), '\\s*') OR regexp_full_match(coalesce(Source, ''), '\\s*')
 UNION SELECT "Table", 'several_source_units' FROM datadict GROUP BY 1 HAVING count(DISTINCT coalesce(Units, '')) > 1
 UNION SELECT a.t, 'units_changed' FROM u a JOIN u b ON a.t = b.t AND regexp_replace(a.Units, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') <> regexp_replace(b.Units, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')
 UNION SELECT DISTINCT table_name, 'missing_source_metadata' FROM seriesdemopopulation_snapshots WHERE table_name NOT IN (SELECT "Table" FROM datadict WHERE "Table" IS NOT NULL)) SELECT * FROM i""")
def metadata_merge_issues(spark: SparkSession, d: str) -> DataFrame:
    """What forbids merging the metadata with itself, for the tables of the snapshots."""
    rows = table(spark, d, "datadict")
    return metadata.merge_issues(rows, rows, table(spark, d, "seriesdemopopulation_snapshots")).distinct()


@query(f"""WITH {POP}, s AS (SELECT table_name, coalesce(concat(CAST(min(year) FILTER (WHERE value IS NOT NULL) AS VARCHAR), '-', CAST(max(year) FILTER (WHERE value IS NOT NULL) AS VARCHAR)), '') AS observed FROM p GROUP BY 1)
SELECT DISTINCT s.table_name, d.Years AS stated, observed FROM datadict d JOIN s ON s.table_name = d."Table" WHERE coalesce(d.Years, '') <> '' AND d.Years <> observed""")
def metadata_year_span(spark: SparkSession, d: str) -> DataFrame:
    return metadata.year_span_issues(table(spark, d, "datadict"), series(spark, d))


@query("""WITH o AS (SELECT "Table", Variable, lower(Units) AS Units, row_number() OVER () AS row_id FROM (SELECT DISTINCT "Table", Variable, Units FROM datadict WHERE "Table" IS NOT NULL AND Variable IS NOT NULL)),
b AS (SELECT "Table", count(DISTINCT coalesce(Units, '')) AS u, max(Units) AS un FROM datadict GROUP BY 1),
k AS (SELECT o."Table", o.Variable, CASE WHEN u = 1 AND lower(trim(regexp_replace(o.Units, '\\s+', ' ', 'g'))) = lower(trim(regexp_replace(un, '\\s+', ' ', 'g'))) THEN un ELSE o.Units END AS units, o.Units IS DISTINCT FROM un AND u = 1 AND un IS NOT NULL AND o.Units IS NOT NULL AS kept FROM o LEFT JOIN b ON b."Table" = o."Table")
SELECT "Table", Variable, units, kept FROM k""")
def metadata_plan(spark: SparkSession, d: str) -> DataFrame:
    """Incoming rows whose units are written in lower case, in the base's wording."""
    base = table(spark, d, "datadict").select("Table", "Variable", "Units", "Notes")
    once = base.where("`Table` IS NOT NULL AND Variable IS NOT NULL").select("Table", "Variable", "Units").distinct()
    incoming = once.withColumns({"row_id": F.xxhash64("Table", "Variable", "Units"), "Units": F.lower("Units")})
    planned, log = metadata.plan(base, incoming)
    kept = log.where("rule = 'retain_base_unit_label'").select("row_id", F.lit(True).alias("kept"))
    return planned.join(kept, "row_id", "left").select("Table", "Variable", F.col("Units").alias("units"), F.coalesce("kept", F.lit(False)).alias("kept"))


@query(f"WITH {SNAP}, o AS (SELECT table_name, code, year, batch, value FROM bt WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY table_name, code, year ORDER BY seq DESC) = 1) SELECT * FROM o")
def last_event(spark: SparkSession, d: str) -> DataFrame:
    """The last event of each cell."""
    seen = snapshots(spark, d).where("value IS NOT NULL")
    return metadata.last_events(seen, ["table_name", "code", "year"], ["seq"]).select("table_name", "code", "year", "batch", "value")


@query("""WITH l AS (SELECT DISTINCT upper(trim(FIPS_CODE)) AS code, trim(Country) AS label FROM seriesdemopopulation_snapshots WHERE trim(FIPS_CODE) <> '' AND trim(Country) <> '')
SELECT code, min(label) AS label FROM l GROUP BY 1 HAVING count(*) = 1""")
def code_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "seriesdemopopulation_snapshots").select(F.upper(F.trim("FIPS_CODE")).alias("code"), F.trim("Country").alias("label"))
    return preparation.code_labels(rows)[0]


@query("""WITH s AS (SELECT table_name, snapshot_no, upper(trim(FIPS_CODE)) AS code FROM seriesdemopopulation_snapshots WHERE upper(trim(FIPS_CODE)) <> '')
SELECT DISTINCT table_name, snapshot_no, code, 'unknown_code' AS issue FROM s WHERE code NOT IN (SELECT ifs_fipscode FROM country_data) UNION ALL SELECT table_name, snapshot_no, code, 'repeated_key' FROM s GROUP BY ALL HAVING count(*) > 1""")
def name_view_issues(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "seriesdemopopulation_snapshots").select("table_name", "snapshot_no", F.upper(F.trim("FIPS_CODE")).alias("code"), F.col("Country").alias("entity")).where("code <> ''")
    roster = table(spark, d, "country_data").select(F.col("ifs_name").alias("entity"), F.col("ifs_fipscode").alias("code"))
    return preparation.name_view(rows, roster, ["table_name", "snapshot_no"])[1]


@query("""WITH t AS (SELECT row_id, regexp_replace(value, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS t FROM download)
SELECT row_id, CASE WHEN regexp_full_match(t, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') AND isfinite(TRY_CAST(t AS DOUBLE)) THEN TRY_CAST(t AS DOUBLE) * 100 END AS value,
CASE WHEN t IS NOT NULL AND t <> '' AND NOT coalesce(regexp_full_match(t, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') AND isfinite(TRY_CAST(t AS DOUBLE)), false) THEN 'value' END AS violation FROM t""")
def fraction_percent(spark: SparkSession, d: str) -> DataFrame:
    cells = table(spark, d, "download").select(F.col("row_id").alias("key"), F.col("value").alias("raw"))
    return preparation.percentages(cells).select(F.col("key").alias("row_id"), "value", "violation")


@query("""WITH a AS (SELECT DISTINCT table_name FROM seriesdemopopulation WHERE import_file LIKE '%Quarry%') SELECT table_name, count(*) AS "rows", (SELECT count(*) FROM datadict d WHERE d."Table" = s.table_name) AS metadata_rows FROM seriesdemopopulation s WHERE table_name IN (SELECT table_name FROM a) GROUP BY table_name""")
def package_projection(spark: SparkSession, d: str) -> DataFrame:
    """Rows and metadata rows of the tables that one feed applied."""
    rows = table(spark, d, "seriesdemopopulation")
    cells, meta = preparation.package(rows, table(spark, d, "datadict"), rows.where("import_file LIKE '%Quarry%'"))
    told = meta.groupBy(F.col("Table").alias("table_name")).agg(F.count("*").alias("metadata_rows"))
    return cells.groupBy("table_name").agg(F.count("*").alias("rows")).join(told, "table_name", "left").select("table_name", "rows", F.coalesce("metadata_rows", F.lit(0)).alias("metadata_rows"))
