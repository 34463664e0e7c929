"""Queries over the panel operators, each with SQL that says the same on another engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import compare, identity, merge, panel, repair, screens
from panelforge.operators.screens import Rules
from panelforge.plans.fixture import SQL, batches, observations, part
from panelforge.session import table

Query = Callable[[SparkSession, str], DataFrame]
RULES = Rules()
CELL = merge.CELL
YEARS = [str(y) for y in range(2004, 2024)]
TOKENS = ["..", "n/a", "NA"]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL."""

    def keep(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql is not None:
            _sql[f.__name__] = sql
        return f

    return keep


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def _r(c: str, digits: int = 9):
    return F.round(c, digits).alias(c)


# Merging -------------------------------------------------------------------------------------------------------------


@query(f"WITH {SQL} SELECT table_name, entity, code, year, value, origin FROM merged")
def merge_latest_non_null(spark: SparkSession, d: str) -> DataFrame:
    return merge.consolidate(batches(spark, d))


@query(f"""WITH {SQL}, o AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY table_name, entity, code, year ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before_value FROM batches)
SELECT batch, table_name, entity, code, year, before_value, value AS imported_value, before_value IS DISTINCT FROM value AS changed FROM o WHERE seq > 0 AND value IS NOT NULL""")
def merge_events(spark: SparkSession, d: str) -> DataFrame:
    return merge.events(batches(spark, d))


@query(f"""WITH {SQL}, m AS (SELECT table_name, entity, code, year, max_by(value, seq) FILTER (WHERE value IS NOT NULL) AS value, coalesce(max_by(batch, seq) FILTER (WHERE value IS NOT NULL), 'base') AS origin FROM batches WHERE batch <> 'A' GROUP BY ALL)
SELECT * FROM m""")
def merge_discard(spark: SparkSession, d: str) -> DataFrame:
    return merge.discard(batches(spark, d), ["A"])


@query(f"""WITH {SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY table_name, entity, code, year ORDER BY CASE WHEN value IS NULL THEN 1 ELSE 0 END, seq DESC) AS n FROM batches),
r AS (SELECT table_name, entity, code, year, value, CASE WHEN value IS NULL THEN 'base' ELSE batch END AS origin FROM k WHERE n = 1)
SELECT count(*) AS cells, count(*) FILTER (WHERE m.value IS DISTINCT FROM r.value OR m.origin IS DISTINCT FROM r.origin) AS unequal_cells FROM merged m FULL JOIN r USING (table_name, entity, code, year)""")
def merge_verified(spark: SparkSession, d: str) -> DataFrame:
    """Cells of the merge, and those in which two formulations of it differ."""
    b = batches(spark, d)
    merged = merge.consolidate(b)
    odd = merge.unequal(merged, merge.replay(b)).agg(F.count("*").alias("unequal_cells"))
    return merged.agg(F.count("*").alias("cells")).join(odd, how="cross")


@query(f"WITH {SQL} SELECT coalesce(n.table_name, o.table_name) AS table_name, coalesce(n.entity, o.entity) AS entity, coalesce(n.code, o.code) AS code, coalesce(n.year, o.year) AS year, coalesce(n.value, o.value) AS value FROM base o FULL JOIN a_ n USING (table_name, entity, code, year)")
def blend_prefer_new(spark: SparkSession, d: str) -> DataFrame:
    b = batches(spark, d)
    return merge.blend(part(b, "base"), part(b, "A"))


@query(f"""WITH {SQL}, e AS (SELECT DISTINCT table_name, entity, code FROM a_), s AS (SELECT table_name, min(year) AS lo, max(year) AS hi FROM a_ GROUP BY 1),
g AS (SELECT e.table_name, entity, code, CAST(unnest(range(lo, hi + 1)) AS INT) AS year FROM e JOIN s USING (table_name))
SELECT g.table_name, g.entity, g.code, g.year, value FROM g LEFT JOIN a_ USING (table_name, entity, code, year)""")
def blend_replace_densify(spark: SparkSession, d: str) -> DataFrame:
    b = batches(spark, d)
    return panel.densify(merge.blend(part(b, "base"), part(b, "A"), "replace"), ["table_name"], ["entity", "code"])


@query(f"""WITH {SQL}, o AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY table_name, entity, code, year ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM batches)
SELECT batch, table_name, count(*) AS supplied, count(*) FILTER (WHERE p IS DISTINCT FROM value) AS changed, count(*) FILTER (WHERE p IS NULL) AS added, count(*) FILTER (WHERE p <> value) AS revised FROM o WHERE seq > 0 AND value IS NOT NULL GROUP BY ALL""")
def batch_counts(spark: SparkSession, d: str) -> DataFrame:
    return merge.batch_counts(batches(spark, d))


@query(f"WITH {SQL} SELECT table_name, string_agg(DISTINCT batch, ',' ORDER BY batch) AS batches FROM batches WHERE seq > 0 GROUP BY 1 HAVING count(DISTINCT batch) > 1")
def import_overlap(spark: SparkSession, d: str) -> DataFrame:
    return merge.overlaps(batches(spark, d))


@query(f"""WITH {SQL} SELECT m.origin, CAST(count(DISTINCT CASE WHEN m.table_name NOT IN (SELECT table_name FROM base) THEN m.table_name END) AS BIGINT) AS created,
count(DISTINCT CASE WHEN m.table_name IN (SELECT table_name FROM base) THEN m.table_name END) AS updated, count(*) AS cells
FROM merged m LEFT JOIN base b USING (table_name, entity, code, year) WHERE m.origin <> 'base' AND m.value IS DISTINCT FROM b.value GROUP BY 1""")
def release_counts(spark: SparkSession, d: str) -> DataFrame:
    b = batches(spark, d)
    return merge.release_counts(merge.consolidate(b), part(b, "base"))


@query("""WITH l AS (SELECT s.s_nationkey AS f, c.c_nationkey AS t, CAST(year(l_shipdate) AS INT) AS year, l_quantity FROM lineitem JOIN supplier s ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer c ON o_custkey = c_custkey)
SELECT a.n_name AS actor, concat('N', lpad(CAST(f AS VARCHAR), 2, '0')) AS actor_code, b.n_name AS partner, concat('N', lpad(CAST(t AS VARCHAR), 2, '0')) AS partner_code, year, round(sum(l_quantity), 2) AS value
FROM l JOIN nation a ON f = a.n_nationkey JOIN nation b ON t = b.n_nationkey GROUP BY ALL""")
def dyadic_panel(spark: SparkSession, d: str) -> DataFrame:
    """Directed pairs: quantity shipped from each supplier nation to each customer nation in each year."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", F.year("l_shipdate").alias("year"), "l_quantity")
    supplier = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("f"))
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("t"))
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(customer, "o_custkey")
    # Lines are summed per order and supplier nation before they meet the orders.
    per = lines.join(supplier, "l_suppkey").groupBy("l_orderkey", "f", "year").agg(F.sum("l_quantity").alias("q"))
    got = per.join(orders, "l_orderkey").groupBy("f", "t", "year").agg(F.round(F.sum("q"), 2).cast("double").alias("value"))
    nation = lambda k, name, code: table(spark, d, "nation").select(F.col("n_nationkey").alias(k), F.col("n_name").alias(name), F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias(code))
    return got.join(nation("f", "actor", "actor_code"), "f").join(nation("t", "partner", "partner_code"), "t").select("actor", "actor_code", "partner", "partner_code", F.col("year").cast("int").alias("year"), "value")


# Comparing -----------------------------------------------------------------------------------------------------------


@query(f"""WITH {SQL}, j AS (SELECT table_name, b.value AS a, i.value AS i, m.value AS b FROM merged m LEFT JOIN base b USING (table_name, entity, code, year) LEFT JOIN a_ i USING (table_name, entity, code, year))
SELECT table_name, count(*) FILTER (WHERE a IS NULL AND b IS NOT NULL) AS added, count(*) FILTER (WHERE a <> b) AS revised, count(*) FILTER (WHERE a IS NOT NULL AND b IS NULL) AS removed,
count(*) FILTER (WHERE a = b) AS unchanged, count(*) FILTER (WHERE i IS NULL AND a IS NOT NULL AND b IS NOT NULL) AS backfilled, count(*) FILTER (WHERE a <> b AND (a = 0 OR abs(b - a) > 0.5 * abs(a))) AS large_revisions FROM j GROUP BY 1""")
def change_counts(spark: SparkSession, d: str) -> DataFrame:
    b = batches(spark, d)
    return compare.change_counts(part(b, "base"), part(b, "A"), merge.consolidate(b))


@query(f"WITH {SQL} SELECT batch, table_name, year, count(value) AS cells FROM batches GROUP BY ALL")
def coverage_by_year(spark: SparkSession, d: str) -> DataFrame:
    return compare.coverage(batches(spark, d), ["batch", "table_name"])


@query(f"WITH {SQL} SELECT batch, table_name, code, count(value) AS populated, min(year) FILTER (WHERE value IS NOT NULL) AS first_year, max(year) FILTER (WHERE value IS NOT NULL) AS last_year FROM batches GROUP BY ALL")
def entity_coverage(spark: SparkSession, d: str) -> DataFrame:
    return compare.entity_coverage(batches(spark, d), ["batch", "table_name", "code"])


@query(f"WITH {SQL} SELECT table_name, count(DISTINCT code) FILTER (WHERE value IS NOT NULL) AS entities, count(value) AS observations, count(*) FILTER (WHERE value = 0) AS zeros, count(*) FILTER (WHERE value < 0) AS negatives, count(*) FILTER (WHERE value IS NULL) AS null_cells, batch FROM batches GROUP BY batch, table_name")
def import_coverage(spark: SparkSession, d: str) -> DataFrame:
    return compare.import_coverage(batches(spark, d), ["batch", "table_name"])


# The incoming panel lacks one nation and starts in 1999, so that every class of change occurs.
_CLASSES = f"""WITH {SQL}, inc AS (SELECT * FROM a_ WHERE code <> 'N01' AND year >= 1999),
j AS (SELECT coalesce(o.table_name, n.table_name) AS table_name, coalesce(o.entity, n.entity) AS entity, coalesce(o.code, n.code) AS code, coalesce(o.year, n.year) AS year, o.value AS before, n.value AS after FROM base o FULL JOIN inc n ON o.code = n.code AND o.year = n.year)"""


def _incoming(b: DataFrame) -> DataFrame:
    return part(b, "A").where("code <> 'N01' AND year >= 1999")


@query(f"""{_CLASSES} SELECT table_name, entity, code, year, before, after, CASE WHEN before IS NULL THEN 'added' WHEN code NOT IN (SELECT code FROM inc) THEN 'missing_country' WHEN year NOT IN (SELECT year FROM inc) THEN 'old_only_year' WHEN after IS NULL THEN 'incoming_null' ELSE 'revised' END AS change_class
FROM j WHERE before IS DISTINCT FROM after""")
def incoming_change_class(spark: SparkSession, d: str) -> DataFrame:
    b = batches(spark, d)
    return compare.incoming_classes(part(b, "base"), _incoming(b))


@query(f"{_CLASSES} SELECT table_name, entity, code, year, before, after, CASE WHEN before IS NULL AND after IS NULL THEN 'both_missing' WHEN before = after THEN 'unchanged' WHEN before IS NULL THEN 'added' WHEN after IS NULL THEN 'incoming_missing' ELSE 'revised' END AS outcome FROM j")
def quality_outcome(spark: SparkSession, d: str) -> DataFrame:
    b = batches(spark, d)
    return compare.outcomes(part(b, "base"), _incoming(b))


@query(f"""{_CLASSES}, r AS (SELECT *, CASE WHEN before <> after AND before <> 0 THEN abs(after - before) / abs(before) END AS rel FROM j), u AS (SELECT table_name, list_sort(list(rel) FILTER (WHERE rel IS NOT NULL)) AS l FROM r GROUP BY 1)
SELECT r.table_name, count(*) FILTER (WHERE before IS NOT NULL AND after IS NOT NULL) AS overlap, count(*) FILTER (WHERE before = after) AS exact_equal, count(*) FILTER (WHERE before <> after) AS revised,
count(*) FILTER (WHERE before IS NULL AND after IS NOT NULL) AS incoming_only, count(*) FILTER (WHERE before IS NOT NULL AND after IS NULL) AS base_without_incoming, round(any_value(l[len(l) // 2 + 1]), 9) AS upper_median_revision FROM r JOIN u USING (table_name) GROUP BY 1""")
def revision_evidence(spark: SparkSession, d: str) -> DataFrame:
    b = batches(spark, d)
    return compare.revision_evidence(part(b, "base"), _incoming(b)).withColumn("upper_median_revision", F.round("upper_median_revision", 9))


@query(f"WITH {SQL} SELECT batch, table_name, entity, code, min_by(value, year) FILTER (WHERE value IS NOT NULL) AS \"Earliest\", max_by(value, year) FILTER (WHERE value IS NOT NULL) AS \"MostRecent\" FROM batches GROUP BY ALL")
def endpoints(spark: SparkSession, d: str) -> DataFrame:
    return panel.endpoints(batches(spark, d), ["batch", "table_name", "entity", "code"])


# Shapes --------------------------------------------------------------------------------------------------------------


@query(f"WITH {SQL} SELECT entity, code, " + ", ".join(f"max(value) FILTER (WHERE year = {y}) AS \"{y}\"" for y in range(1995, 2002)) + ", min_by(value, year) FILTER (WHERE value IS NOT NULL) AS \"Earliest\", max_by(value, year) FILTER (WHERE value IS NOT NULL) AS \"MostRecent\" FROM merged GROUP BY entity, code")
def wide_pivot(spark: SparkSession, d: str) -> DataFrame:
    return panel.to_wide(merge.consolidate(batches(spark, d)), ["entity", "code"], list(range(1995, 2002)))


@query('UNPIVOT (SELECT row_id, ' + ", ".join(f'"{y}"' for y in YEARS) + ' FROM seriesdemopopulation) ON ' + ", ".join(f'"{y}"' for y in YEARS) + " INTO NAME y VALUE value".replace("y VALUE", "yr VALUE"))
def wide_to_long(spark: SparkSession, d: str) -> DataFrame:
    """The observations of the wide population series; null cells are no observations here."""
    wide = table(spark, d, "seriesdemopopulation").select("row_id", *[F.col(f"`{y}`") for y in YEARS])
    return panel.to_long(wide, ["row_id"]).where("value IS NOT NULL").select("row_id", F.col("year").cast("string").alias("yr"), "value")


@query("SELECT row_id, \"Earliest\", \"MostRecent\", f AS first_value, l AS last_value FROM (SELECT row_id, \"Earliest\", \"MostRecent\", list_filter([" + ", ".join(f'"{y}"' for y in YEARS) + "], lambda x: x IS NOT NULL) AS v, v[1] AS f, v[-1] AS l FROM seriesdemopopulation) WHERE \"Earliest\" IS DISTINCT FROM f OR \"MostRecent\" IS DISTINCT FROM l")
def derived_value_mismatch(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose stored endpoints are stale."""
    return repair.endpoint_mismatches(table(spark, d, "seriesdemopopulation"), ["row_id"], YEARS)


_ROSTER = "roster AS (SELECT ifs_name AS entity, ifs_fipscode AS code FROM country_data), t AS (SELECT DISTINCT table_name, upper(trim(FIPS_CODE)) AS code FROM seriesdemopopulation WHERE trim(FIPS_CODE) <> '')"


def _roster(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "country_data").select(F.col("ifs_name").alias("entity"), F.col("ifs_fipscode").alias("code"))


def _coded(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "seriesdemopopulation").select("table_name", F.upper(F.trim("FIPS_CODE")).alias("code"), F.col("`2023`").alias("value")).where("code <> ''")


@query(f"WITH {_ROSTER} SELECT n.table_name, r.entity, r.code FROM (SELECT DISTINCT table_name FROM t) n CROSS JOIN roster r LEFT JOIN t ON t.table_name = n.table_name AND t.code = r.code WHERE t.code IS NULL")
def absent_entities(spark: SparkSession, d: str) -> DataFrame:
    return panel.absent_entities(_coded(spark, d), _roster(spark, d), ["table_name"])


@query(f"""WITH {SQL}, ros AS (SELECT n_name AS entity, concat('N', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS code FROM nation), b_ AS (SELECT table_name, entity, code, year, value FROM batches WHERE batch = 'B')
SELECT * FROM b_ UNION ALL SELECT y.table_name, r.entity, r.code, y.year, CAST(NULL AS DOUBLE) FROM (SELECT DISTINCT table_name, year FROM b_) y CROSS JOIN ros r WHERE r.code NOT IN (SELECT code FROM b_)""")
def roster_padding(spark: SparkSession, d: str) -> DataFrame:
    nations = table(spark, d, "nation").select(F.col("n_name").alias("entity"), F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("code"))
    return panel.pad_roster(part(batches(spark, d), "B"), nations, ["table_name"])


# Cells ---------------------------------------------------------------------------------------------------------------

_NUM = "regexp_full_match(value, '[ \\t]*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?[ \\t]*')"


@query(f"""WITH c AS (SELECT CASE WHEN value IS NULL THEN 'sql_null' WHEN value = '' THEN 'empty_string' WHEN regexp_full_match(value, '\\s*') THEN 'whitespace_string' WHEN trim(value) IN ('..', 'n/a', 'NA') THEN 'declared_string_token'
WHEN {_NUM} AND try_cast(trim(value) AS DOUBLE) = -999 THEN 'declared_numeric_token' WHEN {_NUM} AND isfinite(try_cast(trim(value) AS DOUBLE)) THEN 'numeric_text' ELSE 'invalid_value' END AS representation FROM download
UNION ALL SELECT CASE WHEN "2023" IS NULL THEN 'sql_null' WHEN "2023" = -999 THEN 'declared_numeric_token' WHEN "2023" = 0 THEN 'numeric_zero' ELSE 'numeric' END FROM seriesdemopopulation)
SELECT representation, count(*) AS cells FROM c GROUP BY 1""")
def missing_class(spark: SparkSession, d: str) -> DataFrame:
    text = table(spark, d, "download").select(panel.text_class(F.col("value"), TOKENS, [-999.0]).alias("representation"))
    numbers = table(spark, d, "seriesdemopopulation").select(panel.number_class(F.col("`2023`"), [-999.0]).alias("representation"))
    return text.unionAll(numbers).groupBy("representation").agg(F.count("*").alias("cells"))


@query(f"""SELECT row_id, CASE WHEN {_NUM} AND NOT (trim(value) IN ('..', 'n/a', 'NA')) AND isfinite(try_cast(trim(value) AS DOUBLE)) AND try_cast(trim(value) AS DOUBLE) <> -999 THEN try_cast(trim(value) AS DOUBLE) END AS number,
coalesce(NOT regexp_full_match(value, '\\s*') AND NOT (trim(value) IN ('..', 'n/a', 'NA')) AND NOT ({_NUM} AND isfinite(try_cast(trim(value) AS DOUBLE))), false) AS failed FROM download""")
def lenient_parse(spark: SparkSession, d: str) -> DataFrame:
    number, failed = panel.lenient(F.col("value"), TOKENS, [-999.0])
    return table(spark, d, "download").select("row_id", number.alias("number"), failed.alias("failed"))


@query()
def strict_parse(spark: SparkSession, d: str) -> DataFrame:
    """Exact decimal text; that a double holds a text unchanged is no SQL, tests hold it against decimals."""
    return panel.strict(table(spark, d, "download").select("row_id", "value"), "value").select("row_id", "number", "action", "error")


@query("""WITH v AS (SELECT row_id, "2023" * 1000.0 AS value FROM seriesdemopopulation)
SELECT row_id, value, CASE WHEN value < 0 THEN 'value_below_bound' WHEN value > 1e9 THEN 'value_above_bound' END AS violation FROM v""")
def unit_scaling(spark: SparkSession, d: str) -> DataFrame:
    value, why = panel.scaled(F.col("`2023`"), 1000.0, 0.0, 1e9)
    return table(spark, d, "seriesdemopopulation").select("row_id", value.alias("value"), why.alias("violation"))


@query("SELECT row_id, line, field, raw FROM (SELECT row_id, line_no AS line, unnest(['Country', 'FIPS_CODE', '2020']) AS field, unnest([Country, FIPS_CODE, \"2020\"]) AS raw FROM seriesbad) WHERE regexp_full_match(raw, '\\s*')")
def blank_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells that a repair would turn from blank to null."""
    rows = table(spark, d, "seriesbad").select("row_id", F.col("line_no").cast("string").alias("table_name"), "Country", "FIPS_CODE", F.col("`2020`"))
    audit = repair.audit_text(rows, "row_id", ["Country", "FIPS_CODE", "2020"]).where("rule = 'blank_to_null'")
    return audit.select("row_id", F.col("table_name").cast("int").alias("line"), "field", "raw")


# Identity ------------------------------------------------------------------------------------------------------------

_PAIRS = "p AS (SELECT table_name, trim(Country) AS entity, upper(trim(FIPS_CODE)) AS code, count(*) AS n FROM seriesdemopopulation WHERE Country IS NOT NULL AND trim(Country) <> '' AND trim(FIPS_CODE) <> '' GROUP BY ALL)"


@query(f"""WITH {_PAIRS} SELECT table_name, 'repeated_key' AS rule, concat_ws(' | ', entity, code) AS key, n FROM p WHERE n > 1
UNION ALL SELECT table_name, 'name_with_several_codes', entity, count(*) FROM p GROUP BY table_name, entity HAVING count(*) > 1
UNION ALL SELECT table_name, 'code_with_several_names', code, count(*) FROM p GROUP BY table_name, code HAVING count(*) > 1""")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "seriesdemopopulation").select("table_name", F.trim("Country").alias("entity"), F.upper(F.trim("FIPS_CODE")).alias("code")).where("entity <> '' AND code <> ''")
    return panel.identity_violations(rows, ["table_name"])


def _fold(c: str) -> str:
    """The name folding as far as it occurs: composed, in lower case, white space of any kind made single blanks."""
    return f"trim(regexp_replace(lower(nfc_normalize({c})), '[\\s\\p{{Z}}]+', ' ', 'g'))"


_ALIAS = f"""al AS (SELECT DISTINCT {_fold('a')} AS norm, code FROM (SELECT ifs_name AS a, ifs_fipscode AS code FROM country_data UNION ALL SELECT unnest(alternative_names), ifs_fipscode FROM country_data) WHERE trim(a) <> ''),
nm AS (SELECT regexp_replace(Country, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g') AS original_name, count(*) AS "rows" FROM seriesdemopopulation GROUP BY 1 HAVING original_name <> ''),
cc AS (SELECT original_name, "rows", count(DISTINCT code) AS n, min(code) AS code FROM nm LEFT JOIN al ON {_fold('original_name')} = norm GROUP BY ALL),
conc AS (SELECT original_name, "rows", CASE WHEN n = 1 THEN code END AS code, CASE WHEN n = 1 THEN 'matched' WHEN n > 1 THEN 'ambiguous' ELSE 'unresolved' END AS status FROM cc)"""


def _alias(spark: SparkSession, d: str) -> DataFrame:
    return identity.aliases(table(spark, d, "country_data").select(F.col("ifs_name").alias("entity"), F.col("ifs_fipscode").alias("code"), "alternative_names"), "alternative_names")


def _concordance(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "seriesdemopopulation").select(F.trim("Country").alias("original_name")).where("original_name <> ''")
    return identity.concordance(names, _alias(spark, d))


@query(f"WITH {_ALIAS} SELECT * FROM conc")
def concordance_match(spark: SparkSession, d: str) -> DataFrame:
    """Exact matches of all names to codes."""
    return _concordance(spark, d).where("original_name <> ''")


@query(f"WITH {_ALIAS} SELECT code, count(*) AS sources, string_agg(original_name, ';' ORDER BY original_name) AS names FROM conc WHERE code IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def converging_targets(spark: SparkSession, d: str) -> DataFrame:
    return identity.converging(concordance_match(spark, d)).withColumn("sources", F.col("sources").cast("bigint"))


@query(f"WITH {_ALIAS} SELECT CASE WHEN count(*) FILTER (WHERE status IN ('unresolved', 'ambiguous')) > 0 THEN 'blocked' WHEN count(code) > count(DISTINCT code) THEN 'needs_processing_review' WHEN count(code) = 0 THEN 'blocked' ELSE 'ready' END AS status FROM conc")
def concordance_status(spark: SparkSession, d: str) -> DataFrame:
    return identity.bundle_status(concordance_match(spark, d))


@query(f"""WITH al AS (SELECT norm, list_sort(list(DISTINCT code)) AS ch FROM (SELECT {_fold('ifs_name')} AS norm, ifs_fipscode AS code FROM country_data UNION ALL SELECT {_fold('a')}, code FROM (SELECT unnest(alternative_names) AS a, ifs_fipscode AS code FROM country_data) WHERE trim(a) <> '') GROUP BY 1),
cn AS (SELECT DISTINCT {_fold('ifs_name')} AS norm FROM country_data), s AS (SELECT row_id, coalesce({_fold('Country')}, '') AS nm, coalesce({_fold('FIPS_CODE')}, '') AS c FROM seriesdemopopulation),
j AS (SELECT s.*, r.ifs_fipscode AS m, coalesce(len(ch), 0) AS n, ch[1] AS one, cn.norm IS NOT NULL AS own FROM s LEFT JOIN country_data r ON lower(r.ifs_fipscode) = s.c LEFT JOIN al ON al.norm = nm AND nm <> '' LEFT JOIN cn ON cn.norm = nm),
x AS (SELECT row_id, m, one, CASE WHEN n > 0 AND NOT own THEN 'error_alias_needs_review' WHEN n > 1 OR (n = 1 AND m IS NOT NULL AND one <> m) THEN 'error_conflict'
 WHEN m IS NOT NULL THEN 'canonical_code' WHEN c <> '' THEN 'error_unknown_code' WHEN n = 1 THEN 'recovered_code' ELSE 'error_unknown_name' END AS decision FROM j)
SELECT row_id, decision, CASE decision WHEN 'canonical_code' THEN m WHEN 'recovered_code' THEN one END AS fixed_code FROM x""")
def repair_identity(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "seriesdemopopulation").select("row_id", F.col("Country").alias("entity"), F.col("FIPS_CODE").alias("code"))
    return identity.repair_identity(rows, _roster(spark, d), _alias(spark, d)).select("row_id", "decision", "fixed_code")


@query("SELECT trim(Country) AS name, count(*) AS n, min(row_id) AS first_row FROM seriesdemopopulation WHERE trim(Country) <> '' GROUP BY 1")
def distinct_names(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "seriesdemopopulation").select(F.trim("Country").alias("name"), "row_id").where("name <> ''")
    return rows.groupBy("name").agg(F.count("*").alias("n"), F.min("row_id").alias("first_row"))


_SURPLUS = """ros AS (SELECT n_name AS entity, concat('N', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS code FROM nation),
inp AS (SELECT 'T' AS table_name, entity, code FROM ros UNION ALL SELECT 'T', concat('Extra ', r_name), concat('X', CAST(r_regionkey AS VARCHAR)) FROM region UNION ALL SELECT 'U', entity, code FROM ros WHERE code <> 'N00' UNION ALL SELECT 'U', concat('Extra ', r_name), 'X0' FROM region UNION ALL SELECT 'V', CASE WHEN code = 'N01' THEN NULL ELSE lower(entity) END, concat(' ', lower(code)) FROM ros UNION ALL SELECT 'V', concat('Extra ', r_name), NULL FROM region UNION ALL SELECT 'V', NULL, NULL FROM region UNION ALL SELECT 'W', entity, code FROM ros UNION ALL SELECT 'W', upper(concat(' ', entity, '  ')), 'X9' FROM ros WHERE code = 'N02' UNION ALL SELECT 'W', concat('Extra ', r_name), 'X8' FROM region)"""


@query(f"""WITH {_SURPLUS}, full_ AS (SELECT row_number() OVER () AS id, table_name, entity, code, lower(trim(coalesce(entity, ''))) AS nm, upper(trim(coalesce(code, ''))) AS cd FROM inp WHERE entity IS NOT NULL OR code IS NOT NULL),
t AS (SELECT f.*, c.code AS by_code, n.code AS by_name FROM full_ f LEFT JOIN ros c ON c.code = f.cd LEFT JOIN ros n ON lower(n.entity) = f.nm),
r AS (SELECT *, CASE WHEN by_code IS NOT NULL AND coalesce(by_name, by_code) = by_code THEN by_code WHEN by_code IS NULL AND cd = '' THEN by_name END AS found FROM t),
done AS (SELECT table_name FROM r WHERE found IS NOT NULL GROUP BY 1 HAVING count(*) = (SELECT count(*) FROM ros) AND count(DISTINCT found) = count(*))
SELECT table_name, entity, code FROM r WHERE by_code IS NULL AND by_name IS NULL AND table_name IN (SELECT table_name FROM done)""")
def surplus_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows beyond a complete roster. T and V are complete, V in other spellings; U lacks a nation; W names one again, without its code."""
    ros = table(spark, d, "nation").select(F.col("n_name").alias("entity"), F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("code"))
    regions = table(spark, d, "region").select(F.concat(F.lit("Extra "), "r_name").alias("entity"), F.concat(F.lit("X"), F.col("r_regionkey").cast("string")).alias("code"))
    none = F.lit(None).cast("string")
    put = lambda name, entity, code, rows: rows.select(F.lit(name).alias("table_name"), entity.alias("entity"), code.alias("code"))
    e, c = F.col("entity"), F.col("code")
    parts = [
        put("T", e, c, ros), put("T", e, c, regions), put("U", e, c, ros.where("code <> 'N00'")), put("U", e, F.lit("X0"), regions),
        put("V", F.when(c != "N01", F.lower(e)), F.concat(F.lit(" "), F.lower(c)), ros), put("V", e, none, regions), put("V", none, none, regions),
        put("W", e, c, ros), put("W", F.upper(F.concat(F.lit(" "), e, F.lit("  "))), F.lit("X9"), ros.where("code = 'N02'")), put("W", e, F.lit("X8"), regions),
    ]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return repair.surplus_rows(rows, ros, identity.aliases(ros), ["table_name"]).select("table_name", "entity", "code")


# Screens -------------------------------------------------------------------------------------------------------------

_MOVES = f"""{SQL}, v AS (SELECT *, lag(year) OVER w AS fy, lag(value) OVER w AS bv FROM batches WHERE value IS NOT NULL WINDOW w AS (PARTITION BY batch, table_name, entity, code ORDER BY year)),
mv AS (SELECT batch, table_name, entity, code, fy AS from_year, year AS to_year, bv AS before, value AS after, value - bv AS delta, CASE WHEN abs(bv) >= 1e-9 THEN (value - bv) / abs(bv) END AS rel FROM v WHERE fy IS NOT NULL)"""


def _moves(spark: SparkSession, d: str) -> DataFrame:
    return screens.transitions(batches(spark, d))


@query(f"WITH {_MOVES} SELECT batch, code, from_year, to_year, before, after, delta, round(rel, 9) AS relative FROM mv")
def transitions(spark: SparkSession, d: str) -> DataFrame:
    return _moves(spark, d).select("batch", "code", "from_year", "to_year", "before", "after", "delta", _r("relative"))


@query(f"WITH {_MOVES} SELECT batch, code, from_year, to_year, before, after FROM mv WHERE to_year - from_year = 1 AND abs(delta) > 0 AND (rel IS NULL OR abs(rel) > 0.5)")
def temporal_jump(spark: SparkSession, d: str) -> DataFrame:
    return screens.temporal_jumps(_moves(spark, d)).select("batch", "code", "from_year", "to_year", "before", "after")


@query(f"WITH {_MOVES} SELECT batch, code, from_year, to_year FROM mv WHERE to_year - from_year > 1")
def internal_gap(spark: SparkSession, d: str) -> DataFrame:
    return screens.internal_gaps(_moves(spark, d)).select("batch", "code", "from_year", "to_year")


@query(f"WITH {_MOVES} SELECT batch, code, from_year, to_year FROM mv WHERE to_year - from_year <> 1")
def interval_gap(spark: SparkSession, d: str) -> DataFrame:
    return screens.interval_gaps(_moves(spark, d)).select("batch", "code", "from_year", "to_year")


# Orders less the mean of their nation change sign; halved to whole numbers first so that the mean is exact.
@query(f"""WITH {SQL}, m AS (SELECT code, floor(avg(value)) AS mean FROM base GROUP BY 1), s AS (SELECT b.code, year, value - mean AS value FROM base b JOIN m USING (code) WHERE value IS NOT NULL),
l AS (SELECT *, lag(year) OVER w AS fy, lag(value) OVER w AS bv FROM s WINDOW w AS (PARTITION BY code ORDER BY year)) SELECT code, fy AS from_year, year AS to_year, bv AS before, value AS after FROM l WHERE year - fy = 1 AND bv * value < 0""")
def sign_change(spark: SparkSession, d: str) -> DataFrame:
    base = batches(spark, d).where("batch = 'base'")
    centred = base.join(base.groupBy("code").agg(F.floor(F.avg("value")).alias("mean")), "code").withColumn("value", F.col("value") - F.col("mean"))
    return screens.sign_changes(screens.transitions(centred)).select("code", "from_year", "to_year", "before", "after")


@query(f"WITH {SQL} SELECT batch, code, year, value, CASE WHEN value < 80 THEN 'value_below_bound' WHEN value > 120 THEN 'value_above_bound' END AS rule FROM batches WHERE value < 80 OR value > 120")
def bounds(spark: SparkSession, d: str) -> DataFrame:
    return screens.out_of_bounds(batches(spark, d), 80.0, 120.0).select("batch", "code", "year", "value", "rule")


_FLAT = f"{SQL}, fl AS (SELECT code, year, CASE WHEN year BETWEEN 1996 AND 1999 THEN 5.0 ELSE value END AS value FROM base)"


@query(f"""WITH {_FLAT}, s AS (SELECT *, CASE WHEN value = lag(value) OVER w AND year - lag(year) OVER w = 1 THEN 0 ELSE 1 END AS brk FROM fl WHERE value IS NOT NULL WINDOW w AS (PARTITION BY code ORDER BY year)),
i AS (SELECT *, sum(brk) OVER (PARTITION BY code ORDER BY year) AS run FROM s), n AS (SELECT *, row_number() OVER (PARTITION BY code, run ORDER BY year) AS k FROM i) SELECT code, year AS reached, value FROM n WHERE k = 3""")
def flat_run(spark: SparkSession, d: str) -> DataFrame:
    """Runs of three equal years, planted in the base from 1996 to 1999."""
    flat = batches(spark, d).where("batch = 'base'").withColumn("value", F.when(F.col("year").between(1996, 1999), F.lit(5.0)).otherwise(F.col("value")))
    return screens.flat_runs(flat, Rules(flat_run=3)).select("code", "reached", "value")


@query(f"""WITH {_MOVES}, r AS (SELECT *, lead(delta) OVER w AS nd, lead(after) OVER w AS back, lead(from_year) OVER w AS nf FROM mv WHERE to_year - from_year = 1 WINDOW w AS (PARTITION BY batch, code ORDER BY to_year))
SELECT batch, code, to_year AS year, before, after AS spike, back FROM r WHERE abs(delta) > 0 AND (rel IS NULL OR abs(rel) > 0.5) AND nf = to_year AND delta * nd < 0 AND abs(back - before) / greatest(abs(delta), 1e-9) <= 0.1""")
def spike_reversal(spark: SparkSession, d: str) -> DataFrame:
    return screens.spike_reversals(_moves(spark, d)).select("batch", "code", "year", "before", "spike", "back")


@query(f"""WITH {SQL}, v AS (SELECT code, year, value, lag(year) OVER w AS fy, lag(value) OVER w AS bv FROM (SELECT code, year, max_by(value, seq) FILTER (WHERE value IS NOT NULL) AS value FROM batches GROUP BY ALL) WHERE value IS NOT NULL WINDOW w AS (PARTITION BY code ORDER BY year)),
m AS (SELECT code, year, value - bv AS delta, (value - bv) / abs(bv) AS rel FROM v WHERE year - fy = 1 AND abs(bv) >= 1e-9),
h AS (SELECT *, median(rel) OVER p AS center, mad(rel) OVER p AS mad, count(rel) OVER p AS history FROM m WINDOW p AS (PARTITION BY code ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT *, CASE WHEN mad > 1e-9 THEN abs(rel - center) / (1.4826 * mad) END AS score FROM h WHERE history >= 3)
SELECT code, year AS to_year, round(rel, 9) AS relative, round(center, 9) AS center, round(mad, 9) AS mad, round(score, 6) AS score, history, abs(delta) > 0 AND abs(rel) > 0.5 AND CASE WHEN score IS NOT NULL THEN score > 6 ELSE abs(rel - center) > 0.5 END AS flagged FROM s""")
def history_mad(spark: SparkSession, d: str) -> DataFrame:
    merged = merge.consolidate(batches(spark, d)).withColumn("batch", F.lit("final"))
    told = screens.unusual_movements(screens.transitions(merged), Rules(min_history=3))
    return told.select("code", "to_year", _r("relative"), _r("center"), _r("mad"), _r("score", 6), F.col("history").cast("bigint").alias("history"), "flagged")


@query(f"WITH {SQL} SELECT batch, table_name, year, count(*) AS members, sum(value) AS total, round(avg(value), 9) AS mean, median(value) AS median, CAST(NULL AS VARCHAR) AS reason FROM batches WHERE value IS NOT NULL GROUP BY ALL")
def available_stats(spark: SparkSession, d: str) -> DataFrame:
    return screens.available_stats(batches(spark, d), ["batch", "table_name"]).withColumn("mean", F.round("mean", 9))


_PAIRED = f"""{SQL}, yy AS (SELECT batch, year, lead(year) OVER (PARTITION BY batch ORDER BY year) AS next_year FROM (SELECT DISTINCT batch, year FROM batches)), yp AS (SELECT * FROM yy WHERE next_year - year = 1),
ca AS (SELECT b.batch, b.code, b.year, p.next_year, b.value FROM batches b JOIN yp p ON b.batch = p.batch AND b.year = p.year), cb AS (SELECT b.batch, b.code, p.year, p.next_year, b.value FROM batches b JOIN yp p ON b.batch = p.batch AND b.year = p.next_year),
pr AS (SELECT batch, code, year, next_year, ca.value AS a, cb.value AS b FROM ca FULL JOIN cb USING (batch, code, year, next_year))"""


@query(f"WITH {_PAIRED}, g AS (SELECT batch, year, next_year, count(*) AS members, sum(a) AS total_before, sum(b) AS total_after, median(a) AS median_before, median(b) AS median_after FROM pr WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY ALL) SELECT *, round((total_after - total_before) / abs(total_before), 9) AS relative, abs((total_after - total_before) / total_before) > 0.5 AS aggregate_jump FROM g")
def matched_stats(spark: SparkSession, d: str) -> DataFrame:
    return screens.matched_stats(batches(spark, d)).drop("table_name").withColumn("relative", F.round("relative", 9))


@query(f"WITH {_PAIRED} SELECT batch, year, next_year, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS matched, count(*) FILTER (WHERE a IS NULL AND b IS NOT NULL) AS entering, count(*) FILTER (WHERE a IS NOT NULL AND b IS NULL) AS leaving FROM pr GROUP BY ALL")
def membership_change(spark: SparkSession, d: str) -> DataFrame:
    return screens.membership(batches(spark, d)).drop("table_name")


@query(f"""WITH {SQL}, j AS (SELECT o.table_name, o.value AS a, n.value * 1000 AS b FROM base o JOIN a_ n USING (table_name, entity, code, year) WHERE o.value <> 0 AND n.value <> 0), f AS (SELECT unnest([1e-6, 1e-3, 1e-2, 1e2, 1e3, 1e6]) AS factor)
SELECT table_name, factor, count(*) AS eligible, count(*) FILTER (WHERE abs(b / a / factor - 1) <= 0.02) AS support, round(count(*) FILTER (WHERE abs(b / a / factor - 1) <= 0.02) / count(*), 9) AS share,
CASE WHEN count(*) < 10 THEN 'insufficient_evidence' ELSE 'calculated' END AS status, count(*) >= 10 AND count(*) FILTER (WHERE abs(b / a / factor - 1) <= 0.02) / count(*) >= 0.8 AS possible_scale_change FROM j, f GROUP BY ALL""")
def scale_share(spark: SparkSession, d: str) -> DataFrame:
    """The incoming panel times a thousand against the base."""
    b = batches(spark, d)
    return screens.scale_shares(part(b, "base"), part(b, "A").withColumn("value", F.col("value") * 1000)).withColumn("share", F.round("share", 9))


@query(f"""WITH {SQL}, inc AS (SELECT table_name, entity, code, year - 1 AS year, value FROM base WHERE value IS NOT NULL), ok AS (SELECT code FROM base WHERE value IS NOT NULL GROUP BY 1 HAVING count(DISTINCT value) >= 3),
j AS (SELECT i.table_name, o.off AS offset_, i.value AS v, w.value AS w, s.value AS s FROM inc i JOIN ok USING (code) JOIN base s ON s.code = i.code AND s.year = i.year AND s.value IS NOT NULL, (SELECT unnest([-1, 1]) AS off) o JOIN base w ON w.code = i.code AND w.year = i.year - o.off AND w.value IS NOT NULL),
g AS (SELECT table_name, offset_, count(*) AS compared, count(*) FILTER (WHERE abs(v - w) <= greatest(1e-9 * greatest(abs(v), abs(w)), 1e-12)) AS shifted, count(*) FILTER (WHERE abs(v - s) <= greatest(1e-9 * greatest(abs(v), abs(s)), 1e-12)) AS same FROM j GROUP BY ALL)
SELECT table_name, CAST(offset_ AS INT) AS "offset", compared, shifted, same FROM g WHERE compared >= 5 AND shifted / compared >= 0.8 AND (shifted - same) / compared >= 0.3""")
def year_shift(spark: SparkSession, d: str) -> DataFrame:
    """The base moved back by a year against itself."""
    base = part(batches(spark, d), "base")
    return screens.year_shifts(base, base.withColumn("year", F.col("year") - 1))


_SWAPPED = f"{SQL}, sw AS (SELECT table_name, CASE code WHEN 'N01' THEN 'N02' WHEN 'N02' THEN 'N01' ELSE code END AS code, year, value FROM base)"


def _swapped(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    base = part(batches(spark, d), "base")
    return base, base.withColumn("code", F.when(F.col("code") == "N01", "N02").when(F.col("code") == "N02", "N01").otherwise(F.col("code")))


@query(f"""WITH {_SWAPPED}, s1 AS (SELECT code AS owner, string_agg(coalesce(CAST(value AS VARCHAR), '-'), ',' ORDER BY year) AS s FROM base GROUP BY 1 HAVING count(value) >= 5 AND count(DISTINCT value) >= 3), u AS (SELECT s, min(owner) AS owner FROM s1 GROUP BY 1 HAVING count(*) = 1),
s2 AS (SELECT table_name, code, string_agg(coalesce(CAST(value AS VARCHAR), '-'), ',' ORDER BY year) AS s FROM sw GROUP BY 1, 2 HAVING count(value) >= 5 AND count(DISTINCT value) >= 3) SELECT table_name, code, owner FROM s2 JOIN u USING (s) WHERE code <> owner""")
def trajectory_misplacement(spark: SparkSession, d: str) -> DataFrame:
    """Two nations exchanged in the incoming panel."""
    return screens.misplaced(*_swapped(spark, d))


@query(f"""WITH {_SWAPPED}, c AS (SELECT o.code, o.year, o.value AS o, n.value AS n FROM base o JOIN sw n USING (code, year) WHERE o.value IS NOT NULL AND n.value IS NOT NULL),
p AS (SELECT a.code AS a, b.code AS b, a.o AS x, b.o AS y, a.n AS u, b.n AS v, greatest(abs(a.o), abs(b.o), abs(a.n), abs(b.n), 1e-9) AS s FROM c a JOIN c b ON a.year = b.year AND a.code < b.code),
g AS (SELECT a, b, count(*) AS years, avg((abs(x / s - u / s) + abs(y / s - v / s)) / 2) AS direct, avg((abs(x / s - v / s) + abs(y / s - u / s)) / 2) AS crossed FROM p GROUP BY ALL)
SELECT a, b, years, round(direct, 9) AS direct, round(crossed, 9) AS crossed FROM g WHERE years >= 3 AND crossed <= 0.02 AND direct > 0.02 AND (direct - crossed) / direct >= 0.8""")
def country_swap(spark: SparkSession, d: str) -> DataFrame:
    return screens.swaps(*_swapped(spark, d)).select("a", "b", "years", _r("direct"), _r("crossed"))


@query(f"""WITH {SQL}, v AS (SELECT code, year, value, origin, lag(year) OVER w AS fy, lag(value) OVER w AS bv, lag(origin) OVER w AS bo FROM merged WHERE value IS NOT NULL WINDOW w AS (PARTITION BY table_name, entity, code ORDER BY year))
SELECT code, fy AS from_year, year AS to_year, bv AS before, value AS after, bo AS from_origin, origin FROM v WHERE year - fy = 1 AND abs(value - bv) > 0 AND (abs(bv) < 1e-9 OR abs(value - bv) / abs(bv) > 0.05) AND bo <> origin""")
def blending_boundary(spark: SparkSession, d: str) -> DataFrame:
    merged = merge.consolidate(batches(spark, d))
    return screens.boundary_jumps(merged, Rules(jump=0.05)).select("code", "from_year", "to_year", "before", "after", "from_origin", "origin")


@query(f"""WITH {SQL}, j AS (SELECT m.code, m.year, m.value AS total, b.value AS p1, m.value - b.value + CASE WHEN m.code = 'N03' THEN 1 ELSE 0 END AS p2 FROM merged m LEFT JOIN base b USING (entity, code, year))
SELECT code, year, total, p1 + p2 AS sum_of_parts, CASE WHEN total IS NULL OR p1 + p2 IS NULL THEN 'skipped' WHEN abs(total - p1 - p2) <= greatest(1e-6 * greatest(abs(total), abs(p1 + p2)), 1e-6) THEN 'consistent' ELSE 'inconsistent' END AS status FROM j""")
def sum_rule(spark: SparkSession, d: str) -> DataFrame:
    """The merged panel as the sum of the base and a rest, in which one nation is off by one."""
    b = batches(spark, d)
    merged, base = merge.consolidate(b), part(b, "base")
    both = merged.select("entity", "code", "year", "value").join(base.select("entity", "code", "year", F.col("value").alias("p1")), ["entity", "code", "year"], "left")
    rest = F.col("value") - F.col("p1") + F.when(F.col("code") == "N03", 1).otherwise(0)
    rows = both.select("code", "year", F.explode(F.array(F.struct(F.lit("Total").alias("table_name"), F.col("value")), F.struct(F.lit("P1").alias("table_name"), F.col("p1").alias("value")), F.struct(F.lit("P2").alias("table_name"), rest.alias("value")))).alias("r")).select("code", "year", "r.*")
    return screens.sum_rule(rows, "Total", ["P1", "P2"], ["code"])


# Findings, metadata, sets --------------------------------------------------------------------------------------------

_FINDINGS = f"""{_MOVES}, fi AS (SELECT batch, 'internal_gap' AS rule, code, concat_ws('|', code, from_year, to_year, CAST(before AS BIGINT), CAST(after AS BIGINT)) AS evidence FROM mv WHERE to_year - from_year > 1 UNION ALL SELECT batch, 'temporal_jump', code, concat_ws('|', code, from_year, to_year, CAST(before AS BIGINT), CAST(after AS BIGINT)) FROM mv WHERE to_year - from_year = 1 AND abs(delta) > 0 AND (rel IS NULL OR abs(rel) > 0.5)
UNION ALL SELECT batch, CASE WHEN value < 80 THEN 'value_below_bound' ELSE 'value_above_bound' END, code, concat_ws('|', code, year, CAST(value AS BIGINT)) FROM batches WHERE value < 80 OR value > 120)"""


def _findings(spark: SparkSession, d: str) -> DataFrame:
    b = batches(spark, d)
    m = screens.transitions(b)
    move = F.concat_ws("|", "code", "from_year", "to_year", F.col("before").cast("bigint"), F.col("after").cast("bigint")).alias("evidence")
    parts = [screens.internal_gaps(m).select("batch", F.lit("internal_gap").alias("rule"), "code", move), screens.temporal_jumps(m).select("batch", F.lit("temporal_jump").alias("rule"), "code", move), screens.out_of_bounds(b, 80.0, 120.0).select("batch", "rule", "code", F.concat_ws("|", "code", "year", F.col("value").cast("bigint")).alias("evidence"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"WITH {_FINDINGS} SELECT batch, rule, count(*) AS findings, count(DISTINCT code) AS entities FROM fi GROUP BY ALL")
def finding_counts(spark: SparkSession, d: str) -> DataFrame:
    return _findings(spark, d).groupBy("batch", "rule").agg(F.count("*").alias("findings"), F.countDistinct("code").alias("entities"))


@query(f"WITH {_FINDINGS}, r AS (SELECT rule, evidence AS signature, list(DISTINCT CASE batch WHEN 'base' THEN 'base' WHEN 'A' THEN 'final' ELSE 'incoming' END) AS roles FROM fi GROUP BY ALL) SELECT fi.rule, fi.evidence AS signature, CASE WHEN list_contains(roles, 'base') THEN 'also_in_base' WHEN list_contains(roles, 'incoming') THEN 'also_in_incoming' WHEN fi.rule = 'blending_boundary_jump' THEN 'blending_boundary' ELSE 'dataset_specific_or_unresolved' END AS classification FROM fi JOIN r ON r.rule = fi.rule AND r.signature = fi.evidence WHERE batch = 'A'")
def finding_classes(spark: SparkSession, d: str) -> DataFrame:
    role = F.when(F.col("batch") == "base", "base").when(F.col("batch") == "A", "final").otherwise("incoming")
    return compare.classify_findings(_findings(spark, d).select(role.alias("role"), "rule", F.col("evidence").alias("signature")))


@query(f"WITH {_FINDINGS} SELECT batch, rule, code FROM fi ORDER BY batch, rule, code LIMIT 40")
def top_findings(spark: SparkSession, d: str) -> DataFrame:
    """The first forty findings, as a report shows them."""
    return _findings(spark, d).select("batch", "rule", "code").orderBy("batch", "rule", "code").limit(40)


_META = """lst AS (SELECT * FROM datadict QUALIFY row_number() OVER (PARTITION BY "Table", Variable ORDER BY coalesce("Last IFs Update", '') DESC, coalesce(Units, '') DESC, coalesce(Definition, '') DESC) = 1 AND row_number() OVER (PARTITION BY "Table" ORDER BY coalesce("Last IFs Update", '') DESC, coalesce(Units, '') DESC, coalesce(Definition, '') DESC) = 1),
old AS (SELECT * FROM datadict QUALIFY row_number() OVER (PARTITION BY "Table" ORDER BY coalesce("Last IFs Update", ''), coalesce(Units, ''), coalesce(Definition, '')) = 1)"""


def _metadata(spark: SparkSession, d: str, newest: bool) -> DataFrame:
    rows = table(spark, d, "datadict").where("`Table` IS NOT NULL").select("Table", "Units", "Definition", "Source", F.col("`Last IFs Update`").alias("stamp"))
    key = F.struct(*[F.coalesce(F.col(c), F.lit("")) for c in ("stamp", "Units", "Definition")])
    pick = F.max_by if newest else F.min_by
    return rows.groupBy("Table").agg(pick(F.struct("Units", "Definition", "stamp"), key).alias("m")).select("Table", "m.Units", "m.Definition", "m.stamp")


_SIDE = "CASE f.field WHEN 'Units' THEN {0}.Units WHEN 'stamp' THEN {0}.\"Last IFs Update\" ELSE {0}.Definition END"


@query(f"WITH {_META} SELECT l.\"Table\", f.field, {_SIDE.format('o')} AS before, {_SIDE.format('l')} AS after FROM lst l JOIN old o ON l.\"Table\" = o.\"Table\", (SELECT unnest(['Units', 'Definition', 'stamp']) AS field) f WHERE {_SIDE.format('o')} IS DISTINCT FROM {_SIDE.format('l')}")
def metadata_diff(spark: SparkSession, d: str) -> DataFrame:
    """Fields in which the oldest and the newest metadata row of a table differ."""
    return merge.metadata_diff(_metadata(spark, d, False), _metadata(spark, d, True), ["Table"])


@query(f"WITH {_META} SELECT o.\"Table\", l.Units, o.Definition FROM old o JOIN lst l ON l.\"Table\" = o.\"Table\"")
def metadata_merge(spark: SparkSession, d: str) -> DataFrame:
    """Oldest rows with the newest units laid over; the definition isn't supplied and stays."""
    return merge.metadata_merge(_metadata(spark, d, False).drop("stamp"), _metadata(spark, d, True).select("Table", "Units"), ["Table"])


@query("""WITH t AS (SELECT DISTINCT table_name FROM seriesdemopopulation), m AS (SELECT DISTINCT "Table" AS table_name FROM datadict)
SELECT table_name, 'missing_metadata' AS issue FROM t WHERE table_name NOT IN (SELECT table_name FROM m WHERE table_name IS NOT NULL) UNION ALL SELECT table_name, 'missing_table' FROM m WHERE table_name NOT IN (SELECT table_name FROM t)
UNION ALL SELECT DISTINCT "Table", 'blank Units' FROM datadict WHERE trim(coalesce(Units, '')) = '' UNION ALL SELECT DISTINCT "Table", 'blank Source' FROM datadict WHERE trim(coalesce(Source, '')) = '' UNION ALL SELECT "Table", 'several_units' FROM datadict GROUP BY 1 HAVING count(DISTINCT Units) > 1""")
def metadata_issues(spark: SparkSession, d: str) -> DataFrame:
    return merge.metadata_issues(table(spark, d, "datadict"), table(spark, d, "seriesdemopopulation"), ["Units", "Source"])


@query(f"""WITH {SQL}, o AS (SELECT code, year, value FROM base), n AS (SELECT code, year, value FROM a_)
SELECT side, count(*) AS differing_rows FROM (SELECT 'left' AS side, * FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM n) UNION ALL SELECT 'right', * FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o)) GROUP BY 1""")
def multiset_equal(spark: SparkSession, d: str) -> DataFrame:
    """Rows by which the base and the first batch differ as multisets, per side."""
    b = batches(spark, d)
    pick = lambda x: part(b, x).select("code", "year", "value")
    return repair.multiset_difference(pick("base"), pick("A")).groupBy("side").agg(F.count("*").alias("differing_rows"))


@query("SELECT import_file, count(*) AS n FROM seriesbad WHERE trim(coalesce(Country, '')) = '' AND trim(coalesce(FIPS_CODE, '')) = '' AND trim(coalesce(\"2020\", '')) = '' GROUP BY 1")
def empty_rows(spark: SparkSession, d: str) -> DataFrame:
    return repair.empty_rows(table(spark, d, "seriesbad"), ["Country", "FIPS_CODE", "2020"]).groupBy("import_file").agg(F.count("*").alias("n"))
