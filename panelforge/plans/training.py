"""Queries and SQL of the general training-data problems: 1 to 4, 6 and 7."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.columns import code_key, salted_lookup, strip
from panelforge.operators import drift, snapshots, spikes, triage, units, wide
from panelforge.session import table

YEARS = [str(y) for y in range(2004, 2024)]
#: Fields of the consistent metadata table and their types: all those of datadict.
FIELDS = {
    "Table": "string", "Variable": "string", "Definition": "string", "Units": "string", "Source": "string", "Notes": "string",
    "CURRENCY": "string", "Years": "string", "Group": "string", "Decimal Places": "bigint", "Proprietary": "bigint",
    "UsedInFunctions": "bigint", "UsedInHistAnalog": "bigint", "TreatNullsAs0s": "bigint", "UsedInPreprocessor": "bigint",
    "CompareOtherForecast": "bigint", "Cohort": "string", "Extended Source Defn": "string", "Original Source": "string",
    "UsedInPreprocessorFileName": "string", "DisplayNotes": "string", "SubGroup": "string", "Series": "string",
    "CoVaTrA": "string", "Aggregation": "string", "Disaggregation": "string", "Last IFs Update": "string",
    "Name in Source": "string", "Country Concordance": "string", "Code in Source": "string", "Formula": "string",
}
KEYS = ["dataset", "code", "yr"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    report, _, _ = drift.drift(table(spark, d, "datadict_files"))
    return report.select("import_file", "field", "change_kind").distinct()


def p1_consistent(spark: SparkSession, d: str) -> DataFrame:
    return drift.consolidate(table(spark, d, "datadict_files"), FIELDS)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return triage.failures(table(spark, d, "seriesbad"), table(spark, d, "download"), table(spark, d, "indicators")).distinct()


def p2_loaded(spark: SparkSession, d: str) -> DataFrame:
    """Files with how many of their lines load, hold a number, or fail by each reason."""
    lines = triage.triage_lines(table(spark, d, "seriesbad"))
    return lines.groupBy("import_file").agg(
        F.count_if(F.col("reason").isNull()).alias("loaded"), F.count("loaded").alias("numbers"),
        *[F.count_if(F.col("reason") == r).alias(r) for r in ("broken_quoting", "column_count", "invalid_value")],
    )


def _cells(spark: SparkSession, d: str) -> DataFrame:
    kinds, roster = table(spark, d, "indicators"), table(spark, d, "country_data")
    rows = triage.triage_values(table(spark, d, "download"), kinds).where("reason IS NULL AND listed IS NOT NULL").where(~triage.is_missing(F.col("value")))
    known = roster.select(code_key(F.col("ifs_fipscode")).alias("_key"), F.col("ifs_fipscode").alias("_code")).where("_key IS NOT NULL").dropDuplicates(["_key"])
    rows = salted_lookup(rows.withColumns({"_key": code_key(F.col("code")), "_yr": strip(F.col("year"))}).where(F.col("_yr").rlike(r"^[0-9]{4}\z")), known, ["_key"], "inner")
    return rows.select("dataset", F.col("_code").alias("code"), F.col("_yr").cast("int").alias("yr"), F.col("listed").alias("indicator"), "received_at", "row_id", F.col("value").alias("cell"))


def _recipe(spark: SparkSession, d: str) -> dict[str, str]:
    """Indicators and their types: a few rows, which name the columns of the wide table."""
    return {r["indicator"]: r["value_type"] for r in table(spark, d, "indicators").orderBy("indicator").collect()}


def _compacted(spark: SparkSession, d: str, columns: dict[str, str]) -> DataFrame:
    return wide.compact([wide.deltas(_cells(spark, d), KEYS, "indicator", list(columns))], KEYS, list(columns))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    columns = _recipe(spark, d)
    return wide.filled(_compacted(spark, d, columns), KEYS, "indicator", list(columns))


def p3_wide(spark: SparkSession, d: str) -> DataFrame:
    columns = _recipe(spark, d)
    return wide.widen(_compacted(spark, d, columns), KEYS, columns)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    known = units.in_persons(table(spark, d, "seriesdemopopulation"), table(spark, d, "datadict"))
    return known.where("stored IS NOT NULL AND factor <> 1").select("row_id", "factor").distinct()


def p4_persons(spark: SparkSession, d: str) -> DataFrame:
    return units.in_persons(table(spark, d, "seriesdemopopulation"), table(spark, d, "datadict"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    found = snapshots.snapshot_changes(table(spark, d, "seriesdemopopulation_snapshots"))
    return found.select("table_name", "snapshot_no", "fips_code", "change_kind")


def p6_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Changes per table, kind and snapshot, as the hand-kept ledger should have had them."""
    found = snapshots.snapshot_changes(table(spark, d, "seriesdemopopulation_snapshots"))
    return found.groupBy("table_name", "snapshot_no", "change_kind").agg(F.count("*").alias("records"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return spikes.flagged(table(spark, d, "seriesdemopopulation"), YEARS).select("row_id", "yr").distinct()


def p7_reasons(spark: SparkSession, d: str) -> DataFrame:
    return spikes.flagged(table(spark, d, "seriesdemopopulation"), YEARS)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_consistent, p2_found, p2_loaded, p3_found, p3_wide, p4_found, p4_persons, p6_found, p6_ledger, p7_found, p7_reasons)}


# The SQL below says the same in other words; it shares nothing with the operators.
def _number(t: str) -> str:
    t = f"trim({t}, ' ' || chr(9))"
    v = f"try_cast({t} AS DOUBLE)"
    return f"""coalesce(regexp_full_match({t}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') AND isfinite({v})
      AND NOT ({v} = 0 AND regexp_matches(regexp_replace({t}, '[eE].*', ''), '[1-9]'))
      AND (regexp_matches({t}, '[eE]') OR length(regexp_replace({t}, '[^0-9]', '', 'g')) <= 15
        OR length(ltrim(replace(rtrim({t}, '0'), '.', ''), '+-0')) <= 17 + 21 * CAST({t} NOT LIKE '%.%' AS INT)
        AND coalesce(try_cast({t} AS DECIMAL(38,18)) = try_cast(CAST({v} AS VARCHAR) AS DECIMAL(38,18)), false)), false)"""


def _missing(t: str) -> str:
    return f"({t} IS NULL OR regexp_full_match({t}, '\\s*') OR regexp_full_match({t}, '\\s*\\.\\.\\s*'))"


_LINES = f"""
head AS (SELECT import_file, arg_min(raw_line, row_id) AS h FROM seriesbad WHERE line_no = 0 GROUP BY 1),
dlm AS (SELECT import_file, CASE WHEN h LIKE '%;%' THEN ';' WHEN h LIKE '%|%' THEN '|' WHEN h LIKE '%' || chr(9) || '%' THEN chr(9) ELSE ',' END AS d, h FROM head),
body AS (SELECT s.row_id, s.import_file, coalesce(s.raw_line, '') AS l, d, list_transform(string_split(h, d), lambda x: trim(x, '"')) AS hd FROM seriesbad s JOIN dlm USING (import_file) WHERE line_no <> 0),
quoted AS (SELECT *, CASE d
   WHEN ';' THEN regexp_full_match(l, '(?s)("([^"]|"")*"|[^";]*)(;("([^"]|"")*"|[^";]*))*')
   WHEN '|' THEN regexp_full_match(l, '(?s)("([^"]|"")*"|[^"|]*)(\\|("([^"]|"")*"|[^"|]*))*')
   WHEN ',' THEN regexp_full_match(l, '(?s)("([^"]|"")*"|[^",]*)(,("([^"]|"")*"|[^",]*))*')
   ELSE regexp_full_match(l, '(?s)("([^"]|"")*"|[^"\\t]*)(\\t("([^"]|"")*"|[^"\\t]*))*') END AS fine FROM body),
cut AS (SELECT *, CASE d
   WHEN ';' THEN regexp_extract_all(l || ';', '(?s)("(?:[^"]|"")*"|[^";]*);', 1)
   WHEN '|' THEN regexp_extract_all(l || '|', '(?s)("(?:[^"]|"")*"|[^"|]*)\\|', 1)
   WHEN ',' THEN regexp_extract_all(l || ',', '(?s)("(?:[^"]|"")*"|[^",]*),', 1)
   ELSE regexp_extract_all(l || chr(9), '(?s)("(?:[^"]|"")*"|[^"\\t]*)\\t', 1) END AS f FROM quoted),
val AS (SELECT *, trim(f[list_position(hd, '2020')], '"') AS v FROM cut),
lines AS (SELECT row_id, import_file, v, CASE WHEN NOT fine THEN 'broken_quoting' WHEN len(f) <> len(hd) THEN 'column_count'
   WHEN NOT {_missing("v")} AND NOT {_number("v")} THEN 'invalid_value' END AS reason FROM val)"""

_VALUES = f"""
typed AS (SELECT w.*, i.indicator AS listed, i.value_type FROM download w LEFT JOIN indicators i ON upper(trim(w.indicator)) = upper(i.indicator)),
judged AS (SELECT *, {_missing("value")} AS missing, CASE value_type
   WHEN 'decimal' THEN {_number("value")}
   WHEN 'integer' THEN {_number("value")} AND floor(try_cast(trim(value, ' ' || chr(9)) AS DOUBLE)) = try_cast(trim(value, ' ' || chr(9)) AS DOUBLE)
   WHEN 'flag' THEN lower(trim(value)) IN ('y', 'n', 'yes', 'no', 'true', 'false', '1', '0') ELSE true END AS fits FROM typed)"""

_CELLS = f"""{_VALUES},
cells AS (SELECT dataset, c.ifs_fipscode AS code, CAST(trim(year) AS INT) AS yr, listed AS indicator, value, received_at, row_id
   FROM judged j JOIN country_data c ON upper(trim(j.code)) = upper(c.ifs_fipscode)
   WHERE listed IS NOT NULL AND NOT missing AND fits AND regexp_full_match(trim(year), '[0-9]{{4}}'))"""

_SNAPSHOTS = """
snap AS (SELECT table_name, snapshot_no, row_number() OVER (PARTITION BY table_name ORDER BY snapshot_no) AS idx FROM (SELECT DISTINCT table_name, snapshot_no FROM seriesdemopopulation_snapshots)),
one AS (SELECT table_name, snapshot_no, upper(trim(FIPS_CODE)) AS fips_code, lower(trim(regexp_replace(Country, '\\s+', ' ', 'g'))) AS nm, "2023" AS v,
   row_number() OVER (PARTITION BY table_name, snapshot_no, upper(trim(FIPS_CODE)) ORDER BY received_at DESC, row_id DESC) AS k
   FROM seriesdemopopulation_snapshots WHERE trim(FIPS_CODE) <> ''),
st AS (SELECT o.*, idx FROM one o JOIN snap USING (table_name, snapshot_no) WHERE k = 1),
both_ AS (SELECT coalesce(b.table_name, a.table_name) AS table_name, coalesce(b.idx, a.idx + 1) AS idx, coalesce(b.fips_code, a.fips_code) AS fips_code,
   a.fips_code IS NOT NULL AS ha, b.fips_code IS NOT NULL AS hb, a.nm AS an, b.nm AS bn, a.v AS av, b.v AS bv
   FROM st a FULL JOIN st b ON a.table_name = b.table_name AND a.fips_code = b.fips_code AND b.idx = a.idx + 1),
diff AS (SELECT table_name, s.snapshot_no, fips_code, CASE WHEN NOT ha THEN 'added' WHEN NOT hb THEN 'removed'
   WHEN an IS DISTINCT FROM bn OR (av IS NULL) <> (bv IS NULL) OR abs(av - bv) > 1e-9 * greatest(abs(av), abs(bv)) THEN 'changed' END AS change_kind
   FROM both_ JOIN snap s USING (table_name, idx) WHERE idx > 1)"""


def oracle_sql() -> dict[str, str]:
    kinds = "('y', 'yes', 'true', '1')"
    return {
        "p1_found": """
WITH rec AS (SELECT feed, seq, import_file, record_id, CAST(record AS JSON) AS r FROM datadict_files),
keyed AS (SELECT feed, seq, import_file, record_id, r->>'$.Table' AS tab, r->>'$.Variable' AS var, r, unnest(json_keys(r)) AS field FROM rec),
c AS (SELECT * EXCLUDE (r), json_type(r, '$."' || field || '"') AS jt, json_extract_string(r, '$."' || field || '"') AS val FROM keyed),
k AS (SELECT *, CASE WHEN jt = 'NULL' THEN NULL WHEN jt = 'VARCHAR' THEN 'string' WHEN jt = 'BOOLEAN' THEN 'boolean' WHEN jt = 'ARRAY' THEN 'array' WHEN jt = 'OBJECT' THEN 'object' ELSE 'number' END AS kind FROM c),
f AS (SELECT feed, seq, import_file, field, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds FROM k GROUP BY ALL),
files AS (SELECT feed, seq, import_file, lag(seq) OVER (PARTITION BY feed ORDER BY seq) AS before FROM (SELECT DISTINCT feed, seq, import_file FROM datadict_files)),
now_ AS (SELECT p.feed, p.seq, p.before, p.import_file, f.field, f.kinds FROM files p JOIN f USING (feed, seq) WHERE before IS NOT NULL),
then_ AS (SELECT p.feed, p.seq, p.before, p.import_file, f.field, f.kinds FROM files p JOIN f ON f.feed = p.feed AND f.seq = p.before),
added AS (SELECT * FROM now_ a WHERE NOT EXISTS (SELECT 1 FROM then_ b WHERE b.feed = a.feed AND b.seq = a.seq AND b.field = a.field)),
removed AS (SELECT * FROM then_ a WHERE NOT EXISTS (SELECT 1 FROM now_ b WHERE b.feed = a.feed AND b.seq = a.seq AND b.field = a.field)),
last_ AS (SELECT feed, seq, tab, var, field, arg_max(val, record_id) AS val FROM k WHERE val IS NOT NULL GROUP BY ALL),
met AS (SELECT a.feed, a.seq, a.import_file, r.field AS old_field, a.field AS new_field, r.kinds AS old_kinds, a.kinds AS new_kinds, count(*) AS n,
    avg(CASE WHEN x.val = y.val OR levenshtein(x.val, y.val) <= 1 AND length(x.val) >= 6 OR levenshtein(x.val, y.val) <= 0.15 * length(x.val) THEN 1 ELSE 0 END) AS share
  FROM added a JOIN removed r ON a.feed = r.feed AND a.seq = r.seq JOIN last_ x ON x.feed = r.feed AND x.seq = r.before AND x.field = r.field
  JOIN last_ y ON y.feed = a.feed AND y.seq = a.seq AND y.field = a.field AND y.tab = x.tab AND y.var = x.var GROUP BY ALL),
ren AS (SELECT * FROM met WHERE share >= 0.6 QUALIFY row_number() OVER (PARTITION BY feed, seq, new_field ORDER BY share DESC, n DESC) = 1 AND row_number() OVER (PARTITION BY feed, seq, old_field ORDER BY share DESC, n DESC) = 1)
SELECT import_file, new_field AS field, 'renamed' AS change_kind FROM ren
UNION SELECT import_file, field, 'added' FROM added a WHERE NOT EXISTS (SELECT 1 FROM ren r WHERE r.feed = a.feed AND r.seq = a.seq AND r.new_field = a.field)
UNION SELECT import_file, field, 'removed' FROM removed a WHERE NOT EXISTS (SELECT 1 FROM ren r WHERE r.feed = a.feed AND r.seq = a.seq AND r.old_field = a.field)
UNION SELECT a.import_file, a.field, 'retyped' FROM now_ a JOIN then_ b ON a.feed = b.feed AND a.seq = b.seq AND a.field = b.field WHERE a.kinds <> b.kinds
UNION SELECT import_file, new_field, 'retyped' FROM ren WHERE old_kinds <> new_kinds""",
        "p2_found": f"""
WITH {_LINES}, {_VALUES}
SELECT 'seriesbad' AS tab, row_id, reason FROM lines WHERE reason IS NOT NULL
UNION SELECT 'download', row_id, 'invalid_value' FROM judged WHERE listed IS NOT NULL AND NOT missing AND NOT fits""",
        "p2_loaded": f"""
WITH {_LINES}
SELECT import_file, count(*) FILTER (WHERE reason IS NULL) AS loaded, count(*) FILTER (WHERE reason IS NULL AND NOT {_missing("v")}) AS numbers,
  count(*) FILTER (WHERE reason = 'broken_quoting') AS broken_quoting, count(*) FILTER (WHERE reason = 'column_count') AS column_count,
  count(*) FILTER (WHERE reason = 'invalid_value') AS invalid_value FROM lines GROUP BY 1""",
        "p3_found": f"WITH {_CELLS} SELECT DISTINCT dataset, code, yr, indicator FROM cells",
        "p3_wide": f"""
WITH {_CELLS}, top AS (SELECT * FROM cells QUALIFY row_number() OVER (PARTITION BY dataset, code, yr, indicator ORDER BY received_at DESC, row_id DESC) = 1)
SELECT dataset, code, yr, """
        + ", ".join(
            {
                "integer": f"CAST(max(TRY_CAST(trim(value, ' ' || chr(9)) AS DOUBLE)) FILTER (WHERE indicator = '{n}') AS BIGINT) AS \"{n}\"",
                "decimal": f"max(TRY_CAST(trim(value, ' ' || chr(9)) AS DOUBLE)) FILTER (WHERE indicator = '{n}') AS \"{n}\"",
                "flag": f"bool_or(lower(trim(value)) IN {kinds}) FILTER (WHERE indicator = '{n}') AS \"{n}\"",
                "label": f"max(value) FILTER (WHERE indicator = '{n}') AS \"{n}\"",
            }[t]
            for n, t in INDICATORS.items()
        )
        + " FROM top GROUP BY dataset, code, yr",
        "p6_found": f"WITH {_SNAPSHOTS} SELECT table_name, CAST(snapshot_no AS INT) AS snapshot_no, fips_code, change_kind FROM diff WHERE change_kind IS NOT NULL",
        "p6_ledger": f"WITH {_SNAPSHOTS} SELECT table_name, CAST(snapshot_no AS INT) AS snapshot_no, change_kind, count(*) AS records FROM diff WHERE change_kind IS NOT NULL GROUP BY ALL",
    }


# The indicators of the download recipe, which name the columns of the SQL for p3_wide.
INDICATORS = {
    "POP": "integer", "POP_URB": "integer", "GDPX": "decimal", "GDPX_PC": "decimal", "BIRTH_RT": "decimal", "DEATH_RT": "decimal",
    "MIG_NET": "integer", "LIFE_EXP": "decimal", "SCH_YRS": "decimal", "ELEC_ACC": "decimal", "WATER_ACC": "decimal", "ROAD_KM": "integer",
    "PORT_N": "integer", "DEBT_EXT": "decimal", "REV_TAX": "decimal", "EMIS_T": "decimal", "FOREST_SH": "decimal", "ARABLE_HA": "integer",
    "INFL": "decimal", "CONFLICT_FL": "flag", "CENSUS_FL": "flag", "EST_FL": "flag", "SRC_NOTE": "label", "METHOD": "label",
    "INC_GROUP": "label", "PHONE_SUB": "integer", "NET_USE": "decimal", "BEDS_RT": "decimal", "R_AND_D": "decimal", "TRADE_BAL": "decimal",
}
