"""Problem 2: rows that fail to parse, separated with their reason while the valid rows load.

Structure is judged per line by splitting at the quote character: pieces at even places lie outside quotes, pieces at odd
places inside. Values are judged once per distinct text: texts that a cheap pattern settles never leave the scan, the rest
go distinct through an exact cast, and only the invalid ones form the dictionary that is joined back.

Defined results. A null line has one field. Lines of a file without a header row fail with `column_count`; of several header
rows the one with the smallest row_id counts. Null, blank and `..` values are missing and never fail. Repeated rows are each
judged and each keep their own result. Columns that the operator doesn't name are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.columns import is_blank, salted_lookup, strip
from panelforge.functions.numbers import PLAIN_WHOLE, is_plain, judge

DELIMITERS = (",", ";", "|", "\t")
#: Stands for the delimiter while a line is cut up; a Unicode noncharacter, reserved from interchange.
CUT = "﷐"
FLAGS = ("y", "n", "yes", "no", "true", "false", "1", "0")
TYPES = ("integer", "decimal", "flag", "label")


def is_missing(c: Column) -> Column:
    return c.isNull() | is_blank(c) | (strip(c) == "..")


def _pieces(line: Column) -> Column:
    return F.split(F.coalesce(line, F.lit("")), '"', -1)


def _middle(pieces: Column) -> Column:
    """The pieces but the first and the last. Lambdas over them must not name `pieces`, which would be cut anew each time."""
    return F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 2, F.lit(0)))


def well_quoted(line: Column, delimiter: Column) -> Column:
    """Whether each field that begins with a quote ends with one, inner ones doubled, and no other field holds a quote."""
    pieces = _pieces(line)
    last = F.size(pieces) - 1
    # Of the middle pieces every second, from the second on, lies outside quotes.
    outside = F.filter(_middle(pieces), lambda x, i: i % 2 == 1)
    middle_ok = F.forall(outside, lambda x: (x == "") | (F.startswith(x, delimiter) & F.endswith(x, delimiter)))
    first, end = F.element_at(pieces, 1), F.element_at(pieces, -1)
    ends_ok = (last == 0) | (((first == "") | F.endswith(first, delimiter)) & ((end == "") | F.startswith(end, delimiter)))
    return (last % 2 == 0) & ends_ok & middle_ok


def fields(line: Column, delimiter: Column) -> Column:
    """The unquoted fields of a well-quoted line."""
    pieces = _pieces(line)
    cut = lambda x: F.replace(x, delimiter, F.lit(CUT))
    middle = F.transform(_middle(pieces), lambda x, i: F.when(i % 2 == 0, x).when(x == "", F.lit('"')).otherwise(cut(x)))
    end = F.when(F.size(pieces) > 1, cut(F.element_at(pieces, -1))).otherwise("")
    return F.split(F.concat(cut(F.element_at(pieces, 1)), F.array_join(middle, ""), end), CUT, -1)


def field_count(line: Column, delimiter: Column) -> Column:
    """Number of fields of a well-quoted line, without cutting it."""
    cuts = F.transform(F.filter(_pieces(line), lambda x, i: i % 2 == 0), lambda x: F.length(x) - F.length(F.replace(x, delimiter, F.lit(""))))
    return F.aggregate(cuts, F.lit(1), lambda a, b: a + b)


def headers(lines: DataFrame) -> DataFrame:
    """import_file, delimiter and header fields of each file, from its line 0."""
    first = lines.where(F.col("line_no") == 0).groupBy("import_file").agg(F.min_by("raw_line", "row_id").alias("_line"))
    options = F.array(*[F.struct(field_count(F.col("_line"), F.lit(d)).alias("n"), F.lit(-i).alias("order"), F.lit(d).alias("d")) for i, d in enumerate(DELIMITERS)])
    best = first.withColumn("delimiter", F.array_max(options)["d"])
    return best.select("import_file", "delimiter", fields(F.col("_line"), F.col("delimiter")).alias("header"))


def _kind_and_suspect(kind: Column, value: Column) -> Column:
    """Whether a value that isn't missing needs a verdict: no pattern or list settles that it fits its kind."""
    flag_ok = F.lower(strip(value)).isin(*FLAGS)
    return ~is_missing(value) & F.when(kind == "decimal", ~is_plain(value)).when(kind == "integer", ~value.rlike(PLAIN_WHOLE)).when(kind == "flag", ~flag_ok).otherwise(False)


def invalid_values(suspects: DataFrame) -> DataFrame:
    """The dictionary (kind, value, detail) of the invalid among suspect values, each distinct one cast once."""
    once = suspects.select("kind", "value").distinct().withColumns({"whole": F.col("kind") == "integer", "settled": F.when(F.col("kind") == "flag", "no flag")})
    return judge(once, "whole", "settled").select("kind", "value", "detail")


def _judged(rows: DataFrame, kind: Column, value: Column) -> DataFrame:
    """rows with `detail`, the reason against their value or null. Rows without a suspect value don't meet the dictionary."""
    own = rows.withColumns({"_kind": kind, "_value": value}).withColumn("_suspect", F.coalesce(_kind_and_suspect(F.col("_kind"), F.col("_value")), F.lit(False)))
    suspects = own.where("_suspect")
    book = invalid_values(suspects.select(F.col("_kind").alias("kind"), F.col("_value").alias("value")))
    book = book.select(F.col("kind").alias("_kind"), F.col("value").alias("_value"), F.col("detail"))
    bad = salted_lookup(suspects, book, ["_kind", "_value"])
    settled = own.where("NOT _suspect").withColumn("detail", F.lit(None).cast("string"))
    return bad.unionByName(settled).drop("_kind", "_value", "_suspect")


def triage_lines(lines: DataFrame, value_field: str = "2020") -> DataFrame:
    """Every line but headers with `reason` (null where it loads), `detail`, its `parsed` fields and the number `loaded`.

    Needs row_id, import_file, line_no and raw_line. The first reason that applies: broken_quoting, column_count, invalid_value.
    """
    top = headers(lines)
    body = salted_lookup(lines.where(F.coalesce(F.col("line_no"), F.lit(-1)) != 0), top, ["import_file"])
    line, d = F.col("raw_line"), F.col("delimiter")
    shaped = body.withColumn(
        "_shape",
        F.when(d.isNull(), "column_count").when(~well_quoted(line, d), "broken_quoting").when(field_count(line, d) != F.size("header"), "column_count"),
    ).withColumn("parsed", F.when(F.col("_shape").isNull(), fields(line, d)))
    place = F.array_position("header", F.lit(value_field)).cast("int")
    text = F.when(place > 0, F.try_element_at("parsed", place))
    judged = _judged(shaped.withColumn("_text", text), F.lit("decimal"), F.col("_text"))
    reason = F.coalesce(F.col("_shape"), F.when(F.col("detail").isNotNull(), "invalid_value"))
    loaded = F.when(reason.isNull() & ~is_missing(F.col("_text")), F.col("_text"))
    return judged.withColumns({"reason": reason, "loaded": F.regexp_replace(loaded, r"[ \t]", "").try_cast("double")}).drop("_shape", "_text")


def triage_values(rows: DataFrame, kinds: DataFrame) -> DataFrame:
    """Every row with `reason` (null where it loads), `detail`, `listed` (its listed indicator) and `value_type`.

    rows needs indicator and value, kinds indicator and value_type. Indicators meet trimmed and in any case. A row with an
    unlisted indicator doesn't fail.
    """
    known = kinds.select(F.upper(strip("indicator")).alias("_key"), F.col("indicator").alias("listed"), "value_type").dropDuplicates(["_key"])
    named = salted_lookup(rows.withColumn("_key", F.upper(strip(F.col("indicator")))), known, ["_key"]).drop("_key")
    judged = _judged(named, F.col("value_type"), F.col("value"))
    return judged.withColumn("reason", F.when(F.col("detail").isNotNull(), "invalid_value"))


def failures(lines: DataFrame, rows: DataFrame, kinds: DataFrame) -> DataFrame:
    """tab, row_id and reason of every line of seriesbad and row of download that fails."""
    a = triage_lines(lines).where("reason IS NOT NULL").select(F.lit("seriesbad").alias("tab"), "row_id", "reason")
    b = triage_values(rows, kinds).where("reason IS NOT NULL").select(F.lit("download").alias("tab"), "row_id", "reason")
    return a.unionByName(b)
