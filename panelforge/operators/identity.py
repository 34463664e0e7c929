"""Identity of names and codes, exact after normalization and never guessed: concordance, repair decisions, convergence."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from panelforge.functions.columns import is_blank, salted_lookup, strip


@F.pandas_udf(StringType())
def _folded(names: pd.Series) -> pd.Series:
    return names.map(lambda t: None if t is None else " ".join(unicodedata.normalize("NFKC", t).casefold().split()))


def normalized(c: Column) -> Column:
    """Compatibility forms resolved, case folded, white space collapsed. ASCII text stays inside the JVM."""
    plain = F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))
    return F.when(c.rlike(r"^[\x20-\x7e]*\z"), plain).otherwise(_folded(F.when(~c.rlike(r"^[\x20-\x7e]*\z"), c)))


def aliases(roster: DataFrame, others: str | None = None) -> DataFrame:
    """alias_norm, code and canonical (whether it is the code's own name), from entity, code and an array of other names."""
    own = roster.select(F.col("entity").alias("_a"), "code", F.lit(True).alias("canonical"))
    if others:
        own = own.unionByName(roster.select(F.explode(others).alias("_a"), "code", F.lit(False).alias("canonical")))
    named = own.where(F.col("_a").isNotNull() & ~is_blank(F.col("_a"))).select(normalized(F.col("_a")).alias("alias_norm"), "code", "canonical")
    return named.groupBy("alias_norm", "code").agg(F.max("canonical").alias("canonical"))


def concordance(names: DataFrame, alias: DataFrame, reviewed: DataFrame | None = None, excluded: DataFrame | None = None) -> DataFrame:
    """original_name, rows, code and status (excluded, reviewed, matched, ambiguous, unresolved) of each distinct name.

    An exclusion counts before a review, a review before the aliases. names: original_name. reviewed: original_name and
    matched_code (null while undecided). excluded: original_name.
    """
    each = names.select(strip(F.col("original_name")).alias("original_name")).groupBy("original_name").agg(F.count("*").alias("rows"))
    codes = alias.groupBy("alias_norm").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    met = each.withColumn("alias_norm", normalized(F.col("original_name"))).join(codes, "alias_norm", "left")
    met = met.join(reviewed.select("original_name", "matched_code", F.lit(True).alias("_rev")), "original_name", "left") if reviewed is not None else met.withColumns({"matched_code": F.lit(None).cast("string"), "_rev": F.lit(None).cast("boolean")})
    met = met.join(excluded.select("original_name", F.lit(True).alias("_exc")), "original_name", "left") if excluded is not None else met.withColumn("_exc", F.lit(None).cast("boolean"))
    n = F.coalesce(F.size("codes"), F.lit(0))
    status = F.when(F.col("_exc"), "excluded").when(F.col("_rev"), F.when(F.col("matched_code").isNull(), "unresolved").otherwise("reviewed")).when(n == 1, "matched").when(n > 1, "ambiguous").otherwise("unresolved")
    return met.withColumn("status", status).select("original_name", "rows", F.when(F.col("status") == "reviewed", F.col("matched_code")).when(F.col("status") == "matched", F.get("codes", F.lit(0))).alias("code"), "status")


def converging(matches: DataFrame) -> DataFrame:
    """Codes that several source names lead to, with the names."""
    got = matches.where("code IS NOT NULL").groupBy("code").agg(F.array_sort(F.collect_set("original_name")).alias("names"))
    return got.where(F.size("names") > 1).select("code", F.size("names").alias("sources"), F.array_join("names", ";").alias("names"))


def bundle_status(matches: DataFrame) -> DataFrame:
    """One row: blocked, needs_processing_review or ready."""
    bad = F.count_if(F.col("status").isin("unresolved", "ambiguous"))
    mapped = F.count_if(F.col("code").isNotNull())
    targets = F.count_distinct(F.col("code"))
    return matches.agg(F.when(bad > 0, "blocked").when(mapped > targets, "needs_processing_review").when(mapped == 0, "blocked").otherwise("ready").alias("status"))


def repair_identity(rows: DataFrame, roster: DataFrame, alias: DataFrame, reviewed: DataFrame | None = None) -> DataFrame:
    """rows (entity, code) with fixed_entity, fixed_code and decision: canonical_code, recovered_code, or an error's name.

    In order: a reviewed name without target fails; a reviewed target fails that contradicts the code or isn't the only one
    that the aliases allow; a name known only as another's alias fails without review even beside a valid code; several codes,
    or one other than the given, fail; a known code, in any spelling, gives its canonical name, also to a missing or unknown
    one; an unknown code fails; one alias recovers a missing code; all else is an unknown name. Reviews meet the trimmed name.
    """
    by_code = roster.select(normalized(F.col("code")).alias("_folded"), F.col("code").alias("_code"), F.lit(True).alias("_known")).dropDuplicates(["_folded"])
    by_name = alias.groupBy("alias_norm").agg(F.array_sort(F.collect_set("code")).alias("_choices"), F.max("canonical").alias("_own"))
    keyed = rows.withColumns({"alias_norm": normalized(F.col("entity")), "_label": strip(F.col("entity")), "_token": F.coalesce(strip(F.col("code")), F.lit("")), "_folded": normalized(F.col("code"))})
    met = salted_lookup(salted_lookup(keyed, by_code, ["_folded"]), by_name, ["alias_norm"])
    if reviewed is not None:
        met = met.join(reviewed.select(strip(F.col("original_name")).alias("_label"), F.col("matched_code").alias("_target"), F.lit(True).alias("_rev")).dropDuplicates(["_label"]), "_label", "left")
    else:
        met = met.withColumns({"_target": F.lit(None).cast("string"), "_rev": F.lit(None).cast("boolean")})
    known = F.coalesce(F.col("_known"), F.lit(False)) & (F.col("_token") != "")
    match = F.when(known, F.col("_code"))
    listed = F.coalesce(F.size("_choices"), F.lit(0))
    told = F.coalesce(F.col("_rev"), F.lit(False))
    contradicts = (known & (F.col("_target") != match)) | ((listed > 0) & ((listed > 1) | (F.get("_choices", F.lit(0)) != F.col("_target"))))
    choice = F.coalesce("_target", F.when(listed == 1, F.get("_choices", F.lit(0))))
    several = ~told & (listed > 1)
    decision = (
        F.when(told & F.col("_target").isNull(), "error_review_pending").when(told & F.coalesce(contradicts, F.lit(False)), "error_review_contradicts")
        .when(~told & (listed > 0) & ~F.coalesce(F.col("_own"), F.lit(False)), "error_alias_needs_review")
        .when(several | (choice.isNotNull() & known & (choice != match)), "error_conflict")
        .when(known, "canonical_code").when(F.col("_token") != "", "error_unknown_code")
        .when(choice.isNotNull(), "recovered_code").otherwise("error_unknown_name")
    )
    decided = met.withColumns({"decision": decision, "_match": match, "_choice": choice})
    fixed = F.when(F.col("decision") == "canonical_code", F.col("_match")).when(F.col("decision") == "recovered_code", F.col("_choice"))
    out = decided.withColumn("fixed_code", fixed).drop("alias_norm", "_label", "_token", "_folded", "_code", "_known", "_choices", "_own", "_target", "_rev", "_match", "_choice")
    return salted_lookup(out, roster.select(F.col("code").alias("fixed_code"), F.col("entity").alias("fixed_entity")), ["fixed_code"])
