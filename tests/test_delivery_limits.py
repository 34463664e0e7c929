"""The gate and the order of deliveries, also beyond any number of names that a driver would take."""

import pytest
from pyspark.sql import functions as F

from panelforge.plans import delivery

FINDINGS = "id string, severity string, table_name string"
DECISIONS = "table_name string, action string, reason string"


def shut(spark, findings, decisions, accepted=()):
    got = delivery.gate(spark.createDataFrame(findings, FINDINGS), spark.createDataFrame(decisions, DECISIONS), spark.createDataFrame([(a,) for a in accepted], "id string"))
    return {(r["table_name"], r["id"], r["why"]) for r in got.collect()}


def test_gate_opens_on_decisions_and_accepted_findings_only(spark):
    review = [("1", "review", "T"), ("2", "info", "U")]
    fine = [("T", "replace", "checked against the source"), ("U", "keep_old", "no news")]
    assert shut(spark, review, fine, ["1"]) == set()
    assert shut(spark, review, fine) == {("T", "1", "review finding not accepted")}
    assert shut(spark, review, fine[:1], ["1"]) == {("U", None, "no decision")}
    assert shut(spark, review, [("T", "hold", "wait"), fine[1]], ["1"]) == {("T", None, "held")}
    assert shut(spark, review, [("T", "replace", " "), fine[1]], ["1"]) == {("T", None, "no action or reason")}
    assert shut(spark, review, [("T", "guess", "x"), fine[1]], ["1"]) == {("T", None, "no action or reason")}
    assert shut(spark, review, [*fine, ("T", "keep_old", "x")], ["1"]) == {("T", None, "several decisions")}
    assert shut(spark, review, fine, ["1", "9"]) == {(None, "9", "accepted, but no review finding")}
    assert shut(spark, [("1", "error", "T")], fine[:1], []) == {("T", "1", "error")}, "an error can't be waived"
    assert shut(spark, [], []) == set()


def test_gate_asks_for_every_table(spark):
    many = spark.range(10_050).select(F.col("id").cast("string").alias("id"), F.lit("info").alias("severity"), F.format_string("T%05d", "id").alias("table_name"))
    decided = many.where("table_name < 'T10000'").select("table_name", F.lit("keep_old").alias("action"), F.lit("x").alias("reason"))
    assert delivery.gate(many, decided, spark.createDataFrame([], "id string")).count() == 50


def test_order_takes_any_number_of_batches(spark):
    names = [f"b{k:05}" for k in range(10_050)]
    batches = spark.range(10_050).select(F.format_string("b%05d", "id").alias("batch"), F.col("id").alias("row_id"))
    got = delivery.ordered(batches, names[::-1])
    assert got.where("batch = 'b00000'").first()["seq"] == 10_050 and got.where("seq IS NULL").count() == 0
    with pytest.raises(ValueError, match="b10049"):
        delivery.ordered(batches, names[:-1])
    with pytest.raises(ValueError, match="twice"):
        delivery.ordered(batches, [*names, names[0]])
