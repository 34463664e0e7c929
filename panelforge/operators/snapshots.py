"""Problem 6: what changed between full snapshots.

One pass for any number of snapshots: rows are reduced to one per key and snapshot, then each key is windowed by snapshot
index. Equal lag hashes mean unchanged; a gap in the index means a removal after its left end and an addition at its right.

Defined results. A row without a code names no record. Of several rows for a code in one snapshot the last received counts
(of equal times the larger row_id). A snapshot is compared with the next that was delivered for the same table. Null names
equal each other only; NaN is read as null. Copies of a row change nothing. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.columns import code_key, salted_lookup, squeeze

#: Relative size up to which two values are the same value with number noise.
NOISE = 1e-9


def snapshot_changes(rows: DataFrame, value: str = "2023", noise: float = NOISE) -> DataFrame:
    """table_name, snapshot_no, fips_code, change_kind (added, removed, changed), with the name and value before and after."""
    known = rows.where(F.col("table_name").isNotNull() & F.col("snapshot_no").isNotNull())
    by_table = Window.partitionBy("table_name").orderBy("snapshot_no")
    index = known.groupBy("table_name", "snapshot_no").agg(F.lit(1).alias("_one")).select(
        "table_name", "snapshot_no", F.row_number().over(by_table).alias("idx"), F.lead("snapshot_no").over(by_table).alias("next_no"))
    number = F.nanvl(F.col(value), F.lit(None).cast("double"))
    seen = known.withColumn("fips_code", code_key(F.col("FIPS_CODE"))).where("fips_code IS NOT NULL")
    last = seen.groupBy("table_name", "fips_code", "snapshot_no").agg(F.max(F.struct("received_at", "row_id", F.lower(squeeze(F.col("Country"))).alias("name"), number.alias("value"))).alias("_r"))
    # The last state of a key rides along until the next one; snapshot indexes meet it by table and number.
    state = salted_lookup(last.select("table_name", "fips_code", "snapshot_no", "_r.name", "_r.value"), index, ["table_name", "snapshot_no"])
    state = state.withColumn("hash", F.xxhash64(F.coalesce("name", F.lit("\u0000")), "value"))
    by_key = Window.partitionBy("table_name", "fips_code").orderBy("idx")
    lag = {f"before_{c}": F.lag(c).over(by_key) for c in ("idx", "hash", "name", "value")}
    moved = state.withColumns({**lag, "after_idx": F.lead("idx").over(by_key)})
    a, b = F.col("before_value"), F.col("value")
    differs = ~F.col("before_name").eqNullSafe(F.col("name")) | (a.isNull() != b.isNull()) | (F.abs(a - b) > F.lit(noise) * F.greatest(F.abs(a), F.abs(b)))
    follows = F.col("before_idx") == F.col("idx") - 1
    here = (
        F.when((F.col("idx") > 1) & ~F.coalesce(follows, F.lit(False)), "added")
        .when(follows & (F.col("before_hash") != F.col("hash")) & F.coalesce(differs, F.lit(False)), "changed")
    )
    gone = F.when(F.col("next_no").isNotNull() & ~F.coalesce(F.col("after_idx") == F.col("idx") + 1, F.lit(False)), "removed")
    entry = lambda no, kind, n0, v0, n1, v1: F.struct(F.col(no).cast("int").alias("snapshot_no"), kind.alias("change_kind"), n0.alias("name_before"), v0.alias("value_before"), n1.alias("name_after"), v1.alias("value_after"))
    none, nan = F.lit(None).cast("string"), F.lit(None).cast("double")
    was = follows & (here == "changed")
    both = F.array(
        entry("snapshot_no", here, F.when(was, F.col("before_name")), F.when(was, a), F.col("name"), b),
        entry("next_no", gone, F.col("name"), b, none, nan),
    )
    out = moved.select("table_name", "fips_code", F.explode(both).alias("_e")).select("table_name", "_e.snapshot_no", "fips_code", "_e.change_kind", "_e.name_before", "_e.value_before", "_e.name_after", "_e.value_after")
    return out.where("change_kind IS NOT NULL")
