"""Problem 7: implausible readings, flagged per source relative to that source's normal behaviour.

Residuals are what a reading sticks out of its neighbours: in logarithms and per root of the years between, for one year
alone, for two years together, and for the last year. Yearly figures have no season; the neighbours are the local level.
Per source and kind of residual a generalized Pareto tail, threshold, scale and shape, is fitted to the peaks over the 90 %
point, by quantiles, so that the faults themselves don't stretch it. The fit of a source is drawn towards the pool of all
sources (on residuals divided by the source's median move) by how few residuals it has, without a switch: a source of a
thousand follows itself, one of ten the others. A reading beyond the cutoff at a fixed risk is flagged. Rules for impossible
and for stuck readings come on top.

All statistics are mergeable quantile summaries: a source that holds a third of all rows is summed up by many tasks.

Defined results. Rows without a code and null or NaN readings are left out; codes meet trimmed and in any case. Zero and
negative readings are flagged and aren't neighbours. A row with a single reading can only be impossible. A source without
moves has the pooled median move and tail. Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.columns import code_key, salted_lookup
from panelforge.session import cut

#: Share of residuals that a cutoff lets through by chance: one in a hundred thousand.
RISK = 1e-5
#: The tail begins at the first quantile; its fit uses the two behind it, which halve what is left each time. Single moves,
#: by which last years are judged, also hold real moves to another level; their fit stays clear of those.
PEAKS = {"one": (0.90, 0.95, 0.975), "two": (0.90, 0.95, 0.975), "end": (0.80, 0.90, 0.95)}
#: Residuals at which a source's own fit and the pooled one count alike, and moves at which their median moves do.
EVEN, EVEN_MOVES = 300, 6
#: Bounds on the shape: no lighter than exponential, which would end the tail within the data, and no heavier than population
#: figures have; faults do.
SHAPE = (0.0, 0.15)
#: A floor for cutoffs in median moves where there is nothing to fit a tail to; it fades as a source's own fit gains weight.
LEAST = 6.0
#: An own step between quantiles counts as this part of the pooled one at least, as rounded figures have equal quantiles.
FINEST = 1e-3
#: A stuck run has so many equal readings, in a source of which less than this share of moves is zero.
STUCK_RUN, STICKY = 4, 0.5
KINDS = ("one", "two", "end")


def _aligned(values: np.ndarray, years: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positive readings of each row moved to the left, NaN behind them, and their years."""
    there = values > 0
    order = np.argsort(~there, axis=1, kind="stable")
    v = np.where(np.take_along_axis(there, order, axis=1), np.take_along_axis(values, order, axis=1), np.nan)
    return v, years[order].astype(float)


def _agree(*parts: np.ndarray) -> np.ndarray:
    """The least size of parts that all have one sign, 0 where they haven't, NaN where one is missing."""
    low, high = np.minimum.reduce(parts), np.maximum.reduce(parts)
    return np.where(np.isnan(low), np.nan, np.where(low > 0, low, np.where(high < 0, -high, 0.0)))


def residuals(values: np.ndarray, years: np.ndarray) -> dict[str, np.ndarray]:
    """For rows of readings: the aligned readings `v` and years `y`, their moves `step`, and residuals `one`, `two` and `end`.

    Offsets are differences of logarithms per root of the years between. `one` is how far a reading lies off both its
    neighbours, `two` how far it and the reading of the next year lie off those around them, `end` how far a row's last
    reading lies off the two before.
    """
    v, y = _aligned(values, years)
    n, width = v.shape
    log = np.log(v)

    def off(i: int, j: int) -> np.ndarray:
        """How far each reading shifted by i lies above the one shifted by j, at the place of the unshifted one."""
        out = np.full((n, width), np.nan)
        lo, hi = max(0, -i, -j), width - max(0, i, j)
        if lo < hi:
            a, b = slice(lo + i, hi + i), slice(lo + j, hi + j)
            with np.errstate(divide="ignore", invalid="ignore"):
                out[:, lo:hi] = (log[:, a] - log[:, b]) / np.sqrt(np.abs(y[:, a] - y[:, b]))
        return out

    before, before2 = off(0, -1), off(0, -2)
    pair = np.full((n, width), False)
    pair[:, :-1] = y[:, 1:] == y[:, :-1] + 1
    two = np.where(pair, _agree(before, off(0, 2), off(1, -1), off(1, 2)), np.nan)
    count = (~np.isnan(v)).sum(axis=1)
    last = np.arange(width)[None, :] == count[:, None] - 1
    end = np.where(last, np.where(before * before2 > 0, np.minimum(np.abs(before), np.abs(before2) * np.sqrt(2.0)), np.where(np.isnan(before2), np.nan, 0.0)), np.nan)
    return {"v": v, "y": y, "step": np.abs(before), "one": _agree(before, off(0, 1)), "two": two, "end": end}


def _matrix(batch: pd.DataFrame, columns: list[str]) -> np.ndarray:
    return batch[columns].to_numpy(dtype=float, na_value=np.nan)


def series(rows: DataFrame, columns: list[str]) -> DataFrame:
    """row_id, code and the readings of the rows that have a code."""
    base = rows.withColumn("code", code_key(F.col("FIPS_CODE"))).where("code IS NOT NULL")
    return base.select("row_id", "code", *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])


def moves(ready: DataFrame, columns: list[str]) -> DataFrame:
    """code, step, one and two of each reading; whole batches of rows are computed at once."""
    years = np.array([int(c) for c in columns])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            r = residuals(_matrix(batch, columns), years)
            keep = ~np.isnan(r["step"])
            yield pd.DataFrame({"code": np.repeat(batch["code"].to_numpy(), keep.sum(axis=1)), **{k: r[k][keep] for k in ("step", "one", "two")}})

    return ready.mapInPandas(run, "code string, step double, one double, two double").select("code", *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in ("step", "one", "two")])


def _quantiles(c: str, name: str) -> list[Column]:
    # Most readings don't stick out at all; a tail is a matter of those that do.
    out = F.when(F.col(c) > 0, F.col(c))
    q = F.percentile_approx(out, F.array(*[F.lit(p) for p in PEAKS[name]]), F.lit(1000))
    return [q.alias(f"{name}_q"), F.count(out).alias(f"{name}_n")]


def _steps(q: Column) -> list[Column]:
    """The first of three quantiles and the two steps behind it."""
    return [q[0], q[1] - q[0], q[2] - q[1]]


def _drawn(own: list[Column], pooled: list[Column], weight: Column) -> list[Column]:
    """Own and pooled values mixed in logarithms, so that a few faults among few residuals move the mix little."""
    mix = lambda a, b: F.exp(weight * F.ln(F.greatest(a, b * FINEST)) + (1 - weight) * F.ln(b))
    return [F.when(weight > 0, mix(a, b)).otherwise(b) for a, b in zip(own, pooled)]


def behaviour(ready: DataFrame, columns: list[str], risk: float = RISK) -> DataFrame:
    """Per code: the share of zero moves, its median move, and the cutoff of each kind of residual with its threshold and shape."""
    long = moves(ready, columns)
    # What a last year does against those before is what any year does.
    moved = F.when(F.col("step") > 0, F.col("step"))
    stats = cut(long.groupBy("code").agg(
        F.percentile_approx(moved, 0.5, F.lit(1000)).alias("median"), F.count(moved).alias("moves"), F.avg((F.col("step") == 0).cast("double")).alias("still"),
        *[c for k in KINDS for c in _quantiles(k if k != "end" else "step", k)],
    ))
    # Pooled over sources: each source's tail in units of its own median move. Sources are few rows by now.
    usable = stats.where((F.col("moves") >= EVEN_MOVES) & (F.col("median") > 0))
    pooled = usable.agg(
        F.percentile_approx("median", 0.5).alias("all_median"),
        *[F.expr(f"percentile_approx(({k}_q[{i}]) / median, 0.5)").alias(f"{k}_p{i}") for k in KINDS for i in range(3)],
    )
    both = stats.join(F.broadcast(pooled), how="cross")  # one row
    trust = F.col("moves") / (F.col("moves") + F.lit(float(EVEN_MOVES)))
    anyone = F.coalesce("all_median", F.lit(0.05))
    median = F.when(F.col("median") > 0, F.exp(trust * F.ln("median") + (1 - trust) * F.ln(anyone))).otherwise(anyone)
    told = both.withColumn("base", median)
    out = [F.coalesce("still", F.lit(1.0)).alias("still"), F.col("base")]
    for k in KINDS:
        p0, p1, p2 = [F.coalesce(F.col(f"{k}_p{i}"), F.lit(float(2 + i))) for i in range(3)]
        pool = [F.greatest(p0, F.lit(1e-6)), F.greatest(p1 - p0, F.lit(1e-6)), F.greatest(p2 - p1, F.lit(1e-6))]
        weight = F.col(f"{k}_n") / (F.col(f"{k}_n") + F.lit(float(EVEN)))
        top, spread, further = _drawn([s / F.col("base") for s in _steps(F.col(f"{k}_q"))], pool, weight)
        shape = F.least(F.greatest(F.ln(further / spread) / F.ln(F.lit(2.0)), F.lit(SHAPE[0])), F.lit(SHAPE[1]))
        shape = F.when(F.abs(shape) < 1e-3, 1e-3).otherwise(shape)
        scale = spread * shape / (F.pow(F.lit(2.0), shape) - 1)
        beyond = scale / shape * (F.pow(F.lit(risk / (1 - PEAKS[k][0])), -shape) - 1)
        out += [(F.greatest(top + beyond, F.lit(LEAST) * (1 - weight)) * F.col("base")).alias(f"cut_{k}"), shape.alias(f"shape_{k}")]
    return told.select("code", *out)


def flagged(rows: DataFrame, columns: list[str], risk: float = RISK) -> DataFrame:
    """row_id, yr and reason (impossible, spike, stuck) of each implausible reading; one row per reading and reason."""
    ready = series(rows, columns)
    known = salted_lookup(ready, behaviour(ready, columns, risk), ["code"])
    years = np.array([int(c) for c in columns])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = _matrix(batch, columns)
            r = residuals(values, years)
            limit = {k: batch[f"cut_{k}"].to_numpy(dtype=float, na_value=np.inf)[:, None] for k in KINDS}
            still = batch["still"].to_numpy(dtype=float, na_value=1.0)[:, None]
            twice = r["two"] > limit["two"]
            spike = (r["one"] > limit["one"]) | twice | (r["end"] > limit["end"])
            spike[:, 1:] |= twice[:, :-1]
            # A reading is stuck if it equals the one before and lies in STUCK_RUN equal ones.
            equal = np.zeros_like(spike)
            equal[:, 1:] = r["v"][:, 1:] == r["v"][:, :-1]
            run_of = STUCK_RUN - 1
            places = max(0, equal.shape[1] - run_of + 1)
            whole = np.ones((len(batch), places), dtype=bool)
            for j in range(run_of):
                whole &= equal[:, j : places + j]
            stuck = np.zeros_like(spike)
            for j in range(run_of):
                stuck[:, j : j + places] |= whole
            stuck &= still < STICKY
            ids = batch["row_id"].to_numpy()
            for mask, year, reason in ((spike, r["y"], "spike"), (stuck, r["y"], "stuck"), (values <= 0, np.broadcast_to(years, values.shape), "impossible")):
                at = np.nonzero(mask)
                yield pd.DataFrame({"row_id": ids[at[0]], "yr": year[at].astype("int32"), "reason": reason})

    return known.mapInPandas(run, "row_id bigint, yr int, reason string")
