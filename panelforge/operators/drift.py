"""Problem 1: records whose fields drift between files, read into one consistent table with a report of each change.

Profiles of fields (types, nesting, presence) and the values that a vanished and a new name hold for the same entity are
aggregated over all records. What is left per pair of consecutive files is a small schema graph of names, types and nested
fields. Similarity flooding propagates match scores over it until they converge: every vanished field may correspond to every
new one or to none, and the scores of "none" are flooded like all others. A field is renamed where a correspondence ends above
both of its alternatives; correspondences are one to one. They are chained over the files of a feed, and the records are cast
and united under the names that a field bore first.

Defined results. The file before is the one with the preceding seq of the feed, whenever it was received. A record that
isn't a JSON object has no fields. Null values have no type and no text. A field without non-null values in one of the two
files isn't retyped. Records without Table or Variable prove no rename. Doubled records count once. Other columns are
passed through by `consolidate` only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.session import cut

#: A value counts as the same if at most so many edits, or this share of its length, lie between the texts.
EDITS, EDIT_SHARE = 2, 0.15
#: What two fields that met in no entity start with, as if they had agreed in so many of one entity.
PRIOR = 0.4
#: How much of a start score is agreement on values; the rest is likeness of the names.
VALUES = 0.85
#: What a field's having no correspondence starts with.
NONE = 0.56
#: Start scores of two equal and two unequal types.
SAME_TYPE, OTHER_TYPE = 1.0, 0.3
#: How much neighbours in the graph add to a score in each round.
SPREAD = 0.2
#: Flooding stops when no score moves by more than this, or after so many rounds.
SETTLED, ROUNDS = 1e-4, 200


def cells(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per record and field: feed, seq, import_file, record_id, keep, tab, variable, field, kind, nested (its schema), value (text)."""
    parsed = records.withColumn("_v", F.try_parse_json("record"))
    flat = parsed.select(
        "feed", "seq", "import_file", "record_id", *keep,
        F.try_variant_get("_v", "$.Table", "string").alias("tab"), F.try_variant_get("_v", "$.Variable", "string").alias("variable"), "_v",
    )
    each = flat.where(F.schema_of_variant("_v").startswith("OBJECT")).lateralJoin(
        records.sparkSession.tvf.variant_explode(F.col("_v").outer())
    ).drop("_v")
    shape = F.schema_of_variant("value")
    kind = (
        F.when(shape == "VOID", None).when(shape == "STRING", "string").when(shape == "BOOLEAN", "boolean")
        .when(shape.startswith("ARRAY"), "array").when(shape.startswith("OBJECT"), "object").otherwise("number")
    )
    text = F.when(kind.isin("array", "object"), F.to_json("value")).otherwise(F.try_variant_get("value", "$", "string"))
    return each.select("feed", "seq", "import_file", "record_id", *keep, "tab", "variable", F.col("key").alias("field"), kind.alias("kind"), F.when(kind.isin("array", "object"), shape).alias("nested"), text.alias("value"))


def profiles(each: DataFrame) -> DataFrame:
    """One row per file and field: its non-null types, a schema of its nested values, and how many records hold it."""
    return each.groupBy("feed", "seq", "import_file", "field").agg(F.sort_array(F.collect_set("kind")).alias("kinds"), F.max("nested").alias("nested"), F.count("*").alias("held"))


def presence(fields: DataFrame, files: DataFrame) -> DataFrame:
    """Fields of each file beside those of the file before: feed, seq, import_file, field, kinds, old_kinds, nested, old_nested, status."""
    order = Window.partitionBy("feed").orderBy("seq")
    index = files.select("feed", "seq", "import_file").groupBy("feed", "seq").agg(F.min("import_file").alias("import_file")).select("feed", "seq", "import_file", F.lag("seq").over(order).alias("before"))
    now = index.where("before IS NOT NULL").join(fields.select("feed", "seq", "field", "kinds", "nested"), ["feed", "seq"])
    then = index.where("before IS NOT NULL").join(fields.select("feed", F.col("seq").alias("before"), "field", F.col("kinds").alias("old_kinds"), F.col("nested").alias("old_nested")), ["feed", "before"])
    both = now.join(then, ["feed", "seq", "before", "import_file", "field"], "full")
    status = F.when(F.col("kinds").isNull(), "removed").when(F.col("old_kinds").isNull(), "added").otherwise("kept")
    return both.withColumn("status", status)


def evidence(each: DataFrame, marks: DataFrame) -> DataFrame:
    """Per file and pair of a vanished and a new name: entities with both values, and how many of those agree.

    Only fields that vanished or came meet, and only within one entity of two consecutive files: its last values are put
    together into one row, which the number of fields bounds. The records are read once.
    """
    entry = lambda at, role, when: F.when(when, F.struct(F.col(at).alias("file"), F.col("seq").alias("at"), F.lit(role).alias("role")))
    asked = marks.select("feed", "field", F.coalesce(entry("before", "old", F.col("status") == "removed"), entry("seq", "new", F.col("status") == "added")).alias("_e")).where("_e IS NOT NULL")
    asked = asked.select("feed", F.col("_e.file").alias("seq"), "field", "_e.at", "_e.role")
    told = each.where("value IS NOT NULL AND tab IS NOT NULL AND variable IS NOT NULL").select("feed", "seq", "record_id", "tab", "variable", "field", "value").join(asked, ["feed", "seq", "field"])
    last = told.groupBy("feed", "at", "tab", "variable", "role", "field").agg(F.max(F.struct("record_id", "value")).alias("_v"))
    side = lambda role: F.collect_list(F.when(F.col("role") == role, F.struct("field", F.col("_v.value").alias("value"))))
    entity = last.groupBy("feed", "at", "tab", "variable").agg(side("old").alias("old"), side("new").alias("new")).where((F.size("old") > 0) & (F.size("new") > 0))
    met = entity.select("feed", F.col("at").alias("seq"), F.explode("old").alias("o"), "new").select("feed", "seq", "o", F.explode("new").alias("n"))
    met = met.select("feed", "seq", F.col("o.field").alias("old_field"), F.col("n.field").alias("new_field"), F.col("o.value").alias("a"), F.col("n.value").alias("b"))
    size = "greatest(length(a), length(b))"
    most = f"cast(least(floor({size} * {EDIT_SHARE}) + if({size} >= 6, 1, 0), {EDITS} + floor({size} * {EDIT_SHARE})) as int)"
    same = f"a = b OR abs(length(a) - length(b)) <= {most} AND levenshtein(a, b, {most}) >= 0"
    return met.groupBy("feed", "seq", "old_field", "new_field").agg(F.count("*").alias("met"), F.count_if(F.expr(same)).alias("agree"))


def _name_score(a: str, b: str) -> float:
    """Likeness of two field names by shared character pairs, 0 to 1."""
    pairs = [{"".join(x) for x in zip(s, s[1:])} for s in ("".join(c for c in t.lower() if c.isalnum()) for t in (a, b))]
    total = sum(map(len, pairs))
    return 2 * len(pairs[0] & pairs[1]) / total if total else float(a.lower() == b.lower())


def flood(start: dict, links: list[tuple], settled: float = SETTLED, rounds: int = ROUNDS) -> dict:
    """Similarity flooding over a graph of pairs.

    start: the start score of each node. links: (node, node, label), passed both ways. A node passes its score on in equal
    shares per label. In each round a node keeps its start and present scores and adds SPREAD of what reaches it; then all are
    divided by the largest, until none moves by more than `settled`.
    """
    place = {n: i for i, n in enumerate(start)}
    ends = np.array([(place[a], place[b]) for a, b, _ in links] + [(place[b], place[a]) for a, b, _ in links], dtype=int).reshape(-1, 2)
    # Both ways of a label are counted apart: a field has one nest, a nest many fields.
    labels = [("to", *x[::2]) for x in links] + [("from", x[1], x[2]) for x in links]
    count: dict = {}
    for x in labels:
        count[x] = count.get(x, 0) + 1
    share = np.array([1 / count[x] for x in labels])
    first = np.array(list(start.values()))
    score = first.copy()
    for _ in range(rounds):
        now = first + score
        reach = np.zeros(len(first))
        np.add.at(reach, ends[:, 1], now[ends[:, 0]] * share)
        new = now + SPREAD * reach / np.maximum(np.bincount(ends[:, 1], minlength=len(first)), 1)
        new /= new.max()
        moved, score = np.abs(new - score).max(), new
        if moved <= settled:
            break
    return dict(zip(start, score.tolist()))


_NESTED = re.compile(r"(\w+|`[^`]*`): (\w+)|(>)|(OBJECT<|ARRAY<)")


def nested_fields(schema: str | None) -> frozenset[tuple[str, str]]:
    """Path and type of each field within a nested value's schema."""
    out, path, opened = set(), [], []
    for m in _NESTED.finditer(schema or ""):
        name, kind, shut, _ = m.groups()
        if shut:
            if opened and opened.pop():
                path.pop()
        elif name:
            out.add((".".join([*path, name.strip("`")]), kind))
            if kind in ("OBJECT", "ARRAY"):
                path.append(name.strip("`"))
                opened.append(True)
        else:
            opened.append(False)
    return frozenset(out)


def schema_graph(old: dict[str, tuple], new: dict[str, tuple], met: dict[tuple[str, str], tuple[int, int]]) -> tuple[dict, list]:
    """Start scores and links of the pairs of two schemas. old, new: types and nested fields by name; met: entities, agreeing.

    Nodes are pairs of fields, each field without a partner, pairs of types, pairs of nested fields, and the pair of roots.
    """
    start: dict = {"root": 1.0, ("type", None): (SAME_TYPE + OTHER_TYPE) / 2}
    links: list[tuple] = []
    for alone in [("field", o, None) for o in old] + [("field", None, n) for n in new]:
        start[alone] = NONE
        links += [("root", alone, "field"), (alone, ("type", None), "type")]
    for o, (kinds, inner) in old.items():
        for n, (other, within) in new.items():
            pair = ("field", o, n)
            both, agree = met.get((o, n), (0, 0))
            start[pair] = VALUES * (agree + PRIOR) / (both + 1) + (1 - VALUES) * _name_score(o, n)
            types = ("type", kinds, other)
            start.setdefault(types, SAME_TYPE if kinds == other else OTHER_TYPE)
            links += [("root", pair, "field"), (pair, types, "type")]
            # Each nested field meets its likest partner; one that has none speaks against the pair.
            for mine, theirs, way in ((inner, within, "old"), (within, inner, "new")):
                for path, kind in mine:
                    child = ("nested", o, n, way, path)
                    start[child] = max((_name_score(path, name) * (1.0 if kind == its else 0.5) for name, its in theirs), default=0.0)
                    links.append((pair, child, "nested"))
    return start, links


def select(old: dict[str, tuple], new: dict[str, tuple], met: dict[tuple[str, str], tuple[int, int]]) -> list[tuple[str, str]]:
    """The consistent correspondences (old, new) of one pair of files: best flooded score first, each field once."""
    score = flood(*schema_graph(old, new, met))
    pairs = [(o, n) for o in old for n in new if score["field", o, n] > max(score["field", o, None], score["field", None, n])]
    taken: set[str] = set()
    out = []
    for o, n in sorted(pairs, key=lambda p: (-round(score["field", *p], 9), p)):
        if "o:" + o not in taken and "n:" + n not in taken:
            taken |= {"o:" + o, "n:" + n}
            out.append((o, n))
    return out


def renames(each: DataFrame, marks: DataFrame) -> DataFrame:
    """feed, seq, old_field, field: the names of a file that a vanished name of the file before has taken on."""
    met = evidence(each, marks).select("feed", "seq", F.struct(F.lit("met").alias("role"), F.col("old_field").alias("a"), F.col("new_field").alias("b"), F.array().cast("array<string>").alias("kinds"), F.lit(None).cast("string").alias("nested"), "met", "agree").alias("x"))
    none = F.lit(None).cast("bigint")
    seen = marks.where("status <> 'kept'").select("feed", "seq", F.struct(F.col("status").alias("role"), F.col("field").alias("a"), F.lit("").alias("b"), F.coalesce("kinds", "old_kinds").alias("kinds"), F.coalesce("nested", "old_nested").alias("nested"), none.alias("met"), none.alias("agree")).alias("x"))
    # One schema graph is one row, bounded by the fields of two files.
    whole = seen.unionByName(met).groupBy("feed", "seq").agg(F.collect_list("x").alias("xs")).where("exists(xs, x -> x.role = 'removed') AND exists(xs, x -> x.role = 'added')")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for r in batch.itertuples():
                side = lambda role: {x["a"]: (tuple(x["kinds"]), nested_fields(x["nested"])) for x in sorted(r.xs, key=lambda x: x["a"]) if x["role"] == role}  # noqa: B023, E731
                met = {(x["a"], x["b"]): (x["met"], x["agree"]) for x in r.xs if x["role"] == "met"}
                found += [(r.feed, r.seq, o, n) for o, n in select(side("removed"), side("added"), met)]
            yield pd.DataFrame(found, columns=["feed", "seq", "old_field", "field"])

    return whole.mapInPandas(run, "feed string, seq int, old_field string, field string")


def changes(each: DataFrame, marks: DataFrame, moved: DataFrame) -> DataFrame:
    """The report: feed, seq, import_file, field, old_field, change_kind (renamed, added, removed, retyped), kinds before and after."""
    old = marks.where("status = 'removed'").select("feed", "seq", F.col("field").alias("old_field"), F.col("old_kinds").alias("was"))
    came = marks.join(moved.join(old, ["feed", "seq", "old_field"]), ["feed", "seq", "field"], "left")
    named = came.withColumn("old_kinds", F.coalesce("old_kinds", "was"))
    gone = moved.select("feed", "seq", F.col("old_field").alias("field"), F.lit(True).alias("_moved"))
    named = named.join(gone, ["feed", "seq", "field"], "left")
    first = F.when(F.col("old_field").isNotNull(), "renamed").when(F.col("status") == "added", "added").when((F.col("status") == "removed") & F.col("_moved").isNull(), "removed")
    kept = (F.col("status") == "kept") | F.col("old_field").isNotNull()
    second = F.when(kept & (F.size("kinds") > 0) & (F.size("old_kinds") > 0) & (F.col("kinds") != F.col("old_kinds")), "retyped")
    out = named.withColumn("change_kind", F.explode(F.array(first, second))).where("change_kind IS NOT NULL")
    return out.select("feed", "seq", "import_file", "field", "old_field", "change_kind", "old_kinds", "kinds")


def drift(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The change report, the fields' marks and the renames of a table of records."""
    each = cells(records)
    fields = cut(profiles(each))
    marks = cut(presence(fields, fields))
    moved = cut(renames(each, marks))
    return changes(each, marks, moved), marks, moved


def canonical_names(fields: DataFrame, marks: DataFrame, moved: DataFrame, most_rounds: int = 40) -> DataFrame:
    """feed, seq, field, name: the name that a field bore first, through all renames.

    A stretch is a field over consecutive files; a renamed stretch points at the stretch it came from. Pointers are doubled
    until none moves, in as many rounds as the logarithm of the longest chain of renames.
    """
    starts = fields.join(marks.where("status <> 'kept'").select("feed", "seq", "field", "status"), ["feed", "seq", "field"], "left")
    order = Window.partitionBy("feed", "field").orderBy("seq")
    first = F.row_number().over(order) == 1
    stretch = starts.withColumn("_new", F.coalesce((F.col("status") == "added") | first, F.lit(True))).withColumn("start", F.max(F.when(F.col("_new"), F.col("seq"))).over(order))
    stretch = stretch.select("feed", "seq", "field", "start")
    before = marks.select("feed", "seq", "before").distinct()
    ends = stretch.select("feed", F.col("seq").alias("before"), F.col("field").alias("old_field"), F.col("start").alias("p_start"))
    step = moved.join(before, ["feed", "seq"]).join(ends, ["feed", "before", "old_field"])
    node = stretch.select("feed", "field", "start").distinct()
    up = node.join(step.select("feed", "field", F.col("seq").alias("start"), F.col("old_field").alias("p_field"), "p_start"), ["feed", "field", "start"], "left")
    up = cut(up.select("feed", "field", "start", F.coalesce("p_field", "field").alias("p_field"), F.coalesce("p_start", "start").alias("p_start")))
    for _ in range(most_rounds):
        above = up.select("feed", F.col("field").alias("p_field"), F.col("start").alias("p_start"), F.col("p_field").alias("q_field"), F.col("p_start").alias("q_start"))
        moving = up.join(above, ["feed", "p_field", "p_start"])
        if moving.where("p_field <> q_field OR p_start <> q_start").isEmpty():
            break
        up = cut(moving.select("feed", "field", "start", F.col("q_field").alias("p_field"), F.col("q_start").alias("p_start")))
    return stretch.join(up, ["feed", "field", "start"]).select("feed", "seq", "field", F.col("p_field").alias("name"))


def consolidate(records: DataFrame, columns: dict[str, str], keep: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """One consistent table: one row per record, the fields of `columns` (name: type) cast, the rest as text in `other`.

    A field is first led back through its renames to its first name. Booleans become 0 and 1 where a number is asked for;
    a value that doesn't fit its type is null in its column and kept as text in `other`. Of two fields of a record that bear
    one name the smaller value counts.
    """
    each = cells(records, keep)
    fields = cut(profiles(each))
    marks = cut(presence(fields, fields))
    names = canonical_names(fields, marks, cut(renames(each, marks)))
    led = each.join(names, ["feed", "seq", "field"]).where("value IS NOT NULL")
    # Each cell is cast once, by its column's type, before the cells of a record meet.
    text, low = F.col("value"), F.lower("value")
    numbers = [n for n, kind in columns.items() if kind != "string"]
    number = F.when(low.isin("true", "yes"), "1").when(low.isin("false", "no"), "0").otherwise(text).try_cast("double")
    led = led.withColumn("_number", F.when(F.col("name").isin(*numbers), number))
    typed = {n: text if kind == "string" else F.col("_number").try_cast(kind) for n, kind in columns.items()}
    lost = ~F.col("name").isin(*columns)
    for kind in sorted({k for k in columns.values() if k != "string"}):
        lost = lost | (F.col("name").isin(*[n for n, k in columns.items() if k == kind]) & F.col("_number").try_cast(kind).isNull())
    cells_of = [F.min(F.when(F.col("name") == n, c)).alias(n) for n, c in typed.items()]
    rest = F.array_sort(F.collect_set(F.when(lost, F.struct("name", "value"))))
    rows = led.groupBy("feed", "seq", "import_file", "record_id", *keep).agg(*cells_of, rest.alias("_rest"))
    once = F.filter("_rest", lambda x, i: (i == 0) | (F.get("_rest", i - 1)["name"] != x["name"]))
    return rows.select("feed", "seq", "import_file", "record_id", *keep, *[F.col(f"`{n}`") for n in columns], F.to_json(F.map_from_entries(once)).alias("other"))
