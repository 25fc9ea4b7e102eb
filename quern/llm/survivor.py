"""Problem 7: one surviving record for each group of versions, its gaps filled whole bundles first.

What is chosen for a group are bundles, each whole from one record: first the
identity (doc_id, ts, length), then bundles of fields that depend on each other
(an address and the date it was fetched). Trust of an identity is its (ts, length,
doc_id), and it outweighs everything else. The survivor's own fields are kept and
only its empty ones filled, by a bundle that agrees with what the survivor has of
it; where no record of the group has such a whole bundle, its empty fields are
filled one by one, from records that do not contradict the survivor's part of the
bundle first. What is to be largest is the identity, then the number of filled
fields, then the agreement, then the sum of the trust, under functional
dependencies between fields of different bundles (one url has one language). It is
solved by branch and bound:

* the bounding runs distributed. No two identities are worth the same, so their
  bound, a maximum, leaves one for each group and the search begins below it. For
  the other bundles, records are first folded to distinct values (map-side), and
  a candidate whose score plus the best scores of all other parts stays below the
  best that a single record offers is cut off; of candidates that no dependency
  tells apart the best stays;
* with one dependency, each determinant's score plus that of the best dependent
  value seen beside it is an exact bound: one determinant a group stays, and at most
  two dependent values, the best and the best beside it. No group is ever larger
  than that for the task that solves it. With several dependencies the candidates
  that the first bound leaves go to one task a group;
* the candidates that are left meet in one small branch-and-bound search per
  group, for which the choices within a single record are the incumbent.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from quern.functions.dist import cut, salted_lookup

BUNDLES = (("url", "warc_date"), ("lang",))
DEPENDENCIES = (("url", "lang"),)
MILLIS_ABOVE = 10**11


def _known(field: str):
    """The field as text, null where it is empty."""
    text = F.trim(F.col(field).cast("string"))
    return F.when(text != "", text)


def normalised(records: DataFrame, fields: list[str]) -> DataFrame:
    """ts in seconds and length, 0 where unknown (null, or below 0); empty fields null."""
    ts = F.coalesce(F.col("ts").cast("long"), F.lit(0))
    ts = F.when(ts > MILLIS_ABOVE, F.floor(ts / 1000)).otherwise(F.greatest(ts, F.lit(0)))
    length = F.greatest(F.coalesce(F.col("length").cast("long"), F.lit(0)), F.lit(0))
    return records.select("doc_id", ts.alias("ts"), length.alias("length"), *[_known(f).alias(f) for f in fields])


def branch_and_bound(options: list[list[tuple[int, dict]]], allowed) -> tuple[int, list[dict]]:
    """The choice of one option for each bundle that has the largest total trust.

    ``options[b]`` has (trust, {field: value}) in falling order of trust, the last
    of them (0, {}): to leave the bundle empty. ``allowed`` judges a partial choice.
    """
    rest = [0] * (len(options) + 1)
    for b in range(len(options) - 1, -1, -1):
        rest[b] = rest[b + 1] + options[b][0][0]
    best: tuple[int, list[dict]] = (-1, [])

    def branch(b: int, total: int, chosen: list[dict]) -> None:
        nonlocal best
        if b == len(options):
            if total > best[0]:
                best = (total, chosen)
            return
        for trust, values in options[b]:
            if total + trust + rest[b + 1] <= best[0]:
                break  # options fall in trust: none of the others can do better
            if allowed({k: v for c in (*chosen, values) for k, v in c.items()}):
                branch(b + 1, total + trust, [*chosen, values])

    branch(0, 0, [])
    return best


def survivors(
    records: DataFrame,
    groups: DataFrame,
    bundles: tuple[tuple[str, ...], ...] = BUNDLES,
    dependencies: tuple[tuple[str, str], ...] = DEPENDENCIES,
) -> DataFrame:
    """(group_id, doc_id, ts, length, *fields, filled, *fields_from): one row for each group of two or more ids with a record.

    ``groups`` has (node_id, group_id). Records that are in no such group, or
    whose doc_id is null, have no row. Equal records are one candidate; between
    records that tie in (ts, length, doc_id) the one whose fields come last in
    order wins, so the result is the same in every run. ``filled`` names the
    fields that came from other records, and ``url_from`` and the like the doc_id
    of the record a field was taken from. The survivor's own values are kept; a
    field stays null only if no record of the group has it.
    """
    fields = [f for b in bundles for f in b]
    # ids and short fields only, used several times each: written once, in the shared folder
    groups = cut(groups)
    sizes = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("_ids")).where("_ids > 1").select("group_id")
    # equal records fold map-side; an id that is left with very many versions is split
    distinct = normalised(records, fields).where("doc_id is not null").distinct()
    members = cut(salted_lookup(distinct, "doc_id", groups.select(F.col("node_id").alias("doc_id"), "group_id"), "inner"))
    base = members.groupBy("group_id").agg(F.max(F.struct("ts", "length", "doc_id", *fields)).alias("_b")).join(sizes, "group_id").select("group_id", "_b.*")
    base = cut(base)

    gap = F.array(*[F.array_contains(F.array(*[F.col(f).isNull() for f in b]), True) for b in bundles])
    open_base = base.where(F.array_contains(gap, True)).select("group_id", *[F.col(f).alias(f"_b_{f}") for f in fields])
    # trust of a record: the more complete, then the more recent, the better
    trust = sum((F.col(f).isNotNull().cast("long") for f in fields), F.lit(0)) * F.lit(1 << 38) + F.least(F.col("ts"), F.lit((1 << 38) - 1))
    versions = members.withColumn("_t", trust).groupBy("group_id", *fields).agg(F.max(F.struct("_t", "doc_id")).alias("_v")).select("group_id", *fields, "_v._t", F.col("_v.doc_id").alias("_src"))
    seen = salted_lookup(versions, "group_id", open_base, "inner")

    # parts to fill: every bundle as a whole and, for groups where no record has it whole, each of its fields
    parts = [(i, b) for i, b in enumerate(bundles)] + [(i, (f,)) for i, b in enumerate(bundles) if len(b) > 1 for f in b]
    # propagate what the survivor itself fixes: dependent values must be those seen beside its
    # determinants, and a whole bundle must agree with its filled fields
    beside = {(x, y): F.col(f"_b_{x}").isNull() | (F.col(x).isNotNull() & (F.col(x) == F.col(f"_b_{x}"))) for x, y in dependencies}
    whole = {}
    for i, b in enumerate(bundles):
        agrees = F.lit(True)
        missing = F.lit(False)
        for f in b:
            agrees = agrees & F.col(f).isNotNull() & (F.col(f"_b_{f}").isNull() | (F.col(f) == F.col(f"_b_{f}")))
            missing = missing | F.col(f"_b_{f}").isNull()
        whole[i] = agrees & missing

    def bindings(b: tuple[str, ...]) -> list[int]:
        return [k for k, (_, y) in enumerate(dependencies) if y in b]

    def all_of(conditions) -> Column:
        return reduce(lambda p, q: p & q, conditions, F.lit(True))

    seen = cut(seen)
    fixed = seen.groupBy("group_id").agg(
        *[F.max(F.coalesce((F.col(x) == F.col(f"_b_{x}")) & F.col(y).isNotNull(), F.lit(False))).alias(f"_d{k}") for k, (x, y) in enumerate(dependencies)],
        *[F.max(whole[i]).alias(f"_any{i}") for i in range(len(bundles))],
        *[F.max(whole[i] & all_of(beside[dependencies[k]] for k in bindings(b))).alias(f"_bound{i}") for i, b in enumerate(bundles)],
    )
    seen = salted_lookup(seen, "group_id", fixed, "inner")
    # more filled fields count for more than agreement with the survivor, and that for more than trust
    agreement = 1 << (38 + (len(fields) + 1).bit_length())
    field = agreement << (2 * len(fields)).bit_length()
    scores = {}
    for p, (i, b) in enumerate(parts):
        tied = F.lit(False)
        for k in bindings(bundles[i]):
            tied = tied | F.col(f"_d{k}")
        has_whole = F.when(tied, F.col(f"_bound{i}")).otherwise(F.col(f"_any{i}"))
        fits = all_of(~F.col(f"_d{k}") | beside[dependencies[k]] for k in bindings(b))
        if p < len(bundles):
            gaps = sum((F.col(f"_b_{f}").isNull().cast("long") for f in b), F.lit(0))
            scores[f"_s{p}"] = F.when(has_whole & whole[i] & fits, F.col("_t") + agreement + gaps * field)
        else:
            (f,) = b
            agrees = all_of(F.coalesce(F.col(g) == F.col(f"_b_{g}"), F.lit(True)) for g in bundles[i])
            scores[f"_s{p}"] = F.when(~has_whole & F.col(f"_b_{f}").isNull() & F.col(f).isNotNull() & fits, F.col("_t") + agrees.cast("long") * agreement + field)
    seen = cut(seen.withColumns(scores))
    bound = seen.groupBy("group_id").agg(
        F.max(sum((F.coalesce(f"_s{p}", F.lit(0)) for p in range(len(parts))), F.lit(0))).alias("_single"),
        *[F.coalesce(F.max(f"_s{p}"), F.lit(0)).alias(f"_m{p}") for p in range(len(parts))],
    )
    marked = salted_lookup(seen, "group_id", bound, "inner")
    total = sum((F.col(f"_m{p}") for p in range(len(parts))), F.lit(0))
    linked = {f for d in dependencies for f in d}
    kinds = []
    for p, (_, b) in enumerate(parts):
        near = F.col(f"_s{p}") + total - F.col(f"_m{p}") >= F.col("_single")
        # candidates that no dependency tells apart have one key
        key = F.to_json(F.struct(*[f for f in b if f in linked])) if linked & set(b) else F.lit("")
        kinds.append(F.when(near, F.struct(F.lit(p).alias("part"), key.alias("key"), F.to_json(F.struct(*b)).alias("value"), F.col(f"_s{p}").alias("score"), F.col("_src").alias("src"))))
    # (determinant, dependent) pairs seen in the group; only those between candidates matter below
    for k, (x, y) in enumerate(dependencies):
        pair = F.to_json(F.struct(F.col(x).alias("x"), F.col(y).alias("y")))
        kinds.append(F.when(F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(f"_b_{x}").isNull(), F.struct(F.lit(-1 - k).alias("part"), pair.alias("key"), pair.alias("value"), F.col("_t").alias("score"), F.col("_src").alias("src"))))
    rows = marked.select("group_id", F.explode(F.filter(F.array(*kinds), lambda x: x.isNotNull())).alias("c")).groupBy("group_id", "c.part", "c.key").agg(F.max(F.struct("c.score", "c.value", "c.src")).alias("c")).select("group_id", "part", "c.*")
    rows = cut(rows)

    def having(field: str) -> list[int]:
        return [p for p, (_, b) in enumerate(parts) if field in b]

    pairs = rows.where("part < 0").withColumns({"x": F.get_json_object("value", "$.x"), "y": F.get_json_object("value", "$.y")})
    chosen = rows.where("part >= 0")
    if len(dependencies) == 1 and not set(having(dependencies[0][0])) & set(having(dependencies[0][1])):
        chosen, pairs = _bounded(chosen, pairs, dependencies[0], having)
    elif dependencies:
        det = reduce(DataFrame.unionByName, [chosen.where(F.col("part").isin(having(x))).select("group_id", F.lit(-1 - k).alias("part"), F.get_json_object("value", f"$.{x}").alias("x")) for k, (x, _) in enumerate(dependencies)])
        pairs = pairs.join(det.distinct(), ["group_id", "part", "x"], "left_semi")
    columns = ["group_id", "part", "value", "score", "src"]
    candidates = chosen.select(*columns).unionByName(pairs.select(*columns))

    def solve(group_id, rows: list[tuple[int, str, int, object]]) -> tuple:
        options: list[list[tuple[int, dict]]] = [[] for _ in parts]
        pairs: dict[tuple[str, str], dict[str, set]] = {d: {} for d in dependencies}
        sources: dict[tuple[str, str], object] = {}
        for part, value, score, src in rows:
            v = json.loads(value)
            if part >= 0:
                options[part].append((score, v))
                sources |= {item: src for item in v.items()}
            else:
                pairs[dependencies[-1 - part]].setdefault(v["x"], set()).add(v["y"])
        for o in options:
            o.sort(key=lambda x: (-x[0], sorted(x[1].items())))
            o.append((0, {}))

        def allowed(c: dict) -> bool:
            return all(x not in c or y not in c or c[y] in pairs[x, y].get(c[x], {c[y]}) for x, y in dependencies)

        _, chosen = branch_and_bound(options, allowed)
        got = {k: v for c in chosen for k, v in c.items()}
        return (group_id, *[got.get(f) for f in fields], *[sources.get((f, got.get(f))) for f in fields])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the rows of a group follow each other
        held, group, out = None, [], []
        for b in batches:
            for group_id, *row in zip(*(b.column(c).to_pylist() for c in ("group_id", "part", "value", "score", "src"))):
                if group and group_id != held:
                    out.append(solve(held, group))
                    group = []
                held = group_id
                group.append(row)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], shape)
                out = []
        if group:
            yield pa.RecordBatch.from_pylist([dict(zip(names, solve(held, group)))], shape)

    names = ["group_id", *[f"_f_{f}" for f in fields], *[f"_from_{f}" for f in fields]]
    schema = StructType([StructField("group_id", groups.schema["group_id"].dataType), *[StructField(f"_f_{f}", StringType()) for f in fields], *[StructField(f"_from_{f}", records.schema["doc_id"].dataType) for f in fields]])
    shape = to_arrow_schema(schema)
    fills = candidates.repartition("group_id").sortWithinPartitions("group_id").mapInArrow(search, schema)
    out = base.join(fills, "group_id", "left")
    filled = F.concat_ws(",", *[F.when(F.col(f).isNull() & F.col(f"_f_{f}").isNotNull(), F.lit(f)) for f in fields])
    sources = [F.when(F.col(f).isNotNull(), F.col("doc_id")).otherwise(F.col(f"_from_{f}")).alias(f"{f}_from") for f in fields]
    return out.select("group_id", "doc_id", "ts", "length", *[F.coalesce(f, f"_f_{f}").alias(f) for f in fields], filled.alias("filled"), *sources)


def _bounded(chosen: DataFrame, pairs: DataFrame, dependency: tuple[str, str], having) -> tuple[DataFrame, DataFrame]:
    """The candidates and pairs that can be in a best choice: one determinant for each group, at most two dependent values."""
    x, y = dependency
    dets = chosen.where(F.col("part").isin(having(x))).withColumn("x", F.get_json_object("value", f"$.{x}"))
    deps = chosen.where(F.col("part").isin(having(y))).withColumn("y", F.get_json_object("value", f"$.{y}"))
    rest = chosen.where(~F.col("part").isin([*having(x), *having(y)]))
    # the best dependent value beside each determinant; -1 where it has some, but no candidate
    dep = F.struct("score", "part", "value", "src", "y")
    by_pair = deps.select(F.struct("group_id", "y").alias("_key"), dep.alias("_d"))
    met = salted_lookup(pairs.select(F.struct("group_id", "y").alias("_key"), "group_id", "x", F.col("y").alias("_y")), "_key", by_pair)
    beside = met.groupBy("group_id", "x").agg(F.max("_d").alias("_best"), F.min("_y").alias("_some"))
    top = cut(deps.groupBy("group_id").agg(F.max(dep).alias("_top")))
    judged = salted_lookup(dets.join(beside, ["group_id", "x"], "left"), "group_id", top)
    with_dep = F.when(F.col("_some").isNotNull(), F.coalesce(F.col("_best.score"), F.lit(0))).otherwise(F.coalesce(F.col("_top.score"), F.lit(0)))
    best = judged.groupBy("group_id").agg(F.max(F.struct((F.col("score") + with_dep).alias("bound"), "score", "part", "value", "src", "x", "_best", "_some")).alias("_x")).select("group_id", "_x.*")
    best = cut(best)
    columns = ["group_id", "part", "value", "score", "src"]
    second = best.where("_best is not null").select("group_id", "_best.part", "_best.value", "_best.score", "_best.src")
    kept = rest.select(*columns).unionByName(best.select(*columns)).unionByName(top.select("group_id", "_top.part", "_top.value", "_top.score", "_top.src")).unionByName(second)
    # the pairs of the determinant that tell the two values apart
    one = F.to_json(F.struct("x", F.col("_y").alias("y")))
    ys = best.where("_some is not null").select("group_id", "x", F.explode(F.array_distinct(F.array("_some", F.coalesce("_best.y", "_some")))).alias("_y"))
    # the overall best value is allowed only if it is beside the determinant, and then it is the best beside it
    left = ys.select("group_id", F.lit(-1).alias("part"), one.alias("value"), F.lit(0).cast("long").alias("score"), F.lit(None).alias("src"))
    return kept.distinct(), left


def chosen_bundles(survived: DataFrame, bundles: tuple[tuple[str, ...], ...] = BUNDLES) -> DataFrame:
    """(group_id, bundle, field, value, source_doc_id): where every field of a survivor comes from; fields without a value have no row."""
    rows = [F.struct(F.lit("+".join(b)).alias("bundle"), F.lit(f).alias("field"), F.col(f).alias("value"), F.col(f"{f}_from").alias("source_doc_id")) for b in bundles for f in b]
    return survived.select("group_id", F.explode(F.array(*rows)).alias("r")).select("group_id", "r.*").where("value is not null")
