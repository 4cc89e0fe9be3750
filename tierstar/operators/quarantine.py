"""Rows that break rules, with the rules they break: set apart, kept, and offered to the next run again.

Row rules are seen in the row itself. Key rules (unique, found among parents) need all rows: each counts its own key columns,
combined before the shuffle, and leaves the keys that are broken. A last pass tags rows by these. Whole rows move once for each unique rule:
a reference whose column is part of a unique key is looked up for the keys, which are narrow, and travels with them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstar.operators.aggregates import union_all
from tierstar.operators.quality import Reference, Rule, Unique

BROKEN = "broken"
#: Types whose values are equal exactly if their texts are; others are compared as text.
PLAIN = (T.IntegralType, T.DecimalType, T.StringType, T.BooleanType, T.DateType)


def _plain(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, PLAIN)


def _key(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns of a key, as text where equality is that of text."""
    text = (lambda c: F.col(c).cast("string")) if len(columns) == 1 else (lambda c: F.to_json(F.struct(c), {"ignoreNullFields": "false"}))
    return [F.col(c) if _plain(df, c) else text(c) for c in columns]


def _form(df: DataFrame, r: Reference, parent: DataFrame) -> Callable[[Column], Column]:
    """How a reference's keys and those of its parents are compared: as they are if both have one plain type, else as text."""
    alike = _plain(df, r.key) and df.schema[r.key].dataType == parent.schema[r.parent_key].dataType
    return (lambda c: c) if alike else (lambda c: c.cast("string"))


def lost_keys(df: DataFrame, r: Reference, parent: DataFrame) -> DataFrame:
    """``key``: what the reference's rows name and its parents lack. A NULL shows in the row and is not among them."""
    form = _form(df, r, parent)
    held = [(df, r.key, False), (parent, r.parent_key, True)]
    named = [t.filter(F.col(c).isNotNull()).select(form(F.col(c)).alias("key"), F.lit(there).alias("there")) for t, c, there in held]
    return union_all(named).groupBy("key").agg(F.bool_or("there").alias("there")).filter(~F.col("there")).select("key")


def broken_keys(df: DataFrame, uniques: Sequence[Unique], references: Sequence[Reference], parents: Mapping[str, DataFrame]) -> tuple[list[list[Column]], DataFrame | None]:
    """The keys to look rows up by, and one table of the broken ones: lookup (number of the key), key_0, key_1, ..., codes.

    One lookup for each unique rule, with references whose column is one of its own, and one for every other reference.
    """
    lookups, tables, open_references = [], [], list(references)
    for u in uniques:
        names, columns = [f"k{j}" for j in range(len(u.keys))], _key(df, u.keys)
        counts = df.groupBy(*[c.alias(n) for c, n in zip(columns, names)]).agg(F.count(F.lit(1)).alias("rows"))
        found = counts.select(*names, F.array_compact(F.array(F.when(F.col("rows") > 1, F.lit(u.code)))).alias("codes"))
        # Each doubles the plan, so two at most; others are looked up by themselves.
        folded = [r for r in open_references if r.key in u.keys and _plain(df, r.key)][:2]
        for r in folded:
            open_references.remove(r)
            form = _form(df, r, parents[r.parent])
            place = form(F.col(names[list(u.keys).index(r.key)]))
            known = parents[r.parent].select(form(F.col(r.parent_key)).alias("parent"))
            # Keys that parents lack and keys that they have, apart: such joins ask for no distinct parents, so a frequent key can be split over tasks.
            # Null-safe, so that no test of NULL is pushed down on one side only and both share one count of the keys.
            there = place.eqNullSafe(F.col("parent"))
            lost = found.join(known, there, "left_anti")
            lost = lost.withColumn("codes", F.concat("codes", F.array_compact(F.array(F.when(place.isNotNull(), F.lit(r.code))))))
            kept = found.filter(F.size("codes") > 0) if r is folded[-1] else found
            found = lost.unionByName(kept.join(known, there, "left_semi"))
        lookups.append(columns)
        tables.append(found.filter(F.size("codes") > 0).select(F.struct(*names).alias("key"), "codes"))
    for r in open_references:
        lookups.append([_form(df, r, parents[r.parent])(F.col(r.key))])
        tables.append(lost_keys(df, r, parents[r.parent]).select(F.struct(F.col("key").alias("k0")).alias("key"), F.array(F.lit(r.code)).alias("codes")))
    numbered = [t.select(F.lit(i).alias("lookup"), F.col("key").alias(f"key_{i}"), "codes") for i, t in enumerate(tables)]
    return lookups, reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered) if numbered else None


def tag(df: DataFrame, rules: Sequence[Rule], uniques: Sequence[Unique] = (), references: Sequence[Reference] = (), parents: Mapping[str, DataFrame] | None = None, keep: Callable[[DataFrame], DataFrame] = lambda keys: keys) -> DataFrame:
    """``df`` with ``broken``: the codes of the rules that a row breaks, in order.

    ``keep`` stores the broken keys, which are joined once per lookup; without it they are computed for each join.
    """
    codes = [F.when(F.coalesce(r.bad, F.lit(False)), F.lit(r.code)) for r in rules]
    codes += [F.when(F.col(r.key).isNull(), F.lit(r.code)) for r in references if not r.null_passes]
    out, found = df, [F.array(*codes).cast("array<int>")]
    lookups, bad = broken_keys(df, uniques, references, parents or {})
    if bad is not None:
        bad = keep(bad)
        for i, columns in enumerate(lookups):
            names = [f"_bad_{i}_{j}" for j in range(len(columns))]
            one = bad.filter(F.col("lookup") == i).select(*[F.col(f"key_{i}.k{j}").alias(n) for j, n in enumerate(names)], F.col("codes").alias(f"_codes_{i}"))
            same = reduce(lambda a, b: a & b, [c.eqNullSafe(F.col(n)) for c, n in zip(columns, names)])
            out = out.join(one, same, "left").drop(*names)
            found.append(F.coalesce(F.col(f"_codes_{i}"), F.array().cast("array<int>")))
    return out.withColumn(BROKEN, F.array_sort(F.array_compact(F.concat(*found)))).select(*df.columns, BROKEN)


def part(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, without the tag, and failing rows with it."""
    clean = F.size(BROKEN) == 0
    return tagged.filter(clean).drop(BROKEN), tagged.filter(~clean)


def offer(fresh: DataFrame, quarantine: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Fresh rows, and quarantined ones once more unless a fresh row of their key takes their place."""
    if quarantine is None:
        return fresh
    arrived = fresh.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return union_all([fresh, quarantine.drop(BROKEN).select(*fresh.columns).join(arrived, same, "left_anti")])
