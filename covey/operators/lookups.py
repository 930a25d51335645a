"""Point lookups in frequency tables: fallback to coarser cells, neighbours, regions, names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..storage import stored


def with_fallback(points: DataFrame, rows: DataFrame, levels: list[tuple[int, str]], keys: list[str], point: str, least: Column | None = None) -> DataFrame:
    """Each point's first row, from the first of levels (resolution, the point's column with its cell) on, that rows have.

    rows: (resolution, cell, keys..., others). least: a condition a row must meet to be taken. Points without
    any row have nulls. A point's candidates are few, so its best one is found by an aggregation."""
    tried = F.array(*(F.struct(F.lit(k).alias("rank"), F.lit(r).alias("resolution"), F.col(c).alias("cell")) for k, (r, c) in enumerate(levels)))
    flat = points.select(point, *keys, F.explode(tried).alias("_t")).select(point, *keys, "_t.*")
    others = [c for c in rows.columns if c not in ("resolution", "cell", *keys)]
    kept = rows if least is None else rows.where(least)
    found = flat.join(kept, ["resolution", "cell", *keys])
    best = found.groupBy(point).agg(F.min_by(F.struct("resolution", "cell", *others), "rank").alias("_best"))
    return points.join(best, point, "left").select(*points.columns, "_best.*")


def existing(points: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    return points.join(rows, on, "left_semi")


def weighted_neighbours(rows: DataFrame, pairs: DataFrame, keys: list[str], cell: str = "cell", neighbour: str = "neighbour", distance: str = "distance") -> DataFrame:
    """Frequencies averaged over a cell's neighbours, weighed by 1 / (1 + distance), with the best tier's rank among them."""
    met = pairs.join(rows.withColumnRenamed(cell, neighbour), neighbour)
    weight = 1 / (1 + F.col(distance))
    return met.groupBy(cell, *keys).agg((F.sum(F.col("frequency") * weight) / F.sum(weight)).alias("weighted_frequency"), F.count(F.lit(1)).alias("neighbours"), F.min("tier_rank").alias("best_rank"))


def last_wins(mapping: DataFrame, key: Column, ordinal: str, value: str) -> DataFrame:
    """(key, value) with the value of the last row of each key."""
    return mapping.groupBy(key.alias("key")).agg(F.max_by(value, ordinal).alias(value))


def first_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by an order that is total."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def by_priority(parts: list[DataFrame], keys: list[str], value: str) -> DataFrame:
    """For each key the value of the first part that has one."""
    union = None
    for k, part in enumerate(parts):
        one = part.select(*keys, value).where(F.col(value).isNotNull()).withColumn("priority", F.lit(k))
        union = one if union is None else union.unionByName(one)
    return union.groupBy(*keys).agg(F.min_by(value, F.struct("priority", value)).alias(value), F.min("priority").alias("priority"))


def filter_mode(base: DataFrame, given: DataFrame, on: str, mode: str) -> DataFrame:
    """supplement: both; replace: the given ones; strict: those in both."""
    a, b = base.select(on), given.select(on)
    if mode == "supplement":
        return a.union(b).distinct()
    return {"replace": b.distinct(), "strict": a.intersect(b)}[mode]


#: So many rules are tried one by one against each row; more are met by joins on what they name.
MAX_RULES = 200


def by_rules(df: DataFrame, include: DataFrame, exclude: DataFrame, on: list[str], most: int = MAX_RULES) -> DataFrame:
    """Rows that match a rule of include and none of exclude; rules have values of some of the columns in on, null for any.

    A table of up to most rules, which is counted, goes to each task. A larger one is met by equi-joins, one
    for each set of columns that rules may name, which are two to the power of a few columns."""

    def meets(rules: DataFrame, how: str, left: DataFrame) -> DataFrame:
        renamed = rules.select(*(F.col(c).alias(f"_r_{c}") for c in on)).distinct()
        if rules.limit(most + 1).count() <= most:
            match = reduce(lambda x, y: x & y, (F.col(f"_r_{c}").isNull() | (F.col(c) == F.col(f"_r_{c}")) for c in on))
            return left.join(F.broadcast(renamed), match, how)
        columns = left.columns
        out = left.withColumn("_met", F.lit(False))
        for k in range(1 << len(on)):
            named = [c for j, c in enumerate(on) if k >> j & 1]
            which = reduce(lambda x, y: x & y, (F.col(f"_r_{c}").isNotNull() if c in named else F.col(f"_r_{c}").isNull() for c in on))
            some = renamed.where(which).select(*(F.col(f"_r_{c}").alias(f"_m_{c}") for c in named), F.lit(True).alias("_hit"))
            on_these = reduce(lambda x, y: x & y, (F.col(c) == F.col(f"_m_{c}") for c in named), F.lit(True))
            out = out.join(some, on_these, "left").withColumn("_met", F.col("_met") | F.col("_hit").isNotNull()).select(*columns, "_met")
        return out.where("_met" if how == "left_semi" else "NOT _met").select(*columns)

    return meets(exclude, "left_anti", meets(include, "left_semi", df))


def insert_or_ignore(rows: list[dict], unique: list[tuple[str, ...]]) -> list[dict]:
    """Rows in order, without those that repeat any unique key of a row kept before; null keys never clash.

    A row that is ignored doesn't block later ones. For rows at hand; inserted() does so for a table."""
    seen: list[set] = [set() for _ in unique]
    out = []
    for row in rows:
        keys = [tuple(row[c] for c in u) for u in unique]
        if not any(None not in k and k in s for k, s in zip(keys, seen, strict=True)):
            out.append(row)
            for k, s in zip(keys, seen, strict=True):
                s.add(k)
    return out


def inserted(df: DataFrame, order: Column, unique: list[tuple[str, ...]]) -> DataFrame:
    """What insert_or_ignore keeps of a table's rows, by a total order, in rounds.

    In each round a row is kept if no undecided row before it shares a key with it, and a row that shares one
    with a kept row before it is ignored; the first undecided row is always kept, so the rounds end. Random
    orders take about as many rounds as the logarithm of the rows."""
    rows = stored(df.withColumn("_order", order), "insert-rows")
    entries = F.array(*(F.struct(F.lit(k).alias("which"), F.to_json(F.array(*(F.col(c).cast("string") for c in u))).alias("value")) for k, u in enumerate(unique)))
    known = [reduce(lambda x, y: x & y, (F.col(c).isNotNull() for c in u)) for u in unique]
    keys = F.filter(F.transform(F.arrays_zip(entries.alias("e"), F.array(*known).alias("k")), lambda x: F.when(x["k"], x["e"])), lambda x: x.isNotNull())
    open_ = stored(rows.select("_order", F.explode_outer(keys).alias("key")), "insert-keys")
    kept = []
    while True:
        least = open_.where("key IS NOT NULL").groupBy("key").agg(F.min("_order").alias("_least"))
        judged = open_.join(least, "key", "left").groupBy("_order").agg(F.min(F.coalesce(F.col("_order") == F.col("_least"), F.lit(True))).alias("_first"))
        judged = stored(judged.where("_first").select("_order"), "insert-kept")
        kept.append(judged)
        taken = open_.join(judged, "_order", "left_semi").where("key IS NOT NULL").select("key").distinct()
        gone = open_.join(taken, "key", "left_semi").select("_order").distinct().unionByName(judged).distinct()
        open_ = stored(open_.join(gone, "_order", "left_anti"), "insert-keys")
        if not open_.limit(1).count():
            break
    return rows.join(reduce(DataFrame.unionByName, kept), "_order", "left_semi").select(*df.columns)


def by_release(regions: DataFrame, asked: DataFrame, order: str = "place") -> DataFrame:
    """For each release asked for, the first of its regions, null where it has none.

    regions: (region_id, release_name, order); asked: (release_name)."""
    first = regions.groupBy("release_name").agg(F.min_by("region_id", order).alias("region_id"))
    return asked.select("release_name").distinct().join(first, "release_name", "left")
