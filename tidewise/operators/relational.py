"""Dedup, set, range and ranking operators (survey D1-D9, J1-J19, W21, F11, F17, T1-T17, A25)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewise.session import cut_lineage


def first_wins(df: DataFrame, key: Column, *order) -> DataFrame:
    """The first row of each key; rows whose key is null go."""
    w = Window.partitionBy("_key").orderBy(*order)
    return df.withColumn("_key", key).where("_key is not null").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_key", "_n")


def last_wins(df: DataFrame, key: str, position: str) -> DataFrame:
    """Each key's last row, at the place of its first: columns of df and first_position."""
    values = [c for c in df.columns if c != key]
    got = df.groupBy(key).agg(F.max_by(F.struct(*values), position).alias("_row"), F.min(position).alias("first_position"))
    return got.select(key, "_row.*", "first_position")


def coalesce_ranges(df: DataFrame, keys: list[str], start: str, end: str, gap_days: int = 1, count: str | None = None) -> DataFrame:
    """Ranges that overlap or are at most `gap_days` apart become one."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = reach.isNull() | (F.col(start) > F.date_add(reach, gap_days))
    island = F.sum(F.when(F.col("_fresh"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = df.withColumn("_fresh", fresh).withColumn("_island", island)
    total = F.sum(count) if count else F.count("*")
    return marked.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end), total.cast("long").alias("n")).drop("_island")


def until_first(df: DataFrame, keys: list[str], order: list, stop: Column) -> DataFrame:
    """Rows before the first that stops (an early-terminating ordered scan)."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_stop", F.max(stop.cast("int")).over(w)).where("_stop = 0").drop("_stop")


def _dealt(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """df in ranges of (keys, order), _p the range of a row; checkpointed, so that all who read it see the same ranges."""
    return cut_lineage(df.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("_p", F.spark_partition_id()))


def running(df: DataFrame, keys: list[str], order: list, amount: Column, name: str) -> DataFrame:
    """Adds the running sum of amount within each key, in an order without ties; no key, nor the whole, meets in one task.

    Sums run inside ranges of the order; what earlier ranges hold of a key comes from one row for each range and key."""
    dealt = _dealt(df.withColumn("_a", amount), keys, order)
    inside = F.sum("_a").over(Window.partitionBy("_p", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    totals = dealt.groupBy("_p", *keys).agg(F.sum("_a").alias("_t"))
    before = totals.select("_p", *keys, (F.sum("_t").over(Window.partitionBy(*keys).orderBy("_p")) - F.col("_t")).alias("_before"))
    return dealt.withColumn("_in", inside).join(before, ["_p", *keys]).withColumn(name, F.col("_in") + F.col("_before")).drop("_p", "_a", "_in", "_before")


def lagged(df: DataFrame, keys: list[str], order: list, column: str, name: str) -> DataFrame:
    """Adds the value of the row before in each key's order, across the ranges in which the rows are dealt."""
    dealt = _dealt(df, keys, order)
    w = Window.partitionBy("_p", *keys).orderBy(*order)
    last = dealt.withColumn("_back", F.row_number().over(Window.partitionBy("_p", *keys).orderBy(*[_reversed(o) for o in order]))).where("_back = 1").select("_p", *keys, F.struct(F.col(column).alias("x")).alias("_last"))
    edge = last.select("_p", *keys, F.lag("_last").over(Window.partitionBy(*keys).orderBy("_p")).alias("_edge"))
    rows = dealt.withColumn("_lag", F.lag(F.struct(F.col(column).alias("x"))).over(w)).join(edge, ["_p", *keys])
    return rows.withColumn(name, F.coalesce("_lag", "_edge")["x"]).drop("_p", "_lag", "_edge")


def _reversed(column: str) -> Column:
    return F.desc(column)


def in_stretches(df: DataFrame, place: Column, width: int, reach: int) -> DataFrame:
    """Adds _stretch, the part of width `width` in which place (a whole number) lies, and repeats the rows in the last `reach` of each
    as context (_own false) of the next, so that windows which look back that far can be partitioned by stretch."""
    own = F.floor(place / width).cast("long")
    both = F.when(F.floor((place + reach) / width) > own, F.array(own, own + 1)).otherwise(F.array(own))
    return df.withColumn("_mine", own).withColumn("_stretch", F.explode(both)).withColumn("_own", F.col("_stretch") == F.col("_mine")).drop("_mine")


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value, upto (how many are not above it) and n (how many there are): counts of distinct values, pre-aggregated and summed over ranges."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    upto = running(counts, keys, [value], F.col("_c"), "upto")
    total = upto.groupBy(*keys).agg(F.max("upto").alias("n"))
    return (upto.join(total, keys) if keys else upto.join(F.broadcast(total))).drop("_c")  # without keys the total is one row


def nearest_ranks(df: DataFrame, keys: list[str], value: str, shares: dict[str, float], top: bool = False) -> DataFrame:
    """sorted[floor(n * share)] of each key for each named share (with `top`, at most the last index)."""
    upto = value_counts(df, keys, value)
    want = {n: F.floor(F.col("n") * F.lit(s)) for n, s in shares.items()}
    want = {n: F.least(w, F.col("n") - 1) for n, w in want.items()} if top else want
    return upto.groupBy(*keys).agg(*[F.min(F.when(F.col("upto") > w, F.col(value))).alias(n) for n, w in want.items()])


def nearest_rank(df: DataFrame, keys: list[str], value: str, share: float, name: str, top: bool = False) -> DataFrame:
    return nearest_ranks(df, keys, value, {name: share}, top)


def percentiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Linearly interpolated percentiles of each key, exact whatever the number of values: no buffer holds them."""
    upto, found = value_counts(df, keys, value), []
    for name, share in shares.items():
        at = (F.col("n") - 1) * F.lit(share)
        found += [F.min(F.when(F.col("upto") > F.floor(at), F.col(value))).alias(f"_{name}_lo"), F.min(F.when(F.col("upto") > F.ceil(at), F.col(value))).alias(f"_{name}_hi"), F.max(at - F.floor(at)).alias(f"_{name}_part")]
    got = upto.groupBy(*keys).agg(*found)
    return got.select(*keys, *[(F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_part")).alias(n) for n in shares])


def top_within(df: DataFrame, keys: list[str], n: int, *order) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


def prefix_budget(df: DataFrame, keys: list[str], size: Column, budget: int, order: list) -> DataFrame:
    """Rows in order until the running size would pass the budget; adds running_size."""
    return running(df, keys, order, size, "running_size").where(F.col("running_size") <= budget)


def stratified(df: DataFrame, key: str, strata: list[tuple[str, str, int]]) -> DataFrame:
    """Successive quotas (reason, column to rank by, count): each takes the best of what is left.

    A quota's rank threshold is found by top-n sorts of (column, key) alone, each bounded by the quotas, so no
    window over the whole table is needed."""
    left, out = df, None
    for reason, column, n in strata:
        picked = left.orderBy(F.desc(column), key).limit(n).select(key)
        part = df.join(F.broadcast(picked), key, "left_semi").withColumn("reason", F.lit(reason))  # at most n keys
        out = part if out is None else out.unionByName(part)
        left = left.join(F.broadcast(picked), key, "left_anti")
    return out


def compare_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """One row: how many keys are in both, only old, only new, and whether all old ones are still there."""
    a, b = old.select(key).distinct().withColumn("_a", F.lit(1)), new.select(key).distinct().withColumn("_b", F.lit(1))
    both = a.join(b, key, "full_outer")
    return both.agg(F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("common"), F.count_if(F.col("_b").isNull()).alias("only_old"), F.count_if(F.col("_a").isNull()).alias("only_new")).withColumn("is_superset", F.col("only_old") == 0)


def similar_names(left: DataFrame, right: DataFrame, most: int = 2) -> DataFrame:
    """Pairs of names (l, r) within `most` edits, case ignored.

    Exact by pigeonhole: of most + 1 pieces of a name at least one survives that many edits, and it moves by at most `most`
    places; so pairs meet in an equi-join on (length band, piece, place) and are then judged by their distance."""
    parts = most + 1

    def cut(df: DataFrame, name: str, shifts: bool) -> DataFrame:
        low = df.select(F.col(name).alias("name")).distinct().withColumn("low", F.lower("name"))
        if not shifts:
            n = F.length("low")
            cuts = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.struct(F.floor(n * i / parts).cast("int").alias("at"), (F.floor(n * (i + 1) / parts) - F.floor(n * i / parts)).cast("int").alias("len"), i.alias("part"), n.alias("of")))
            return low.withColumn("c", F.explode(cuts)).select("name", "low", F.col("c.part").alias("part"), F.col("c.of").alias("of"), F.col("c.at").alias("at"), F.expr("substring(low, c.at + 1, c.len)").alias("piece"))
        sizes = low.withColumn("of", F.explode(F.sequence(F.length("low") - most, F.length("low") + most))).where("of >= 0")
        cuts = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.struct(F.floor(F.col("of") * i / parts).cast("int").alias("at"), (F.floor(F.col("of") * (i + 1) / parts) - F.floor(F.col("of") * i / parts)).cast("int").alias("len"), i.alias("part")))
        moved = sizes.withColumn("c", F.explode(cuts)).withColumn("shift", F.explode(F.sequence(F.lit(-most), F.lit(most)))).where("c.at + shift >= 0 and c.at + shift + c.len <= length(low)")
        return moved.select("name", "low", F.col("c.part").alias("part"), "of", F.col("c.at").alias("at"), F.expr("substring(low, c.at + shift + 1, c.len)").alias("piece")).distinct()

    a, b = cut(left, left.columns[0], False).alias("a"), cut(right, right.columns[0], True).alias("b")
    met = a.join(b, ["part", "of", "at", "piece"]).select(F.col("a.name").alias("l"), F.col("b.name").alias("r"), F.col("a.low").alias("x"), F.col("b.low").alias("y")).distinct()
    return met.withColumn("distance", F.levenshtein("x", "y")).where(F.col("distance") <= most).select("l", "r", "distance")


def shuffled_mapping(users: DataFrame, names: DataFrame, seed: int) -> DataFrame:
    """user, name: the users in order get the names in the order of a seeded hash, so that their own order cannot be read from them (survey T17).

    Both sides are one column of distinct values, numbered over ranges; fewer names than users is an error."""
    people, pool = users.select(F.col(users.columns[0]).alias("user")).distinct(), names.select(F.col(names.columns[0]).alias("name")).distinct()
    need, have = people.count(), pool.count()
    if have < need:
        raise ValueError(f"{need} users need as many names, there are {have}")
    drawn = pool.withColumn("_draw", F.md5(F.concat(F.col("name").cast("string"), F.lit(f"/{seed}")).cast("binary")))
    return running(people, [], ["user"], F.lit(1), "_place").join(running(drawn, [], ["_draw", "name"], F.lit(1), "_place").select("_place", "name"), "_place").select("user", "name")
