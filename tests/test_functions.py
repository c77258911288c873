"""Column builders and models on small tables, and the properties they must keep."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewise.functions import fallback, models, temporal
from tidewise.operators import relational, sequences, trees


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_timestamps(spark):
    rows = spark.createDataFrame([("2025-11-19T03:41:46.674574",), ("2025-11-19T03:41:46Z",), ("scrape_20251119_034146.json",), ("no time",), (None,)], "t string")
    got = [r.x for r in rows.select(F.date_format(temporal.parse_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("x")).collect()]
    assert got == ["2025-11-19 03:41:46"] * 3 + [None, None]


@pytest.mark.parametrize(("days", "tag", "weight"), [(0, "BREAKING", 1.0), (1, "EMERGING", 0.6), (2, "EMERGING", 0.3), (7, "SUSTAINED", 0.1), (30, "RESURGENT", 0.1)])
def test_tags(spark, days, tag, weight):
    assert one(spark, temporal.temporal_tag(F.lit(days))) == tag
    assert one(spark, temporal.temporal_weight(F.lit(days * 24))) == weight


def test_ages_floor(spark):
    end, ts = F.lit("2025-01-10").cast("timestamp"), F.lit("2025-01-10 00:00:01").cast("timestamp")
    assert one(spark, temporal.days_ago(ts, end)) == -1
    assert one(spark, temporal.months_apart(F.lit("2025-03-01").cast("date"), F.lit("2024-12-31").cast("date"))) == 4
    assert one(spark, temporal.minutes_seconds(F.lit(125.9))) == "2m 5s"


def test_fallbacks(spark):
    assert one(spark, fallback.first_truthy(F.lit(None).cast("string"), F.lit(""), F.lit("x"))) == "x"
    assert one(spark, fallback.prefixed(F.lit("tree"), "t1_")) == "t1_tree"
    assert one(spark, fallback.prefixed(F.lit("t3_a"), "t1_")) == "t3_a"
    assert one(spark, fallback.unprefixed(F.lit("t1_ab"))) == "ab"
    assert one(spark, fallback.base_identifier(F.lit("http://x/abs/2401.01234v12"))) == "2401.01234"
    assert one(spark, fallback.version_of(F.lit("2401.01234v12"))) == 12
    assert one(spark, fallback.as_flag(F.lit(" Yes "))) is True
    assert one(spark, fallback.is_withdrawn(F.lit("Retracted by the journal"), F.lit(None).cast("string"))) is True
    assert one(spark, fallback.is_removed(F.lit("[removed] by x"), F.lit("a"))) is True
    assert one(spark, fallback.flattened(F.lit("a\r\nb\n\nc"), 4)) == "a b "


def test_golden_numbers(spark):
    assert one(spark, models.interval_hours(F.lit(1.0))) == pytest.approx(0.008)
    assert one(spark, models.interval_hours(F.lit(0.0))) == pytest.approx(0.008 * (1 + 3 * math.log(2)))
    assert one(spark, models.sigmoid_coverage(F.lit(10), 0.3, 10.0)) == pytest.approx(0.5)
    assert [one(spark, models.budget_ratio(F.lit(x))) for x in (5, 55, 200)] == pytest.approx([0.1, 0.55, 1.0])
    assert [one(spark, models.retry_seconds(F.lit(x))) for x in (0, 2, 9)] == [30, 120, 240]
    assert one(spark, models.delta_info(F.lit(2), F.lit(1), F.lit(5), F.lit(1))) == pytest.approx(3.6)


@settings(max_examples=15, deadline=None)
@given(st.floats(0, 1), st.floats(0, 1))
def test_hotter_is_sooner(spark, a, b):
    low, high = sorted((a, b))
    assert one(spark, models.interval_hours(F.lit(high))) <= one(spark, models.interval_hours(F.lit(low))) + 1e-12


def test_decisions(spark):
    def decide(depth, age, karma, parent, score):
        return tuple(one(spark, models.explore_decision(F.lit(depth), F.lit(age), F.lit(karma), F.lit(0), F.lit(parent).cast("int"), F.lit(score), 2, 24.0, 1000, 365, 1)))

    assert decide(1, 99.0, 0, 0, 0) == (True, True)
    assert decide(3, 1.0, 0, 0, 0) == (True, True)
    assert decide(3, 99.0, 5000, 0, 0) == (True, False)
    assert decide(3, 99.0, 0, 1, 1) == (False, False)
    assert decide(3, 99.0, 0, None, 1) == (True, False)


def test_streak_and_changes(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([0, 0, 1, 0, 0, 0])] + [("b", 0, 1), ("c", 0, None), ("c", 1, None)], "k string, i int, v int")
    got = {(r.k, r.i): r.s for r in sequences.streak(df, ["k"], ["i"], F.col("v") == 0, "s").where("k <> 'c'").collect()}
    assert [got["a", i] for i in range(6)] == [1, 2, 0, 1, 2, 3] and got["b", 0] == 0
    assert sorted((r.k, r.i) for r in sequences.changes(df, ["k"], ["i"], "v").collect()) == [("a", 0), ("a", 2), ("a", 3), ("b", 0), ("c", 0)]


def test_replaying_a_snapshot_adds_nothing(spark):
    df = spark.createDataFrame([("a", 0, "x"), ("a", 1, "x"), ("a", 2, "y")], "k string, i int, v string")
    once = sequences.changes(df, ["k"], ["i"], "v")
    assert sequences.changes(once, ["k"], ["i"], "v").count() == once.count() == 2


def test_similar_names_equal_brute_force(spark):
    names = ["", "a", "ab", "Openai", "open ai", "opnai", "Anthill", "anthil", "ant hall", "gpt", "gtp", "g", "xyzw", "wxyz", "abcdefgh", "bacdefgh", "abcdefg", "zabcdefg"]
    left, right = names[:9] + names[12:], names[5:]

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    want = {(a, b, edits(a.lower(), b.lower())) for a in left for b in right if edits(a.lower(), b.lower()) <= 2}
    mk = lambda v: spark.createDataFrame([(x,) for x in v], "name string")
    assert {tuple(r) for r in relational.similar_names(mk(left), mk(right)).collect()} == want


def test_nearest_rank_and_until_first(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 5), ("b", None)], "k string, v int")
    assert {r.k: r.p for r in relational.nearest_rank(df, ["k"], "v", 0.95, "p").collect()}["a"] == 9
    assert [r.v for r in relational.until_first(df.where("k = 'a'"), ["k"], ["v"], F.col("v") == 4).orderBy("v").collect()] == [0, 1, 2, 3]


def tree(spark):
    rows = [("t", 1, None, "u"), ("t", 2, 1, "v"), ("t", 3, 1, "w"), ("t", 4, 2, "u"), ("t", 5, 4, "v"), ("t", 6, 99, "x"), ("s", 1, None, "u"), ("c", 1, 2, "a"), ("c", 2, 1, "b")]
    return spark.createDataFrame(rows, "thread string, node long, parent long, author string")


def test_closure_depths_and_duality(spark):
    reach = {(r.thread, r.node, r.ancestor): r.distance for r in trees.closure(tree(spark).where("thread <> 'c'")).collect()}
    assert reach["t", 5, 1] == 3 and reach["t", 5, 5] == 0 and ("t", 6, 99) not in reach and len(reach) == 1 + 6 + 1 + 1 + 2 + 3
    counts = {(r.thread, r.node): r.descendants for r in trees.descendant_counts(tree(spark).where("thread <> 'c'")).collect()}
    assert counts["t", 1] == 4 and counts["t", 5] == 0 and sum(counts.values()) == sum(1 for d in reach.values() if d)
    assert {tuple(r) for r in trees.closure(tree(spark)).where("thread = 'c' and distance > 0").select("node", "ancestor", "distance").collect()} == {(1, 2, 1), (2, 1, 1)}  # a cycle ends
    cyclic = {(r.thread, r.node): r.depth for r in trees.rooted(tree(spark)).collect()}
    assert cyclic["c", 1] is None and cyclic["t", 5] == 3 and cyclic["t", 6] == 0


def test_trees_of_any_depth(spark):
    n = 150
    chain = spark.createDataFrame([("t", i, i - 1 if i else None, "u") for i in range(n)], "thread string, node long, parent long, author string")
    reach = trees.closure(chain)
    assert reach.agg(F.max("distance")).first()[0] == n - 1 and reach.count() == n * (n + 1) // 2
    assert {(r.node, r.depth, r.descendants) for r in trees.rooted(chain).collect()} == {(i, i, n - 1 - i) for i in range(n)}
    assert trees.rooted(chain.where("false")).count() == trees.closure(chain.where("false")).count() == 0


def test_single_tree(spark):
    rows = [("t", 1, 50), ("t", 2, 1), ("t", 3, 2), ("t", 7, None), ("t", 8, 7), ("c", 1, 2), ("c", 2, 1), ("s", 4, 4)]
    got = {(r.thread, r.node): (r.parent, r.is_root) for r in trees.single_tree(spark.createDataFrame(rows, "thread string, node long, parent long")).collect()}
    assert got == {("t", 1): (None, True), ("t", 2): (1, False), ("t", 3): (2, False), ("t", 7): (1, False), ("t", 8): (7, False), ("c", 1): (None, True), ("c", 2): (1, False), ("s", 4): (None, True)}


def test_running_sums_lags_and_stretches_across_ranges(spark):
    rows = [(k, i, (i * 7) % 11) for k, n in (("a", 300), ("b", 3), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = {(r.k, r.i): (r.total, r.v) for r in relational.running(df, ["k"], ["i"], F.col("v"), "total").collect()}
    before = {(r.k, r.i): r.was for r in relational.lagged(df, ["k"], ["i"], "v", "was").collect()}
    means = {(r.k, r.i): r.m for r in sequences.mean_of_last(df, ["k"], ["i"], "v", 4, "m", stretch=10).collect()}
    used = {(r.k, r.i): r.used for r in sequences.requests_in_window(df, ["k"], "i", 6, "used", stretch=8).collect()}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for k in "abc":
        values = [v for x, _, v in rows if x == k]
        for i in range(len(values)):
            assert got[k, i] == (sum(values[: i + 1]), values[i]) and before[k, i] == (values[i - 1] if i else None)
            last = values[max(0, i - 4) : i]
            assert means[k, i] == (sum(last) / len(last) if last else None) and used[k, i] == min(i, 6) + 1
    assert len(got) == len(before) == len(means) == len(used) == len(rows)


def test_percentiles_equal_the_built_in(spark):
    df = spark.createDataFrame([("a", float(i * i % 37)) for i in range(100)] + [("b", 2.0), ("b", None), ("c", None)], "k string, v double")
    got = {r.k: (r.p, r.q) for r in relational.percentiles(df, ["k"], "v", {"p": 0.5, "q": 0.83}).collect()}
    want = {r.k: (r.p, r.q) for r in df.where("v is not null").groupBy("k").agg(F.percentile("v", 0.5).alias("p"), F.percentile("v", 0.83).alias("q")).collect()}
    assert got.keys() == want.keys() and all(abs(x - y) < 1e-9 for k in got for x, y in zip(got[k], want[k], strict=True))


def test_backoff_fold(spark):
    steps = spark.createDataFrame([([(i, r) for i, r in enumerate([True] * 9 + [False] * 3 + [True])],)], "steps array<struct<i: int, refused: boolean>>")
    assert tuple(steps.select(sequences.fold_backoff(F.col("steps")).alias("f")).select("f.*").first()) == (64.0, 256.0)


def test_subtree_prune_attach(spark):
    nodes = tree(spark).where("thread = 't'")
    assert {r.node for r in trees.subtree_of(nodes, F.col("author") == "w").collect()} == {1, 3}
    assert {r.node for r in trees.subtree_of(nodes, F.col("node") == 2).collect()} == {1, 2, 4, 5}
    kept = trees.pruned(nodes.where("node <> 6"), F.col("author") == "u", F.lit(False), F.lit(False))
    assert {r.node for r in kept.collect()} == {1, 2, 4}
    assert {r.node for r in trees.orphans(nodes).collect()} == {6}
    placed = {r.node: r.placement for r in trees.attach(nodes, nodes.where("node in (1, 2)")).collect()}
    assert placed == {1: "replace", 2: "replace", 3: "child", 4: "child", 5: "root", 6: "root"}


def test_simulation_repeats(spark):
    from tidewise.plans.simulation import simulate

    a, b = (sorted(map(tuple, simulate(spark, 4, posts=10, hours=6, budget=3).collect())) for _ in range(2))
    assert a == b and len(a) == 4 and all(0 <= waste <= 1 for _, _, waste in a)


def test_nested_threads(spark):
    import json

    from tidewise.operators import threads

    deep = {"id": "d0"}
    for i in range(1, 400):
        deep = {"id": f"d{i}", "replies": [deep]}
    rows = [("a", json.dumps([{"id": "r", "author": "u", "text": "x", "score": 2, "replies": [{"id": "s", "body": "y", "replies": ""}]}, {"id": "q"}])), ("b", "broken {"), ("c", None), ("d", json.dumps(deep))]
    flat = threads.flatten(spark.createDataFrame(rows, "thread string, json string"))
    got = {(r.thread, r.node): (r.parent, r.depth, r.text, r.score) for r in flat.collect()}
    assert got["a", "s"] == ("r", 1, "y", None) and got["a", "q"] == (None, 0, "", None) and got["d", "d0"][1] == 399 and len(got) == 403
    again = threads.flatten(threads.rebuild(flat))
    assert {(r.thread, r.node): (r.parent, r.depth, r.text, r.score) for r in again.collect()} == got
    lost = spark.createDataFrame([("t", 0, "x", "gone", 1, "a", "t", 1)], threads.FLAT)
    assert threads.rebuild(lost).first().orphans == 1
    view = threads.latest_view(threads.as_nodes(flat.where("thread = 'a'"), F.lit("now"))).where("node = 'q'").first()
    assert (view.score, view.text, view.edits) == (0, "", 0)
    bag = threads.with_remainder(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"), ["a"]).first()
    assert json.loads(bag.extra) == {"b": 2, "c": 3}


def test_source_links(spark):
    def pick(*links):
        array = F.array(*[F.struct(F.lit(r).alias("rel"), F.lit(h).alias("href"), F.lit(t).alias("type")) for r, h, t in links])
        return one(spark, fallback.source_link(array, F.lit("http://x/abs/2401.1v2"), "base/"))

    plain = ("alternate", "http://x/p.pdf", "application/pdf")
    assert pick(plain) == "base/2401.1v2"
    assert pick(plain, ("enclosure", "http://x/a.tar.gz", "other")) == "http://x/a.tar.gz"
    assert pick(("enclosure", "http://x/a.tar.gz", "other"), ("derived", "http://x/t", "application/x-tar")) == "http://x/t"
    assert pick(("derived", "http://x/t", "application/x-tar"), ("related", "http://x/e", "application/x-eprint")) == "http://x/e"


@pytest.mark.parametrize(("items", "mode", "cost"), [(5, "shallow", 2), (5000, "shallow", 10), (120, "medium", 4), (45, "deep", 9), (9000, "deep", 150)])
def test_request_estimates(spark, items, mode, cost):
    assert one(spark, models.estimate_requests(F.lit(items), F.lit(mode))) == cost
