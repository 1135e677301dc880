"""Properties of the operators, checked against brute force; most rows share one key."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from weirstone.operators import graph, joins, keyed, ordering, quality, reconcile, setops
from weirstone.plans.registry import table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed():
    """(key, pos, value) with a third of the rows under key 0 and repeated values."""
    rnd = random.Random(7)
    return [(0 if rnd.random() < 0.34 else rnd.randrange(1, 200), i, rnd.randrange(50)) for i in range(6000)]


@pytest.fixture(scope="module")
def frame(spark, skewed):
    return spark.createDataFrame(skewed, "k long, pos long, v long").repartition(6).cache()


def test_first_and_last(frame, skewed):
    first, last = {}, {}
    for k, pos, v in skewed:
        first.setdefault(k, (k, pos, v))
        last[k] = (k, pos, v)
    assert rows(keyed.first_per_key(frame, ["k"], ["pos"])) == sorted(first.values(), key=repr)
    assert rows(keyed.last_per_key(frame, ["k"], ["pos"])) == sorted(last.values(), key=repr)


def test_later_writers_and_first_writers_are_the_table(frame, skewed):
    later = keyed.later_writers(frame, ["k"], ["pos"]).select("k", "pos", "v")
    both = later.unionByName(keyed.first_per_key(frame, ["k"], ["pos"]))
    assert rows(both) == sorted(skewed, key=repr)
    counts = Counter(k for k, _, _ in skewed)
    assert {r.k: r.n_losers for r in keyed.repeated_keys(frame, ["k"], ["pos"]).collect()} == {
        k: n - 1 for k, n in counts.items() if n > 1}


def test_dedupe_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 3), ("a", 2), ("b", 4)], "k string, pos int")
    assert rows(keyed.dedupe_keep_null(df, "k", ["pos"])) == sorted([(None, 1), (None, 1), ("a", 2), ("b", 4)], key=repr)


def test_insert_ignore_is_idempotent(spark, frame):
    stored = spark.createDataFrame([(0, -1, -1)], "k long, pos long, v long")
    fresh = keyed.insert_ignore(stored, frame, ["k"], ["pos"])
    after = stored.unionByName(fresh)
    assert after.count() == frame.select("k").distinct().count()
    assert keyed.insert_ignore(after, frame, ["k"], ["pos"]).count() == 0
    assert rows(after.where("k = 0")) == [(0, -1, -1)]


def test_global_rank(frame, skewed):
    ranked = ordering.global_rank(frame, [F.col("k").desc(), F.col("pos")], "n")
    want = [(k, p, v, i + 1) for i, (k, p, v) in enumerate(sorted(skewed, key=lambda r: (-r[0], r[1])))]
    assert sorted(tuple(r) for r in ranked.select("k", "pos", "v", "n").collect()) == sorted(want)


def test_copies_are_ranked_in_many_ranges(spark):
    # every second row is the same row
    df = spark.range(8000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("x"))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")  # keep small ranges apart
    try:
        stored = ordering._sorted_ranges(df, [F.col("x")], unique=False)
    finally:
        spark.conf.set(merge, "true")
    sizes = [r["count"] for r in stored.groupBy(F.shiftright("_mid", 33)).count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 2500
    ranked = ordering.global_rank(df, [F.col("x")], "n").collect()
    assert sorted(r.n for r in ranked) == list(range(1, 8001))
    assert all(r.n <= 4000 for r in ranked if r.x == -1)


def test_parts_are_bounded_and_whole(frame, skewed):
    parts = ordering.collect_children(frame, "k", ["pos"], F.col("pos"), 64).collect()
    assert max(r.n_children for r in parts) <= 64
    found = defaultdict(list)
    for r in sorted(parts, key=lambda r: (r.k, r.part)):
        found[r.k] += r.children
    want = defaultdict(list)
    for k, pos, _ in skewed:
        want[k].append(pos)
    assert found == want


def test_row_difference(spark):
    a = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    assert rows(setops.row_difference(a, b)) == [(1, "source_only", 2), (2, "source_only", 1), (3, "target_only", 1)]
    assert setops.row_difference(a, a.repartition(3)).count() == 0


def test_membership_with_hot_group(frame):
    left = frame.where("v < 30").select("k", "v")
    right = frame.where("v > 20").select("k", "v")
    counts = setops.missing_and_extra_counts(left, right, "k", ["v"]).agg(F.sum("n_missing"), F.sum("n_extra"), F.sum("n_common")).first()
    pairs = lambda d: {(r.k, r.v) for r in d.collect()}
    a, b = pairs(left), pairs(right)
    assert tuple(counts) == (len(a - b), len(b - a), len(a & b))


def test_checksum_ignores_order_and_sees_one_cell(spark, sf):
    orders = table(spark, sf, "orders")
    plain = reconcile.table_checksum(orders).first()
    mixed = reconcile.table_checksum(orders.repartition(13, "o_totalprice")).first()
    assert plain == mixed
    changes = [
        ("o_orderstatus", F.lit("Q")), ("o_totalprice", F.col("o_totalprice") + 0.01), ("o_custkey", F.lit(None).cast("bigint")),
        ("o_orderdate", F.col("o_orderdate") + F.expr("interval 1 second")),
    ]
    for column, value in changes:
        changed = orders.withColumn(column, F.when(F.col("o_orderkey") == 9, value).otherwise(F.col(column)))
        assert reconcile.table_checksum(changed).first().checksum != plain.checksum, column


def test_checksum_text_is_unambiguous(spark):
    def total(*values):
        return reconcile.table_checksum(spark.createDataFrame([values], "a string, b string")).first().checksum

    assert len({total("x|", "y"), total("x", "|y"), total("~", "y"), total(None, "y"), total("\\p", "y"), total("|", "y")}) == 6


def test_checksum_of_nested_and_odd_values(spark):
    schema = "d double, m map<string,int>, a array<int>, t date, b binary"
    one = spark.createDataFrame([(float("nan"), {"x": 1, "y": 2}, [1], None, b"z"), (1e300, None, None, None, None)], schema)
    same = spark.createDataFrame([(1e300, None, None, None, None), (float("nan"), {"y": 2, "x": 1}, [1], None, b"z")], schema)
    other = spark.createDataFrame([(0.0, {"x": 1, "y": 2}, [1], None, b"z"), (1e300, None, None, None, None)], schema)
    a, b, c = (reconcile.table_checksum(d).first().checksum for d in (one, same, other))
    assert a == b != c


def test_checks_of_empty_and_missing_tables(spark, sf):
    empty = table(spark, sf, "orders").limit(0)
    row = reconcile.check_table(empty, "orders").first()
    assert (row.row_count, row.checksum, row.ok) == (0, None, False)
    spark.range(3).createOrReplaceTempView("three")
    found = {r.table_name: (r.row_count, r.ok) for r in quality.catalog_tables_non_empty(spark, ["three", "not_there"]).collect()}
    assert found == {"three": (3, True), "not_there": (None, False)}


def test_verdicts(spark):
    def passed(values):
        return quality.verdict(spark.createDataFrame([(v,) for v in values], "ok boolean")).first().passed

    assert [passed(v) for v in ([True, True], [True, False], [True, None], [])] == [True, False, False, False]


def test_conditions_treat_null_as_violation(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "n int")
    found = quality.assert_table(df, "t", ["n"], {"n > 0": F.col("n") > 0}).collect()
    assert {(r.assertion, r.violations, r.ok) for r in found} == {("non_null", 1, False), ("row_condition", 2, False)}
    assert quality.violations(df, F.col("n") > 0).count() == 2


def test_compare_checks_tolerance_and_one_side(spark):
    a = spark.createDataFrame([(1, 100.0)], "i long, x double")
    b = spark.createDataFrame([(1, 100.5)], "i long, x double")
    left = reconcile.check_tables({"t": a, "only": a})
    right = reconcile.check_tables({"t": b})
    strict = {r.table_name: r for r in reconcile.compare_checks(left, right).collect()}
    loose = {r.table_name: r for r in reconcile.compare_checks(left, right, tolerance=0.01).collect()}
    assert (strict["t"].count_ok, strict["t"].aggregates_ok) == (True, False)
    assert loose["t"].aggregates_ok and not loose["t"].checksum_ok
    assert not strict["only"].ok


def test_keyed_compare(spark):
    s = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), ("d", 4), ("d", 4)], "k string, n int")
    t = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("e", 5), ("d", 4)], "k string, n int")
    found = {r.k: r.status for r in reconcile.compare_keyed(s, t, ["k"], ["n"]).collect()}
    assert found == {"a": "match", "b": "diff", "c": "match", "d": "duplicate_key", "e": "target_only"}
    assert {r.k: r.status for r in reconcile.compare_keyed(s.limit(1), t.limit(0), ["k"], ["n"]).collect()} == {"a": "source_only"}


def test_map_side_join_beyond_its_bound(frame, spark):
    dim = spark.range(200).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    small = joins.map_side_join(frame, dim, ["k"])
    large = joins.map_side_join(frame, dim, ["k"], max_bytes=10)
    assert rows(small) == rows(large)
    assert "ResolvedHint (strategy=broadcast)" in small._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()


def _levels(nodes, edges):
    ups = defaultdict(set)
    for n, u in edges:
        if n in nodes and u in nodes:
            ups[n].add(u)
    level, changed = {}, True
    while changed:
        changed = False
        for n in nodes:
            if n not in level and all(u in level for u in ups[n]):
                level[n] = 1 + max((level[u] for u in ups[n]), default=-1)
                changed = True
    return {n: level.get(n) for n in nodes}


@pytest.mark.parametrize("seed, tree", [(1, True), (2, False), (3, True), (4, False)])
def test_levels_match_brute_force(spark, seed, tree):
    rnd = random.Random(seed)
    nodes = [f"n{i}" for i in range(60)]
    edges = []
    for i in range(1, 60):
        # half of the nodes hang below one hub
        ups = [0 if rnd.random() < 0.5 else rnd.randrange(i) for _ in range(1 if tree else 3)]
        edges += [(nodes[i], nodes[u]) for u in ups]
    edges += [("n5", "gone"), ("gone", "n5")]
    if seed > 2:
        edges.append((nodes[0], nodes[40]))  # closes a cycle
    df = spark.createDataFrame([(n,) for n in nodes], "node string")
    ed = spark.createDataFrame(edges, "node string, upstream string")
    found = {r.node: r.level for r in graph.topological_levels(df, ed).collect()}
    assert found == _levels(nodes, edges)


def test_long_chain_and_groups(spark):
    chain = [(g, f"n{i}") for g in ("a", "b") for i in range(300)]
    links = [(g, f"n{i}", f"n{i - 1}") for g in ("a", "b") for i in range(1, 300)]
    df = spark.createDataFrame(chain, "g string, node string")
    ed = spark.createDataFrame(links + [("b", "n0", "n299")], "g string, node string, upstream string")
    found = {(r.g, r.node): r.level for r in graph.topological_levels(df, ed, ["g"]).collect()}
    assert all(found["a", f"n{i}"] == i for i in range(300))
    assert all(found["b", f"n{i}"] is None for i in range(300))


def test_deep_graph_of_many_upstreams(spark):
    df = spark.createDataFrame([(f"n{i}",) for i in range(8)], "node string")
    pairs = [(f"n{i}", f"n{j}") for i in range(8) for j in range(i)]
    ed = spark.createDataFrame(pairs, "node string, upstream string")
    order = graph.topological_order(graph.topological_levels(df, ed), df.withColumn("pos", F.lit(0)))
    assert [r.node for r in order.orderBy("order_pos").collect()] == [f"n{i}" for i in range(8)]


def test_a_diamond_elsewhere_does_not_slow_a_chain(spark, monkeypatch):
    chain = [("a", f"n{i}", f"n{i - 1}") for i in range(1, 200)]
    diamond = [("b", "q", "p"), ("b", "r", "p"), ("b", "s", "q"), ("b", "s", "r")]
    ed = spark.createDataFrame(chain + diamond, "g string, node string, upstream string")
    df = ed.select("g", "node").union(ed.select("g", "upstream")).distinct()
    written = []
    keep = graph.materialise
    monkeypatch.setattr(graph, "materialise", lambda d, label: written.append(label) or keep(d, label))
    found = {(r.g, r.node): r.level for r in graph.topological_levels(df, ed, ["g"]).collect()}
    assert all(found["a", f"n{i}"] == i for i in range(200))
    assert [found["b", n] for n in "pqrs"] == [0, 1, 1, 2]
    assert written.count("anchors") <= 10 and written.count("links") <= 4


def test_cycle_and_its_tail(spark):
    df = spark.createDataFrame([(x,) for x in "abcdef"], "node string")
    ed = spark.createDataFrame([("b", "a"), ("c", "b"), ("b", "c"), ("d", "c"), ("e", "d"), ("d", "a")], "node string, upstream string")
    assert rows(graph.cyclic_nodes(df, ed)) == [("b", True), ("c", True), ("d", False), ("e", False)]
    assert graph.cyclic_nodes(df, ed.where("node <> 'b'")).count() == 0


def test_degrees(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",)], "node string")
    ed = spark.createDataFrame([("b", "a"), ("c", "a")], "node string, upstream string")
    assert rows(graph.degrees(df, ed, [])) == [("a", 0, 2), ("b", 1, 0), ("z", 0, 0)]


def test_graphs_without_edges_or_nodes(spark):
    df = spark.createDataFrame([("a",), ("b",)], "node string")
    none = spark.createDataFrame([], "node string, upstream string")
    assert rows(graph.topological_levels(df, none)) == [("a", 0), ("b", 0)]
    assert graph.topological_levels(df.limit(0), none).count() == 0
    assert graph.cyclic_nodes(df, none).count() == 0
    loop = spark.createDataFrame([("a", "a")], "node string, upstream string")
    assert rows(graph.cyclic_nodes(df, loop)) == [("a", True)]


def test_value_parity_with_hot_key(spark, frame):
    changed = frame.withColumn("v", F.when(F.col("pos") % 10 == 0, F.col("v") + 1).otherwise(F.col("v")))
    found = {r.column_name: (r.mismatches, r.compared) for r in reconcile.value_parity(frame, changed, "pos", ["k", "v"]).collect()}
    assert found == {"k": (0, 6000), "v": (600, 6000)}
    part = reconcile.value_parity(frame, changed, "pos", ["v"], "4").first()
    assert 1000 < part.compared < 2000 and part.mismatches > 0


def test_value_parity_counts_both_sides(spark):
    kind = "k int, v string"
    s = spark.createDataFrame([(k, "a") for k in range(10)] + [(11, None), (12, "x"), (12, "x")], kind)
    t = spark.createDataFrame([(k, "a") for k in range(3)] + [(11, None), (12, "x"), (20, "q")], kind)
    row = reconcile.value_parity(s, t, "k", ["v"]).first().asDict()
    assert row == {"column_name": "v", "mismatches": 0, "compared": 4, "source_only": 7, "target_only": 1, "duplicate_keys": 1}


def test_profile_keeps_what_sums_cannot_hold(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (1e18,), (-2e300,), (None,)], "x double")
    row = reconcile.numeric_profile(df).first()
    assert (row.sum_value, row.n_not_summed) == (str(10**20 + 100), 3)
    assert (float(row.min_value), row.max_value) == (-2e300, "NaN")
    a = reconcile.check_tables({"t": df})
    b = reconcile.check_tables({"t": df.where("x IS NULL OR NOT isnan(x)")})
    assert not reconcile.compare_checks(a, b).first().ok
    cents = spark.createDataFrame([(0.001,)], "x double"), spark.createDataFrame([(0.004,)], "x double")
    exact = [reconcile.table_checksum(d).first().checksum for d in cents]
    coarse = [reconcile.table_checksum(d, digits=2).first().checksum for d in cents]
    assert exact[0] != exact[1] and coarse[0] == coarse[1]
    wide = spark.sql("SELECT CAST('123456789012345678901234.56' AS DECIMAL(38,2)) AS d")
    assert reconcile.numeric_profile(wide).first().sum_value == "12345678901234567890123456"


def test_parts_count_from_each_parent(spark):
    df = spark.createDataFrame([(p, i) for p in (1, 2, 3, 4, None) for i in range(3)], "p int, i int")
    parts = ordering.collect_children(df, "p", ["i"], F.col("i"), 5).collect()
    assert sorted((r.part, r.n_children) for r in parts) == [(0, 3)] * 5


def test_empty_tables_rank(spark):
    none = spark.createDataFrame([], "k long, p long")
    assert ordering.global_rank(none, [F.col("p")], "n").count() == 0
    assert ordering.collect_children(none, "k", ["p"], F.col("p"), 5).count() == 0
