"""Dependency graphs as edge tables: building, levels, order and cycles.

All functions work on any number of groups (workflows) at once.  A node is
identified by the group columns and its node column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.operators.ordering import global_rank
from weirstone.session import materialise

# Nodes and links of a group that one row may hold while its levels are worked out.
ROW_LIMIT = 512


def _merged(side: DataFrame) -> DataFrame:
    """``side`` for a join by sorting both sides.

    Tables of a graph grow with it and are joined round by round; left to
    Spark's threshold, each of them would pass through the driver to be sent to every task.
    """
    return side.hint("merge")


def edges_from_refs(nodes: DataFrame, group: Sequence[str], node: str, refs: Column) -> DataFrame:
    """Edges (node, upstream) from a list of upstream ids per node; blanks are no edge."""
    pairs = nodes.select(*group, F.col(node).alias("node"), F.explode(refs).alias("upstream"))
    return pairs.where(F.coalesce(F.col("upstream"), F.lit("")) != "")


def prune_edges(nodes: DataFrame, edges: DataFrame, group: Sequence[str]) -> DataFrame:
    """Distinct edges whose two ends are known nodes of their group."""
    ids = nodes.select(*group, "node").distinct()
    ups = ids.withColumnRenamed("node", "upstream")
    plain = edges.select(*group, "node", "upstream").distinct()
    return plain.join(_merged(ids), [*group, "node"], "left_semi").join(_merged(ups), [*group, "upstream"], "left_semi")


def degrees(nodes: DataFrame, edges: DataFrame, group: Sequence[str]) -> DataFrame:
    """In-degree and out-degree per node, zero kept, in one aggregation."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    rows = (
        nodes.select(*group, "node", zero.alias("i"), zero.alias("o"), F.lit(True).alias("known"))
        .unionByName(edges.select(*group, "node", one.alias("i"), zero.alias("o"), F.lit(False).alias("known")))
        .unionByName(
            edges.select(*group, F.col("upstream").alias("node"), zero.alias("i"), one.alias("o"), F.lit(False).alias("known"))
        )
    )
    total = rows.groupBy(*group, "node").agg(
        F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"), F.max("known").alias("known")
    )
    return total.where("known").drop("known")


def topological_levels(
    nodes: DataFrame, edges: DataFrame, group: Sequence[str] = (), row_limit: int = ROW_LIMIT
) -> DataFrame:
    """Level of every node: 0 without upstream, else one more than its highest upstream.

    The level is null for a node on a cycle or downstream of one.  Groups of at
    most ``row_limit`` nodes and links are solved each in a row of its own, all
    at once.  In the others, runs of nodes with one upstream are contracted by
    pointer doubling, in a number of rounds that grows with the logarithm of
    the longest run; what is left are the nodes with several upstreams, which
    are peeled off layer by layer.  One group's shape does not change how
    another is solved.
    """
    group = list(group)
    ids = nodes.select(*group, "node").distinct()
    known = materialise(prune_edges(ids, edges, group), "edges")
    if not group:
        return _levels(ids, known, group)
    none = F.lit(None).cast(known.schema["upstream"].dataType)
    both = materialise(ids.select("*", none.alias("upstream")).unionByName(known), "graph")
    sizes = both.groupBy(*group).count()
    large = materialise(sizes.where(F.col("count") > row_limit).select(*group), "large")
    if large.isEmpty():
        return _levels_in_rows(both, group)
    small = _levels_in_rows(both.join(large, group, "left_anti"), group)
    rest = both.join(large, group, "left_semi")
    return small.unionByName(
        _levels(rest.where("upstream IS NULL").drop("upstream"), rest.where("upstream IS NOT NULL"), group)
    )


def _levels_in_rows(both: DataFrame, group: list[str]) -> DataFrame:
    """Levels of small groups: a group becomes one row of nodes, each with the places of its upstreams.

    ``both`` has each node once with a null upstream, and the links.  A round
    gives its number to all open nodes whose upstreams have a level; a group
    has at most as many rounds as nodes, and those after its last change pass.
    """
    listed = both.groupBy(*group, "node").agg(F.collect_list("upstream").alias("ups"))
    grouped = listed.groupBy(*group).agg(F.collect_list(F.struct("node", "ups")).alias("nodes"))
    names = F.transform("nodes", lambda n: n["node"])
    placed = grouped.select(
        *group,
        names.alias("names"),
        F.transform(
            "nodes", lambda n: F.transform(n["ups"], lambda u: (F.array_position(names, u) - 1).cast("int"))
        ).alias("ups"),
    )

    def free(ups: Column, levels: Column) -> Column:
        return F.forall(ups, lambda u: F.get(levels, u).isNotNull())

    def layer(state: Column, number: Column) -> Column:
        levels = state["levels"]
        after = F.transform(
            F.col("ups"),
            lambda ups, i: F.coalesce(F.get(levels, i), F.when(free(ups, levels), number)),
        )
        # a round that settles nothing is the last: the nodes that are left hang on a cycle
        step = F.transform(F.array(after), lambda a: F.struct(a.alias("levels"), (a == levels).alias("done")))
        return F.when(state["done"], state).otherwise(F.get(step, 0))

    start = F.struct(
        F.transform("ups", lambda _: F.lit(None).cast("bigint")).alias("levels"), F.lit(False).alias("done")
    )
    rounds = F.sequence(F.lit(0).cast("bigint"), F.size("names").cast("bigint") - 1)
    solved = placed.withColumn("levels", F.aggregate(rounds, start, layer)["levels"])
    pairs = F.arrays_zip("names", "levels")
    flat = solved.select(*group, F.explode(pairs).alias("p"))
    return flat.select(*group, F.col("p.names").alias("node"), F.col("p.levels").alias("level"))


def _levels(ids: DataFrame, known: DataFrame, group: list[str]) -> DataFrame:
    key = [*group, "node"]
    shape = known.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("upstream").alias("_up"))
    anchored = _anchors(ids.join(_merged(shape), key, "left"), group)
    many = shape.where("_n > 1").select(*key)
    ends = anchored.select(*group, F.col("node").alias("upstream"), "anchor", "dist", "lost")
    # an edge of a node with several upstreams reaches the anchor of each
    links = known.join(_merged(many), key, "left_semi").join(_merged(ends), [*group, "upstream"]).select(
        *key, F.col("anchor").alias("upstream"), (F.col("dist") + 1).alias("weight"), "lost"
    )
    solved = _peel(anchored.where("node = anchor").join(_merged(many), key, "left_anti").select(*key), links, group)
    tops = solved.select(*group, F.col("node").alias("anchor"), F.col("level").alias("_top"))
    placed = anchored.join(_merged(tops), [*group, "anchor"], "left")
    level = F.when(~F.col("lost"), F.col("_top") + F.col("dist"))
    return placed.select(*key, level.alias("level"))


def _anchors(shaped: DataFrame, group: list[str]) -> DataFrame:
    """For each node the nearest node at or above it that has not exactly one upstream.

    ``dist`` steps lie between; a node whose run ends in a cycle has no such
    node and is ``lost``.  Settled nodes are written once; only open ones are
    carried from round to round, and they look up in what is settled and open.

    Round r settles the nodes of 2^(r-1) to 2^r - 1 steps, and a run that ends
    has nodes of every number of steps up to its length.  So the first round that
    settles none is the last: all that is open runs into cycles.
    """
    single = F.coalesce(F.col("_n") == 1, F.lit(False))
    start = shaped.select(
        *group,
        "node",
        F.when(single, F.col("_up")).otherwise(F.col("node")).alias("anchor"),
        F.when(single, 1).otherwise(0).cast("bigint").alias("dist"),
        single.alias("open"),
    )
    state = materialise(start, "anchors")
    done, open_ = [state.where("NOT open")], state.where("open")
    while not open_.isEmpty():
        there = reduce(DataFrame.unionByName, [*done, open_]).select(
            *group, F.col("node").alias("anchor"), F.col("anchor").alias("_a"), F.col("dist").alias("_d"), F.col("open").alias("_o")
        )
        moved = open_.join(_merged(there), [*group, "anchor"]).select(
            *group, "node", F.col("_a").alias("anchor"), (F.col("dist") + F.col("_d")).alias("dist"), F.col("_o").alias("open")
        )
        state = materialise(moved, "anchors")
        settled, open_ = state.where("NOT open"), state.where("open")
        if settled.isEmpty():
            break
        done.append(settled)
    every = reduce(DataFrame.unionByName, done).withColumn("lost", F.lit(False))
    lost = open_.withColumn("lost", F.lit(True))
    return every.unionByName(lost).drop("open")


def _peel(roots: DataFrame, links: DataFrame, group: list[str]) -> DataFrame:
    """Levels of roots and of the nodes of weighted links that hang on no cycle.

    A round marks the links whose upper end was solved in the round before and
    writes the links of nodes that are not solved yet; solved nodes are written
    once and not carried on.
    """
    key = [*group, "node"]
    level = F.lit(0).cast("bigint").alias("level")
    solved = [roots.select(*key, level)]
    rest = materialise(links.withColumn("value", F.lit(None).cast("bigint")), "links")
    fresh = solved[0]
    while True:
        upper = fresh.select(*group, F.col("node").alias("upstream"), F.col("level").alias("_l"))
        joined = rest.join(_merged(upper), [*group, "upstream"], "left")
        marked = joined.withColumn("value", F.coalesce("value", F.when(~F.col("lost"), F.col("_l") + F.col("weight")))).drop("_l")
        marked = materialise(marked, "links")
        total = marked.groupBy(*key).agg(F.bool_and(F.col("value").isNotNull()).alias("_free"), F.max("value").alias("level"))
        fresh = materialise(total.where("_free").select(*key, "level"), "solved")
        if fresh.isEmpty():
            return reduce(DataFrame.unionByName, solved)
        solved.append(fresh)
        rest = marked.join(_merged(fresh.select(*key)), key, "left_anti")


def topological_order(
    levels: DataFrame, positions: DataFrame, group: Sequence[str] = (), position: str = "pos"
) -> DataFrame:
    """Nodes with ``order_pos``: by level, then input position; cyclic nodes last.

    ``positions`` has one row per node.

    ``order_pos`` counts through all groups; within a group it ascends in a
    valid execution order.
    """
    rows = levels.join(positions.select(*group, "node", position), [*group, "node"])
    order = [*[F.col(g) for g in group], F.col("level").asc_nulls_last(), F.col(position), F.col("node")]
    return global_rank(rows, order, "order_pos", unique=True)


def cyclic_nodes(nodes: DataFrame, edges: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Nodes that never become free, with ``on_cycle``.

    The others of them lie downstream of a cycle; some of these lead to a
    further cycle without being on one.
    """
    group = list(group)
    key = [*group, "node"]
    stuck, known = _stuck(nodes, edges, group)
    found = _components(stuck, known, group).select(*key, F.lit(True).alias("on_cycle"))
    return stuck.join(_merged(found), key, "left").withColumn("on_cycle", F.coalesce("on_cycle", F.lit(False)))


def cycle_components(nodes: DataFrame, edges: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Every node on a cycle with ``component``, the smallest node of its strongly connected component.

    Two nodes are in one component if each can be reached from the other; a
    node that is its own upstream is one by itself.
    """
    group = list(group)
    return _components(*_stuck(nodes, edges, group), group)


def _stuck(nodes: DataFrame, edges: DataFrame, group: list[str]) -> tuple[DataFrame, DataFrame]:
    """Nodes on or below a cycle, and the known links between them."""
    levels = topological_levels(nodes, edges, group)
    stuck = materialise(levels.where(F.col("level").isNull()).select(*group, "node"), "stuck")
    return stuck, materialise(prune_edges(stuck, edges, group), "edges")


def _components(nodes: DataFrame, links: DataFrame, group: list[str]) -> DataFrame:
    """Strongly connected components of two or more nodes, or of one with a link to itself.

    Every node takes the least colour among those that lead to it.  Where a
    colour started, the nodes of that colour that lead back to the start are a
    component.  No component has two colours, so links between colours go, and
    the next round works on what is left.  Colours are ordered by hash: a chain
    of components then takes a number of rounds that grows with its logarithm
    on average, however the nodes are numbered.
    """
    key = [*group, "node"]
    found: list[DataFrame] = []
    while not links.isEmpty():
        coloured = _spread_colours(nodes.select(*key), links, group)
        ends = coloured.select(*key, "colour")
        upper = ends.withColumnRenamed("node", "upstream")
        inner = materialise(links.join(_merged(ends), key).join(_merged(upper), [*group, "upstream", "colour"]), "inner")
        members = _reach_back(ends.where("colour.node = node"), inner, group)
        found.append(members)
        open_ends = members.select(*key)
        links = inner.select(*key, "upstream").join(_merged(open_ends), key, "left_anti")
        links = links.join(_merged(open_ends.withColumnRenamed("node", "upstream")), [*group, "upstream"], "left_anti")
        links = materialise(_inner_links(links, group), "links")
        nodes = links.select(*key).distinct()
    if not found:
        return nodes.select(*key, F.col("node").alias("component")).limit(0)
    every = reduce(DataFrame.unionByName, found)
    parts = every.groupBy(*group, "colour").agg(F.min("node").alias("component"), F.count(F.lit(1)).alias("_n"))
    named = every.join(_merged(parts), [*group, "colour"])
    return named.where("_n > 1 OR own").select(*key, "component")


def _inner_links(links: DataFrame, group: list[str]) -> DataFrame:
    """Links whose lower end has a link below it and whose upper end has one above it: others are on no cycle."""
    lower = links.select(*group, F.col("upstream").alias("node")).distinct()
    upper = links.select(*group, F.col("node").alias("upstream")).distinct()
    return links.join(_merged(lower), [*group, "node"], "left_semi").join(_merged(upper), [*group, "upstream"], "left_semi")


def _spread_colours(nodes: DataFrame, links: DataFrame, group: list[str]) -> DataFrame:
    """Each node with the least colour of itself and all nodes above it; only changes travel on."""
    key = [*group, "node"]
    colour = F.struct(F.xxhash64("node").alias("hash"), F.col("node").alias("node"))
    state = materialise(nodes.select(*key, colour.alias("colour"), F.lit(True).alias("fresh")), "colours")
    while True:
        moved = state.where("fresh").select(*group, F.col("node").alias("upstream"), "colour")
        best = links.join(_merged(moved), [*group, "upstream"]).groupBy(*key).agg(F.min("colour").alias("_new"))
        less = F.coalesce(F.col("_new") < F.col("colour"), F.lit(False))
        after = state.join(_merged(best), key, "left").select(
            *key, F.when(less, F.col("_new")).otherwise(F.col("colour")).alias("colour"), less.alias("fresh")
        )
        state = materialise(after, "colours")
        if state.where("fresh").isEmpty():
            return state.drop("fresh")


def _reach_back(starts: DataFrame, inner: DataFrame, group: list[str]) -> DataFrame:
    """Nodes that lead to the start of their colour, with ``own``: has a link to itself."""
    key = [*group, "node"]
    own = inner.where("node = upstream").select(*key).distinct().withColumn("own", F.lit(True))
    fresh = materialise(starts.select(*key, "colour"), "members")
    done = [fresh]
    while not fresh.isEmpty():
        above = inner.join(_merged(fresh.select(*key)), key, "left_semi").select(*group, F.col("upstream").alias("node"), "colour").distinct()
        known = reduce(DataFrame.unionByName, done).select(*key)
        fresh = materialise(above.join(_merged(known), key, "left_anti"), "members")
        done.append(fresh)
    every = reduce(DataFrame.unionByName, done)
    return materialise(every.join(_merged(own), key, "left").withColumn("own", F.coalesce("own", F.lit(False))), "members")


def cross_group_edges(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Distinct dependencies between different groups."""
    return pairs.where(F.col(left) != F.col(right)).select(left, right).distinct()


def reference_edges(texts: DataFrame, key: str, text: str, pattern: str, name: str = "target") -> DataFrame:
    """Distinct (key, reference) edges from references inside a text.

    References repeat within a text, so each text drops its own repeats first.
    """
    found = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1)))
    return texts.select(key, F.explode(found).alias(name)).distinct()
