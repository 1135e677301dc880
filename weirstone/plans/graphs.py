"""Dependency-graph jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.operators import graph, joins
from weirstone.plans.registry import query, table

HREF = 'href="([^"]+)"'


def _tree(spark, sf):
    part = table(spark, sf, "part")
    nodes = part.select(F.col("p_partkey").alias("node"))
    edges = part.where("p_partkey > 0").selectExpr("p_partkey AS node", "(p_partkey - 1) DIV 2 AS upstream")
    return nodes, edges


@query(
    "topo_levels",
    """WITH RECURSIVE r AS (SELECT p_partkey AS node, 0::BIGINT AS level FROM part WHERE p_partkey = 0
         UNION ALL SELECT p.p_partkey, r.level + 1 FROM part p JOIN r ON (p.p_partkey - 1) // 2 = r.node WHERE p.p_partkey > 0)
       SELECT node, level FROM r""",
)
def topo_levels(spark, sf):
    nodes, edges = _tree(spark, sf)
    return graph.topological_levels(nodes, edges)


@query(
    "topo_levels_dag",
    """WITH RECURSIVE e AS (SELECT p_partkey AS node, (p_partkey - 1) // 2 AS upstream FROM part WHERE p_partkey > 0
           UNION SELECT p_partkey, (p_partkey - 1) // 3 FROM part WHERE p_partkey > 0),
         r AS (SELECT 0::BIGINT AS node, 0::BIGINT AS level
           UNION SELECT e.node, r.level + 1 FROM e JOIN r ON e.upstream = r.node)
       SELECT node, MAX(level) AS level FROM r GROUP BY node""",
)
def topo_levels_dag(spark, sf):
    # Every node has up to two upstream nodes, so levels come from the longest path.
    nodes, edges = _tree(spark, sf)
    more = table(spark, sf, "part").where("p_partkey > 0").selectExpr("p_partkey AS node", "(p_partkey - 1) DIV 3 AS upstream")
    return graph.topological_levels(nodes, edges.unionByName(more))


@query(
    "topo_levels_mixed",
    """SELECT 'chain' AS part, p_partkey AS node, p_partkey - MIN(p_partkey) OVER () AS level FROM part
       UNION ALL SELECT 'diamond', n, l FROM (VALUES (1, 0), (2, 1), (3, 1), (4, 2)) v(n, l)
       UNION ALL SELECT 'loop', n, NULL FROM (VALUES (1), (2), (3)) v(n)""",
)
def topo_levels_mixed(spark, sf):
    # One chain through all keys beside a diamond and a cycle with a node below: the chain is solved by doubling.
    part = table(spark, sf, "part").select(F.lit("chain").alias("part"), F.col("p_partkey").alias("node"))
    least = part.agg(F.min("node").alias("least"))
    chain = part.join(F.broadcast(least)).where("node > least").select("part", "node", (F.col("node") - 1).alias("upstream"))
    small = spark.sql(
        """SELECT part, CAST(node AS BIGINT) AS node, CAST(upstream AS BIGINT) AS upstream FROM VALUES
           ('diamond', 2, 1), ('diamond', 3, 1), ('diamond', 4, 2), ('diamond', 4, 3),
           ('loop', 1, 2), ('loop', 2, 1), ('loop', 3, 2) AS t(part, node, upstream)"""
    )
    ends = small.select("part", F.explode(F.array("node", "upstream")).alias("node")).distinct()
    return graph.topological_levels(part.unionByName(ends), chain.unionByName(small), ["part"])


@query(
    "topo_order",
    """WITH RECURSIVE r AS (SELECT p_partkey AS node, 0::BIGINT AS level FROM part WHERE p_partkey = 0
         UNION ALL SELECT p.p_partkey, r.level + 1 FROM part p JOIN r ON (p.p_partkey - 1) // 2 = r.node WHERE p.p_partkey > 0)
       SELECT r.node, level, row_number() OVER (ORDER BY level, p_size, r.node) AS order_pos
       FROM r JOIN part ON r.node = p_partkey""",
)
def topo_order(spark, sf):
    nodes, edges = _tree(spark, sf)
    positions = table(spark, sf, "part").select(F.col("p_partkey").alias("node"), F.col("p_size").alias("pos"))
    ordered = graph.topological_order(graph.topological_levels(nodes, edges), positions)
    return ordered.select("node", "level", "order_pos")


@query(
    "cycle_nodes",
    """WITH RECURSIVE m AS (SELECT MAX(p_partkey) AS k FROM part),
         r AS (SELECT unnest([k // 8, k // 4]) AS node FROM m
           UNION SELECT p.p_partkey FROM part p JOIN r ON (p.p_partkey - 1) // 2 = r.node WHERE p.p_partkey > 0)
       SELECT node, node IN (SELECT unnest([k // 8, k // 4]) FROM m) AS on_cycle FROM r""",
)
def cycle_nodes(spark, sf):
    # Two inner nodes of the tree depend on each other; all below them is stuck as well.
    nodes, edges = _tree(spark, sf)
    top = table(spark, sf, "part").agg(F.max("p_partkey").alias("k"))
    back = top.select(F.explode(F.array(
        F.struct(F.expr("k DIV 4").alias("node"), F.expr("k DIV 8").alias("upstream")),
        F.struct(F.expr("k DIV 8").alias("node"), F.expr("k DIV 4").alias("upstream")),
    )).alias("e")).select("e.*")
    return graph.cyclic_nodes(nodes, edges.unionByName(back))


@query(
    "conversation_levels",
    """WITH RECURSIVE e AS (SELECT a.conv_id, a.turn AS node, b.turn AS upstream FROM conversations a JOIN conversations b
           ON a.conv_id = b.conv_id AND (b.turn = a.turn - 1 OR b.turn = a.turn - 3) WHERE a.turn % 5 <> 0),
         r AS (SELECT DISTINCT conv_id, turn AS node, 0::BIGINT AS level FROM conversations c
               WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.conv_id = c.conv_id AND e.node = c.turn)
           UNION SELECT e.conv_id, e.node, r.level + 1 FROM e JOIN r ON e.conv_id = r.conv_id AND e.upstream = r.node)
       SELECT conv_id, node, MAX(level) AS level FROM r GROUP BY conv_id, node""",
)
def conversation_levels(spark, sf):
    # Many small graphs: a turn hangs on the one before and the third before, every fifth turn on none.
    turns = table(spark, sf, "conversations").select("conv_id", F.col("turn").alias("node"))
    ups = F.array(F.col("node") - 1, F.col("node") - 3)
    edges = turns.where("node % 5 <> 0").select("conv_id", "node", F.explode(ups).alias("upstream"))
    return graph.topological_levels(turns, edges, ["conv_id"])


# Blocks of eight customers: two cycles in a row with a customer between them and one below, and one that is its own upstream.
_BLOCK_EDGES = "VALUES (0, 1), (1, 2), (2, 0), (3, 2), (4, 3), (4, 5), (5, 4), (6, 5), (7, 7)"


@query(
    "cycle_components",
    f"""WITH RECURSIVE e AS (SELECT c_custkey - c_custkey % 8 + n AS node, c_custkey - c_custkey % 8 + u AS upstream
           FROM customer, ({_BLOCK_EDGES}) v(n, u) WHERE c_custkey % 8 = 0),
         k AS (SELECT e.* FROM e JOIN customer a ON e.node = a.c_custkey JOIN customer b ON e.upstream = b.c_custkey),
         r AS (SELECT node, upstream AS above FROM k UNION SELECT r.node, k.upstream FROM r JOIN k ON r.above = k.node)
       SELECT a.node, MIN(a.above) AS component FROM r a JOIN r b ON a.node = b.above AND a.above = b.node GROUP BY a.node""",
)
def cycle_components(spark, sf):
    nodes, edges = _blocks(spark, sf)
    return graph.cycle_components(nodes, edges)


@query(
    "cycles_in_a_row",
    f"""WITH RECURSIVE e AS (SELECT c_custkey - c_custkey % 8 + n AS node, c_custkey - c_custkey % 8 + u AS upstream
           FROM customer, ({_BLOCK_EDGES}) v(n, u) WHERE c_custkey % 8 = 0),
         k AS (SELECT e.* FROM e JOIN customer a ON e.node = a.c_custkey JOIN customer b ON e.upstream = b.c_custkey),
         r AS (SELECT node, upstream AS above FROM k UNION SELECT r.node, k.upstream FROM r JOIN k ON r.above = k.node),
         c AS (SELECT DISTINCT node FROM r WHERE node = above)
       SELECT node, BOOL_OR(node = above) AS on_cycle FROM r WHERE above IN (SELECT node FROM c) GROUP BY node""",
)
def cycles_in_a_row(spark, sf):
    nodes, edges = _blocks(spark, sf)
    return graph.cyclic_nodes(nodes, edges)


def _blocks(spark, sf):
    nodes = table(spark, sf, "customer").select(F.col("c_custkey").alias("node"))
    first = F.col("node") - F.col("node") % 8
    block = spark.sql(f"SELECT * FROM {_BLOCK_EDGES} AS t(n, u)").collect()
    ends = F.array(*[F.struct((first + e.n).alias("node"), (first + e.u).alias("upstream")) for e in block])
    return nodes, nodes.where("node % 8 = 0").select(F.explode(ends).alias("e")).select("e.*")


@query(
    "edges_from_refs",
    """SELECT a.conv_id, CAST(a.turn AS VARCHAR) AS node, CAST(b.turn AS VARCHAR) AS upstream
       FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn - 1""",
)
def edges_from_refs(spark, sf):
    turn = F.col("turn")
    refs = F.array((turn - 1).cast("string"), F.lit(""))
    nodes = table(spark, sf, "conversations").select("conv_id", turn.cast("string").alias("node"), refs.alias("refs"))
    edges = graph.edges_from_refs(nodes, ["conv_id"], "node", F.col("refs"))
    return graph.prune_edges(nodes, edges, ["conv_id"]).select("conv_id", "node", "upstream")


@query(
    "cross_group_edges",
    """SELECT DISTINCT c_nationkey AS customer_nation, s_nationkey AS supplier_nation
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey WHERE c_nationkey <> s_nationkey""",
)
def cross_group_edges(spark, sf):
    supplier = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("supplier_nation"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("s_suppkey"))
    # Reduce to distinct (order, nation) before orders come in.
    ends = joins.map_side_join(lines, supplier, ["s_suppkey"]).select("l_orderkey", "supplier_nation").distinct()
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("customer_nation")),
        F.col("o_custkey") == F.col("c_custkey"),
    )
    pairs = ends.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return graph.cross_group_edges(pairs, "customer_nation", "supplier_nation")


@query(
    "ref_edges",
    f"SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '{HREF}', 1)) AS target FROM pages",
)
def ref_edges(spark, sf):
    return graph.reference_edges(table(spark, sf, "pages"), "page_id", "html", HREF)


@query(
    "graph_degrees",
    f"""WITH e AS (SELECT DISTINCT 'page_' || page_id AS node, unnest(regexp_extract_all(html, '{HREF}', 1)) AS upstream FROM pages),
        n AS (SELECT 'page_' || page_id AS node FROM pages UNION SELECT upstream FROM e)
        SELECT n.node, (SELECT COUNT(*) FROM e WHERE e.node = n.node) AS in_degree,
               (SELECT COUNT(*) FROM e WHERE e.upstream = n.node) AS out_degree FROM n""",
)
def graph_degrees(spark, sf):
    pages = table(spark, sf, "pages").select(F.concat(F.lit("page_"), "page_id").alias("node"), "html")
    edges = graph.reference_edges(pages, "node", "html", HREF, "upstream")
    nodes = pages.select("node").unionByName(edges.select(F.col("upstream").alias("node"))).distinct()
    return graph.degrees(nodes, edges, [])
