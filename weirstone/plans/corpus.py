"""Findings over texts and scripts."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.functions.rules import RENAMED_FUNCTIONS, REVIEWED_FUNCTIONS
from weirstone.operators import corpus, graph
from weirstone.plans.conversation_documents import TURNS_SQL, turns
from weirstone.plans.graphs import HREF
from weirstone.plans.registry import query, table

_TURNS = f"WITH t AS ({TURNS_SQL})"


@query(
    "token_usage",
    """SELECT doc_id, token, COUNT(*) AS n FROM (
         SELECT doc_id, unnest(regexp_extract_all(lower(text), '([\\w.]+)', 1)) AS token FROM documents)
       WHERE token IN ('the', 'and') GROUP BY doc_id, token""",
)
def token_usage(spark, sf):
    return corpus.token_usage(table(spark, sf, "documents"), "doc_id", "text", ["the", "and"])


_FUNCTIONS = ", ".join(f"'{f}'" for f in (*RENAMED_FUNCTIONS, *REVIEWED_FUNCTIONS))
_REVIEWED = ", ".join(f"'{f}'" for f in REVIEWED_FUNCTIONS)


@query(
    "function_usage",
    f"""{_TURNS} SELECT node_id, token, CASE WHEN token IN ({_REVIEWED}) THEN 'review' ELSE 'rename' END AS action, COUNT(*) AS n
        FROM (SELECT node_id, unnest(regexp_extract_all(upper(content), '([\\w.]+)\\s*\\(', 1)) AS token FROM t)
        WHERE token IN ({_FUNCTIONS}) GROUP BY node_id, token""",
)
def function_usage(spark, sf):
    return corpus.function_usage(turns(spark, sf), "node_id", "content")


@query(
    "unresolved_refs",
    f"""WITH e AS (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '{HREF}', 1)) AS target FROM pages)
        SELECT page_id, target FROM e WHERE target NOT IN (SELECT target FROM e WHERE length(target) % 2 = 0)""",
)
def unresolved_refs(spark, sf):
    refs = graph.reference_edges(table(spark, sf, "pages"), "page_id", "html", HREF)
    return corpus.unresolved_references(refs, refs.where(F.length("target") % 2 == 0), "target").select("page_id", "target")


@query(
    "variable_findings",
    f"""{_TURNS}, u AS (
          SELECT DISTINCT workflow_id, node_id, 'brace' AS form, u FROM (SELECT *, unnest(regexp_extract_all(content, '\\$\\{{(\\w+)\\}}', 1)) AS u FROM t)
          UNION ALL SELECT DISTINCT workflow_id, node_id, 'bracket', u
          FROM (SELECT *, unnest(regexp_extract_all(content, '\\$\\[([A-Za-z_]\\w*(?:\\s*[+-]\\d+)?)\\]', 1)) AS u FROM t)),
        v AS (SELECT *, regexp_extract(u, '^(\\w+)', 1) AS name,
                     TRY_CAST(replace(regexp_extract(u, '([+-]\\d+)$', 1), '+', '') AS INTEGER) AS day_offset FROM u),
        d AS (SELECT workflow_id, 'bizdate' AS name FROM t UNION SELECT workflow_id, 'region' FROM t UNION SELECT workflow_id, custom FROM t)
        SELECT v.workflow_id, node_id, form, v.name, day_offset,
               CASE WHEN d.name IS NULL THEN 'unresolved' WHEN day_offset IS NOT NULL AND v.name <> 'bizdate' THEN 'offset_not_allowed'
                    ELSE 'resolved' END AS status
        FROM v LEFT JOIN d ON v.workflow_id = d.workflow_id AND v.name = d.name""",
)
def variable_findings(spark, sf):
    rows = turns(spark, sf)
    names = F.explode(F.array(F.lit("bizdate"), F.lit("region"), F.col("custom")))
    declared = rows.select("workflow_id", names.alias("name"))
    return corpus.variable_findings(rows, ["workflow_id", "node_id"], "content", declared, ["workflow_id"])


@query(
    "substitute_params",
    """SELECT p_partkey, replace(replace(p_name, 'red', '<c>'), 'small', '<s>') AS name FROM part""",
)
def substitute_params(spark, sf):
    name = corpus.substitute(F.col("p_name"), {"red": "<c>", "small": "<s>"})
    return table(spark, sf, "part").select("p_partkey", name.alias("name"))


@query(
    "table_refs",
    f"""{_TURNS} SELECT DISTINCT node_id, split_part(replace(n, '`', ''), '.', -1) AS table_name
        FROM (SELECT node_id, unnest(regexp_extract_all(content, '(?i)\\b(?:from|join|into)\\s+([`a-zA-Z_][\\w.$]*)', 1)) AS n FROM t)""",
)
def table_refs(spark, sf):
    return corpus.table_references(turns(spark, sf), ["node_id"], F.col("content"))


@query(
    "reserved_tokens",
    """SELECT DISTINCT doc_id, token FROM (
         SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9_]+')) AS token FROM documents)
       WHERE token IN ('the', 'and', 'of')""",
)
def reserved_tokens(spark, sf):
    return corpus.reserved_words(table(spark, sf, "documents"), "doc_id", "text", ["the", "and", "of"])


@query(
    "partition_findings",
    f"""{_TURNS} SELECT workflow_id, node_id, 'pt' AS partition_column FROM t WHERE contains(content, ' PARTITION (pt=')""",
)
def partition_findings(spark, sf):
    rows = turns(spark, sf).select("workflow_id", "node_id", corpus.partition_column(F.col("content")).alias("partition_column"))
    return rows.where(F.col("partition_column").isNotNull())


@query(
    "drop_lines",
    """SELECT doc_id, CAST(len(list_filter(l, lambda x: NOT regexp_matches(x, '(?i)^\\s*(The)'))) AS BIGINT) AS n_kept,
              CAST(len(list_filter(l, lambda x: regexp_matches(x, '(?i)^\\s*(The)'))) AS BIGINT) AS n_dropped,
              md5(array_to_string(list_filter(l, lambda x: NOT regexp_matches(x, '(?i)^\\s*(The)')), chr(10))) AS kept_md5
       FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)""",
)
def drop_lines(spark, sf):
    rows = corpus.drop_lines(table(spark, sf, "documents"), ["doc_id"], "text", ["The"])
    return rows.select("doc_id", "n_kept", "n_dropped", F.md5("kept_text").alias("kept_md5"))


_KINDS = r"""CASE WHEN regexp_matches(s, '^CREATE\s+TABLE\b') THEN 'create'
       WHEN regexp_matches(s, '^INSERT\s+(OVERWRITE\s+TABLE|INTO)\b') THEN 'insert'
       WHEN regexp_matches(s, '^DROP\s+TABLE\b') THEN 'drop_table'
       WHEN regexp_matches(s, '^TRUNCATE\s+TABLE\b') THEN 'truncate_table'
       WHEN regexp_matches(s, '^(CREATE\s+EXTERNAL|ALTER)\s+TABLE\b') THEN 'other' ELSE 'query' END"""
_BARE = r"""regexp_replace(content || chr(10) || 'SELECT '';'' FROM t;' || chr(10) || ';', '''[^'']*''|"[^"]*"', '''''', 'g')"""


@query(
    "statement_kinds",
    f"""{_TURNS}, p AS (SELECT node_id, upper(trim(s, chr(32) || chr(10) || chr(9) || chr(13))) AS s FROM (
           SELECT node_id, unnest(string_split({_BARE}, ';')) AS s FROM t)),
         k AS (SELECT node_id, {_KINDS} AS kind FROM p WHERE s <> '')
       SELECT node_id, """
    + ", ".join(
        f"CAST(COUNT(*) FILTER (WHERE kind = '{n}') AS BIGINT) AS n_{n}"
        for n in ("create", "insert", "drop_table", "truncate_table", "other", "query")
    )
    + " FROM k GROUP BY node_id",
)
def statement_kinds(spark, sf):
    # A quoted semicolon and an empty statement follow every script.
    more = F.concat("content", F.lit("\nSELECT ';' FROM t;\n;"))
    return corpus.statement_kinds(turns(spark, sf).withColumn("content", more), ["node_id"], "content")
