"""Findings over a table of scripts.

A script is one row, so counts and lists per script are computed inside the
row; only joins with other tables move data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.functions.names import last_part
from weirstone.functions.rules import RENAMED_FUNCTIONS, RESERVED_WORDS, REVIEWED_FUNCTIONS
from weirstone.functions.rundate import DATE_VARIABLES

# The forms of variables, table references and partition clauses in scripts.
BRACE_VARIABLE = r"\$\{(\w+)\}"
BRACKET_VARIABLE = r"\$\[([A-Za-z_]\w*(?:\s*[+-]\d+)?)\]"
TABLE_REFERENCE = r"(?i)\b(?:from|join|into)\s+([`a-zA-Z_][\w.$]*)"
PARTITION_CLAUSE = r"(?i)PARTITION\s*\(\s*(\w+)\s*="
# Statement parts after the dialect's grammar: a write, the query that it takes its rows from, a new table.
WRITE_TAIL = r"(?is)\binsert\s+(?:into|overwrite)\b(.*)$"
QUERY_TAIL = r"(?is)\b((?:with|select)\b.*)$"
NEW_TABLE = r"(?i)\bcreate\s+(?:\w+\s+)?table\s+(?:if\s+not\s+exists\s+)?(`?\w[\w$]*`?(?:\.`?\w[\w$]*`?)*)"
HINT = r"(?s)/\*\+.*?\*/"
LATERAL_VIEW = r"(?i)\blateral\s+view\b"
# Line starts that are directives or comments to leave out.
DIRECTIVE_PREFIXES = (r"SET\s", r"USE\s", "--#", "#")
_QUOTED = "'[^']*'|\"[^\"]*\""
# Statement kinds by the words a statement starts with, first match first.
STATEMENT_KINDS = (
    ("create", r"^CREATE\s+TABLE\b"),
    ("insert", r"^INSERT\s+(OVERWRITE\s+TABLE|INTO)\b"),
    ("drop_table", r"^DROP\s+TABLE\b"),
    ("truncate_table", r"^TRUNCATE\s+TABLE\b"),
    ("other", r"^(CREATE\s+EXTERNAL|ALTER)\s+TABLE\b"),
)


def called_names(text: Column, case_sensitive: bool = False) -> Column:
    """Names directly before an opening bracket; a dotted name is one name."""
    source = text if case_sensitive else F.upper(text)
    return F.regexp_extract_all(source, F.lit(r"([\w.]+)\s*\("), F.lit(1))


def words(text: Column) -> Column:
    """Lower-case runs of letters, digits, underscores and dots."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\w.]+)"), F.lit(1))


def _counts(tokens: Column, wanted: Sequence[str], kinds: Mapping[str, str] | None = None) -> Column:
    def entry(word: str) -> Column:
        n = F.size(F.filter(tokens, _equals(word))).cast("bigint")
        kind = (kinds or {}).get(word, "")
        return F.struct(F.lit(word).alias("token"), F.lit(kind).alias("action"), n.alias("n"))

    return F.filter(F.array(*[entry(w) for w in wanted]), lambda e: e["n"] > 0)


def _equals(word: str):
    return lambda x: x == word


def token_usage(texts: DataFrame, key: str, text: str, wanted: Sequence[str]) -> DataFrame:
    """Occurrences of given words per text, words that occur only."""
    tokens = F.filter(words(F.col(text)), lambda t: t.isin(*wanted))
    hits = texts.select(key, tokens.alias("t"))
    return hits.select(key, F.inline(_counts(F.col("t"), wanted))).drop("action")


def function_usage(scripts: DataFrame, key: str, text: str, case_sensitive: bool = False) -> DataFrame:
    """Calls per script of functions that are renamed or that need a review."""
    kinds = {name: "rename" for name in RENAMED_FUNCTIONS} | {name: "review" for name in REVIEWED_FUNCTIONS}
    tokens = F.filter(called_names(F.col(text), case_sensitive), lambda t: t.isin(*kinds))
    # LATERAL VIEW has no bracket behind LATERAL
    source = F.col(text) if case_sensitive else F.upper(F.col(text))
    lateral = F.transform(
        F.regexp_extract_all(source, F.lit(r"\bLATERAL\s+VIEW\b"), F.lit(0)), lambda _: F.lit("LATERAL")
    )
    hits = scripts.select(key, F.concat(tokens, lateral).alias("t"))
    return hits.select(key, F.inline(_counts(F.col("t"), list(kinds), kinds)))


def variable_use_list(text: Column) -> Column:
    """Distinct variable uses in a text: form (brace or bracket), name, day offset."""

    def uses(pattern: str, form: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        return F.transform(
            found,
            lambda u: F.struct(
                F.lit(form).alias("form"),
                F.regexp_extract(u, r"^(\w+)", 1).alias("name"),
                F.replace(F.regexp_extract(u, r"([+-]\d+)$", 1), F.lit("+"), F.lit("")).try_cast("int").alias("day_offset"),
            ),
        )

    return F.array_distinct(F.concat(uses(BRACE_VARIABLE, "brace"), uses(BRACKET_VARIABLE, "bracket")))


def variable_status(uses: DataFrame, declared: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Status per variable use: resolved, unresolved, or offset_not_allowed.

    ``uses`` has ``name`` and ``day_offset``; ``declared`` has ``name`` per ``scope``.
    """
    known = declared.select(*scope, "name").distinct().withColumn("_known", F.lit(True))
    status = (
        F.when(F.col("_known").isNull(), "unresolved")
        .when(F.col("day_offset").isNotNull() & ~F.col("name").isin(*DATE_VARIABLES), "offset_not_allowed")
        .otherwise("resolved")
    )
    return uses.join(known, [*scope, "name"], "left").withColumn("status", status).drop("_known")


def variable_findings(
    scripts: DataFrame, keys: Sequence[str], text: str, declared: DataFrame, scope: Sequence[str] = ()
) -> DataFrame:
    """Variables of each script with their status; ``scope`` are columns of ``keys``."""
    uses = scripts.select(*keys, F.inline(variable_use_list(F.col(text))))
    return variable_status(uses, declared, scope).select(*keys, "form", "name", "day_offset", "status")


def unresolved_references(refs: DataFrame, declared: DataFrame, name: str) -> DataFrame:
    """References whose name is not declared."""
    return refs.join(declared.select(name).distinct(), name, "left_anti")


def substitute(text: Column, values: Mapping[str, str]) -> Column:
    """Replace every given text by its value, in the given order."""
    for old, new in values.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def clean_script(text: Column) -> Column:
    """The script without directive and comment lines and without hints."""
    lines = F.filter(F.split(text, "\n"), lambda line: ~line.rlike(_directive()))
    return F.regexp_replace(F.array_join(lines, "\n"), HINT, "")


def directives(text: Column) -> Column:
    """Kinds of the directive lines of a script (SET, USE), each once, in upper case."""
    heads = F.transform(F.split(text, "\n"), lambda line: F.upper(F.regexp_extract(line, r"(?i)^\s*(SET|USE)\s", 1)))
    return F.array_distinct(F.filter(heads, lambda h: h != ""))


def insert_body(text: Column) -> Column:
    """The query that an INSERT takes its rows from, without the closing semicolon; blank if none."""
    query = F.regexp_extract(F.regexp_extract(text, WRITE_TAIL, 1), QUERY_TAIL, 1)
    return F.regexp_replace(query, r"[\s;]+$", "")


def created_table(text: Column) -> Column:
    """Name of the first table that a script creates, without quotes; null if none."""
    return F.nullif(F.replace(F.regexp_extract(text, NEW_TABLE, 1), F.lit("`"), F.lit("")), F.lit(""))


def reviewed_calls(text: Column) -> Column:
    """Functions that need a review, each once, in any case; LATERAL for LATERAL VIEW."""
    lateral = F.when(text.rlike(LATERAL_VIEW), F.array(F.lit("LATERAL"))).otherwise(F.array().cast("array<string>"))
    wanted = F.array(*[F.lit(w) for w in REVIEWED_FUNCTIONS])
    return F.array_union(F.array_intersect(called_names(text), wanted), lateral)


def table_references(scripts: DataFrame, keys: Sequence[str | Column], text: Column) -> DataFrame:
    """Distinct tables read per script, by their last name part."""
    names = F.transform(
        F.regexp_extract_all(text, F.lit(TABLE_REFERENCE), F.lit(1)),
        lambda n: last_part(F.replace(n, F.lit("`"), F.lit(""))),
    )
    return scripts.select(*keys, F.explode(F.array_distinct(names)).alias("table_name"))


def reserved_words(scripts: DataFrame, key: str, text: str, reserved: Sequence[str] = RESERVED_WORDS) -> DataFrame:
    """Reserved words that occur as identifiers, one row per script and word."""
    tokens = F.split(F.lower(F.col(text)), "[^a-z0-9_]+")
    found = F.array_intersect(tokens, F.array(*[F.lit(w) for w in reserved]))
    return scripts.select(key, F.explode(found).alias("token"))


def partition_column(text: Column) -> Column:
    """Column of a PARTITION clause; null if there is none."""
    return F.nullif(F.regexp_extract(text, PARTITION_CLAUSE, 1), F.lit(""))


def _directive(prefixes: Sequence[str] = DIRECTIVE_PREFIXES) -> str:
    return r"(?i)^\s*(" + "|".join(prefixes) + ")"


def drop_lines(scripts: DataFrame, keys: Sequence[str], text: str, prefixes: Sequence[str]) -> DataFrame:
    """Script without the lines that start with a prefix, and how many were dropped.

    Leading blanks and case of a line do not count.
    """
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda line: ~line.rlike(_directive(prefixes)))
    return scripts.select(
        *keys,
        F.array_join(kept, "\n").alias("kept_text"),
        F.size(kept).cast("bigint").alias("n_kept"),
        (F.size(lines) - F.size(kept)).cast("bigint").alias("n_dropped"),
    )


def statement_kinds(scripts: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Statements per kind for each script; quoted semicolons do not end a statement."""
    bare = F.regexp_replace(F.col(text), _QUOTED, "''")
    statements = F.filter(F.transform(F.split(bare, ";"), lambda s: F.upper(F.trim(s, F.lit(" \n\t\r")))), lambda s: s != "")

    def kind(s: Column) -> Column:
        result = F.lit("query")
        for name, pattern in reversed(STATEMENT_KINDS):
            result = F.when(s.rlike(pattern), name).otherwise(result)
        return result

    kinds = F.transform(statements, kind)
    staged = scripts.select(*keys, kinds.alias("k"))
    names = [name for name, _ in STATEMENT_KINDS] + ["query"]
    return staged.select(
        *keys,
        *[F.size(F.filter("k", _equals(name))).cast("bigint").alias(f"n_{name}") for name in names],
    )
