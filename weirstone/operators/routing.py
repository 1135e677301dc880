"""Routing by a table of rules that users keep as rows.

A rule has ``priority``, ``command`` (null: any), ``test`` and ``marker`` of the text, ``target``
and ``reason``.  ``test`` is ``head`` (the text starts with the marker), ``holds`` (the marker is in
it) or null (no test).  ``nocase head`` and ``nocase holds`` ignore the case of both, and the
former the blanks before the text as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.operators.joins import map_side_join
from weirstone.session import materialise

TESTS = ("head", "holds", "nocase head", "nocase holds")
_BLANKS = " \t\n\x0b\x0c\r"


def unknown_tests(rules: DataFrame) -> DataFrame:
    """Rules whose test is none of the known ones, or lacks its marker: they never hold."""
    known = F.col("test").isNull() | (F.col("test").isin(*TESTS) & F.col("marker").isNotNull())
    return rules.where(~known)


def route(nodes: DataFrame, rules: DataFrame, command: str, text: str) -> DataFrame:
    """``nodes`` with ``target`` and ``reason`` of the first rule that holds, null where none does.

    Of the rules of one priority the first by marker counts; a null text is empty, and a null command
    has no rule.  The rules of a command become one ordered list, those for any command another.  The
    lists are made from the rules alone and stored, so their size is known: they are sent to every task if they
    are small, and nodes are neither copied nor shuffled; larger ones are joined by command.
    """
    texts = [F.col(c).cast("string").alias(c) for c in ("marker", "test")]
    rule = F.struct("priority", *texts, "target", "reason")
    ordered = F.sort_array(F.collect_list(rule)).alias("_rules")
    lists = materialise(rules.groupBy(F.col("command").cast("string").alias("_command")).agg(ordered), "rules")
    named = lists.where("_command IS NOT NULL")
    general = lists.where("_command IS NULL").agg(F.flatten(F.collect_list("_rules")).alias("_general"))
    # one row, which every task needs whole; its key is 0, as that of every node
    general = general.withColumn("_any", F.pmod(F.size("_general").cast("bigint"), F.lit(1)))
    own = nodes.withColumn("_command", F.col(command).cast("string"))
    keyed = map_side_join(own, named, ["_command"], "left").withColumn("_any", F.pmod(F.xxhash64("_command"), F.lit(1)))
    joined = keyed.join(F.broadcast(general), "_any", "left")
    body = F.coalesce(F.col(text), F.lit(""))
    first = [F.get(F.filter(c, lambda r: _holds(r, body)), 0) for c in ("_rules", "_general")]
    held = F.when(F.col("_command").isNotNull(), F.least(*first))  # in the order of the lists; nulls are skipped
    return joined.withColumns({"target": held["target"], "reason": held["reason"]}).drop("_command", "_any", "_rules", "_general")


def _holds(rule: Column, body: Column) -> Column:
    test, marker = rule["test"], rule["marker"]
    return F.coalesce(
        F.when(test.isNull(), F.lit(True))
        .when(test == "head", F.startswith(body, marker))
        .when(test == "holds", F.contains(body, marker))
        .when(test == "nocase head", F.startswith(F.lower(F.ltrim(body, F.lit(_BLANKS))), F.lower(marker)))
        .when(test == "nocase holds", F.contains(F.lower(body), F.lower(marker))),
        F.lit(False),
    )
