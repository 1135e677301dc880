"""The corpus pipeline: stages over documents, each written and read again by the next.

Quality rules reject documents; recurring line templates and long lines that
repeat word for word are dropped, and documents that are left without a word
with them; of near duplicates the smallest id stays; sources are mixed to their target weights, so a document may
then be there several times; every text becomes token ids.  All stages but the
last keep the columns of documents; ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.llm import bpe, jaccard, mixing, quality_rules, templates
from weirstone.llm.common import SPACES, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the trusted texts accept."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without recurring line templates and repeated long lines; a document that is nothing else goes."""
    done = templates.drop_templates(docs, exact=True)
    left = (F.col("n_dropped") == 0) | (F.length(F.translate("text", SPACES, "")) > 0)
    kept = done.where(left)
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("row.n_chars"))}
    return kept.select(*(new.get(f.name, F.col("row")[f.name]).cast(f.dataType).alias(f.name) for f in docs.schema))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group."""
    return jaccard.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the hash of the bytes that they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.decode(bpe.encode(docs, path, pattern), path, pattern)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_templates", lines),
    ("jaccard_join", near_duplicates),
    ("source_mixing", mixture),
    ("byte_bpe", tokens),
]

# The tokens of the last stage are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
