"""The dealt operators bound to the test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.llm import (
    bpe,
    chat,
    cnn,
    crosspoly,
    hnsw,
    jaccard,
    mixing,
    periods,
    phrases,
    quality_rules,
    suffixes,
    surrogates,
    templates,
)
from weirstone.llm.common import table
from weirstone.llm.registry import CHECKS, QUERIES, query  # noqa: F401

RANK_FILE = "byte_bpe_50k.tiktoken"
SURROGATE_KEY = b"key of the test tables"


@query("op1_surrogates")
def op1_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    done = surrogates.pseudonymise(docs, SURROGATE_KEY)
    return done.select(F.col("row.doc_id").alias("doc_id"), "text", "n_entities")


TEMPLATE_SQL = r"""
WITH l AS (
  SELECT doc_id, md5(text) AS m, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT doc_id, m, pos, words, len(words) AS k, words[1:3] AS lead FROM (
    SELECT doc_id, m, pos, list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'),
           lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS words
    FROM l) WHERE len(words) > 0
), d AS (
  SELECT words, k, lead, count(DISTINCT (doc_id, m)) AS n FROM w GROUP BY ALL
), s AS (
  SELECT words, k, lead, n, unnest(words) AS word, unnest(range(k)) AS place FROM d
), c AS (
  SELECT k, lead, place, word FROM s GROUP BY ALL HAVING sum(n) >= 10
), t AS (
  SELECT s.words, list(c.word ORDER BY s.place) AS template,
         count(*) FILTER (c.word IS NOT NULL AND s.word <> '<*>') AS constants, count(*) FILTER (s.word <> '<*>') AS plain
  FROM s LEFT JOIN c ON s.k = c.k AND s.lead = c.lead AND s.place = c.place AND s.word = c.word
  GROUP BY s.words
), p AS (
  SELECT doc_id, m, pos, k, lead, template FROM w JOIN t USING (words) WHERE plain > 0 AND 100 * constants >= 75 * plain
), r AS (
  SELECT k, lead, template, min((doc_id, pos)) AS head FROM p GROUP BY ALL HAVING count(DISTINCT (doc_id, m)) >= 10
), x AS (
  SELECT doc_id, m, list(pos) AS gone FROM p JOIN r USING (k, lead, template) WHERE (doc_id, pos) <> head GROUP BY ALL
)
SELECT a.doc_id,
       CASE WHEN gone IS NULL THEN text ELSE coalesce(array_to_string(list_filter(string_split(text, chr(10)),
            lambda line, i: NOT list_contains(gone, i - 1)), chr(10)), '') END AS text,
       coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_dropped
FROM documents a LEFT JOIN x ON a.doc_id = x.doc_id AND md5(a.text) = x.m
"""


@query("op2_line_templates", TEMPLATE_SQL)
def op2_line_templates(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return templates.drop_templates(docs).select(F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_dropped")


CHAT_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) AS n_text,
         length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;')) AS n_role
  FROM c
)
SELECT conv_id::BIGINT AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(12 + n_role + 1 + n_text + 11)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op3_chat_format", CHAT_SQL)
def op3_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    own = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    chats = chat.format_chats(turns.withColumn("parts", chat.text_part(F.col("text"))))
    read = chats.select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query("op4_cross_polytope")
def op4_cross_polytope(spark: SparkSession, sf: str) -> DataFrame:
    found = crosspoly.link(table(spark, sf, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality_rules.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return rows.select(
        F.col("row.doc_id").alias("doc_id"),
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        *("base_failed", "kept", "score"),
    )


@query("op6_byte_cnn")
def op6_byte_cnn(spark: SparkSession, sf: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    docs = table(spark, sf, "documents").select("doc_id", "text")
    weights = cnn.fit(docs, table(spark, sf, "labels"), ~held_out)
    return cnn.score(docs, weights).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path, pattern = public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, sf, "documents"), path, pattern)
    return bpe.decode(encoded, path, pattern).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    done = suffixes.remove_repeats(table(spark, sf, "documents"))
    return done.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM d GROUP BY source
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER f, 0))::DOUBLE
            / (sum(w) OVER () - coalesce(sum(w) OVER f, 0))::DOUBLE AS x
  FROM s WINDOW f AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, max(x) OVER () * w) AS target,
         ('0x' || substr(md5('mix' || coalesce(':' || source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM l
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS i
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * least(floor(i * rate + u) - floor((i - 1) * rate + u), 3))::BIGINT AS taken
FROM r
"""


@query("op9_source_mixing", MIX_SQL)
def op9_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    rows = mixing.allot(table(spark, sf, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@query("op10_jaccard_join")
def op10_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    found = jaccard.near_duplicates(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


PHRASE_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM (SELECT lang, unnest(pieces) AS piece FROM d)
), s AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w WHERE len(words) > 0
), g AS (
  SELECT lang, k, words[i : i + k - 1] AS p FROM s, range(1, 6) r(k) WHERE i + k - 1 <= len(words)
), t AS (
  SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang HAVING sum(len(words)) > 0
), f AS (
  SELECT lang, k, p, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100
), c AS (
  SELECT f.lang, f.k, f.p, f.a, t.n, cut, l.a AS l, r.a AS r, (1000::HUGEINT * f.a * t.n) // (l.a::HUGEINT * r.a) AS score
  FROM f JOIN t USING (lang), range(1, 5) x(cut)
  JOIN f l ON l.lang = f.lang AND l.p = f.p[1 : cut] JOIN f r ON r.lang = f.lang AND r.p = f.p[cut + 1 : f.k]
  WHERE f.k > 1 AND cut < f.k
), b AS (
  SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
), o AS (
  SELECT lang, unnest([p[i : i + k - 2] for i in [1, 2]]) AS p, a FROM f WHERE k > 2
), m AS (
  SELECT lang, p, max(a) AS most FROM o GROUP BY ALL
)
SELECT * FROM (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.p, ' ')) AS rank,
         array_to_string(b.p, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
  FROM b LEFT JOIN m ON m.lang = b.lang AND m.p = b.p WHERE most IS NULL OR 100 * most < 100 * a)
WHERE rank <= 2000
"""


@query("op11_phrases", PHRASE_SQL)
def op11_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents"))


@query("op13_periods")
def op13_periods(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("key")
    )
    found = periods.text_runs(docs, "key")
    return found.select(
        F.col("id").alias("doc_id"), "n_runs", "start", "length", "period",
        F.expr("(1000 * length) div period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


@query("op12_hnsw")
def op12_hnsw(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return hnsw.search(hnsw.build_index(vectors), vectors.where("vec_id % 100 = 0"))
