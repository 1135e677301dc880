"""Hard documents for every operator: nulls, empty and long texts, ties, copies, clashing extra columns."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, words: int, line: int = 12) -> str:
    rng = random.Random(seed)
    parts = ["ar", "bel", "con", "dur", "el", "fin", "gro", "hal", "is", "jun", "kel", "lom", "mer", "nor"]
    out = []
    for i in range(words):
        out.append("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))))
        out.append("\n" if i % line == line - 1 else " ")
    return "".join(out).strip()


def hard_texts() -> list:
    base = prose(1, 200)
    return [
        base,
        base,  # a copy
        base.replace("bel", "BEL", 1),
        prose(2, 60),
        None,
        "",
        " \t\n ",
        "one two three",
        "ein Straße Ünïcödé 漢字 😀 words " * 20,
        "Thhaen " * 80,
        ("A!! B!! C## D$$ <x> | " * 30).strip(),
        "same line here\n" * 40 + prose(3, 60),
        prose(4, 6000),  # a long text
        "x" * 70_000,  # one long word
        "last line\n\n\nlast line\r\nlast line",
    ]


def frame(spark, texts, sources=("a", "b", None)):
    rows = [(i + 1, t, "en", sources[i % len(sources)], None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS)


def clashing(df):
    """Extra columns with names that an operator may use itself."""
    from pyspark.sql import functions as F

    for name in ("_id", "_text", "_row", "row", "_words", "size", "ids", "n_tokens", "kept", "id", "score", "_at", "copies"):
        df = df.withColumn(name, F.lit("own"))
    return df
