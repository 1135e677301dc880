import hashlib
import random

import numpy as np
import public_tokenizers as public
import pytest

from cases import clashing, frame, hard_texts
from weirstone.llm import bpe

PATH, PATTERN = public.path("byte_bpe_50k.tiktoken"), public.PATTERN


@pytest.fixture(scope="module")
def enc():
    return bpe.encoder(bpe.read_ranks(PATH), PATTERN)


def test_round_trip_and_ids(spark, enc):
    texts = [*hard_texts(), "a" + " " * 5000 + "b", "\n" * 3000, "<|endoftext|> it's", " " * 1_500_000 + "x"]
    out = bpe.decode(bpe.encode(clashing(frame(spark, texts)), PATH, PATTERN), PATH, PATTERN).collect()
    assert len(out) == len(texts)
    for r in out:
        text = texts[r.doc_id - 1] or ""
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert bytes(r.decoded) == text.encode() and r.n_tokens == len(ids)
        if len(text) < 1_000_000:
            assert ids == enc.encode_ordinary(text)


def test_cuts_change_nothing(enc):
    rng = random.Random(2)
    letters = "ab 'sé\n\t1!ñ　 \x1c᠎ "
    for _ in range(1500):
        text = "".join(rng.choice(letters) * rng.choice([1, 1, 2, 3]) for _ in range(rng.randrange(300)))
        cut = list(bpe.pieces(text, 20))
        assert "".join(cut) == text
        assert sum((enc.encode_ordinary(p) for p in cut), []) == enc.encode_ordinary(text)


def test_long_white_space(enc):
    for text in ("a" + " " * 3000 + "b" + "\n" * 2000, "\n" * 1500 + "x", " " * 1001 + "!" + "\t" * 1000 + "d e" * 300):
        assert bpe.encode_text(enc, text) == enc.encode_ordinary(text)


def test_null_ids_and_empty_table(spark):
    assert bpe.encode(frame(spark, []), PATH, PATTERN).count() == 0
    df = spark.createDataFrame([(1, None)], "doc_id bigint, ids binary")
    assert bpe.decode(df, PATH, PATTERN).first().decoded is None


def test_query(spark, sf, enc):
    from weirstone.llm.queries import QUERIES

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op7_byte_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = enc.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
