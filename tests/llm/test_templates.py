from cases import clashing, frame, hard_texts, prose
import corpus_pipeline
from weirstone.llm import templates


def run(df):
    rows = templates.drop_templates(df).select("row.doc_id", "text", "n_lines", "n_dropped").collect()
    return {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in rows}


def logs(n=12):
    names = ["ann", "bob", "cyd", "dan", "eve", "fay", "gus", "hal", "ida", "jon", "kim", "lee", "max"]
    return [
        f"{prose(500 + k, 30, 10)}\nPosted on the board by {names[k]} at {k}:3{k % 10}\nonly here {prose(600 + k, 9, 99)}\n\nAll rights reserved."
        for k in range(n)
    ]


def test_fields_are_generalised(spark):
    texts = logs()
    out = run(frame(spark, texts))
    for i, t in enumerate(texts, 1):
        lines = t.split("\n")
        gone = [] if i == 1 else [x for x in lines if x.startswith(("Posted on", "All rights"))]
        kept = [x for x in lines if x not in gone]
        assert out[i] == ("\n".join(kept), len(lines), len(gone))


def test_too_few_documents(spark):
    texts = logs(templates.MIN_DOCS - 1)
    assert all(n == 0 and text == texts[i - 1] for i, (text, _, n) in run(frame(spark, texts)).items())


def test_hard_rows(spark):
    texts = [*hard_texts(), *[hard_texts()[0]] * 12]
    df = frame(spark, texts)
    out = run(clashing(df))
    assert out[1][0] == texts[0] and out[1][2] == 0  # the first of the copies keeps its text
    assert out[2][0] == "" and out[20][2] == out[20][1]
    assert out[5] == (None, 0, 0) and out[6] == ("", 1, 0) and out[7] == (" \t\n ", 2, 0)
    assert out[12][0] == texts[11]  # a line that repeats in one document only
    twice = templates.drop_templates(df.union(df).union(spark.sql("SELECT NULL, 'x y z', 'en', 'a', 5L")))
    assert twice.count() == 2 * len(texts) + 1
    got = {(r[0], r[1], r[2], r[3]) for r in twice.select("row.doc_id", "text", "n_lines", "n_dropped").collect()}
    assert len(got) == len(texts) + 1
    assert run(frame(spark, [])) == {}


def test_columns_stay(spark):
    df = clashing(frame(spark, hard_texts()))
    assert templates.drop_templates(df).select("row.*").columns == df.columns


def test_long_lines_repeat_from_two_documents(spark, sf):
    shared, short = prose(900, 60, 99) + " 7 of 9", prose(901, 9, 99)
    own = [prose(910 + k, 40, 99) for k in range(3)]
    texts = [
        f"{own[0]}\n{shared}\n{short}\n{shared}",
        f"{shared}\n{own[1]}\n{short}",
        f"{own[2]}\n{own[2]}",  # twice in one document only
        shared,
    ]
    out = corpus_pipeline.lines(spark, frame(spark, texts), sf).collect()
    assert {r.doc_id: r.text for r in out} == {1: f"{own[0]}\n{shared}\n{short}", 2: f"{own[1]}\n{short}", 3: texts[2]}
    assert all(n == 0 for _, _, n in run(frame(spark, texts)).values())  # as in the query's SQL
