import re
from collections import defaultdict

import pytest

import corpus_pipeline as P


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Each stage's input and output rows, on what the stage before has kept."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    columns = docs.columns
    for name, f in P.STAGES:
        made = f(spark, docs, sf).cache()
        out[name] = (docs.collect(), made.collect(), made.columns)
        docs = made
    assert all(out[name][2] == columns for name, _ in P.STAGES[:-1])
    return {k: v[:2] for k, v in out.items()}


def test_order():
    assert [n for n, _ in P.STAGES] == ["language_id", "near_duplicates", "pii", "mixing", "packing"]


def test_language_stage(stages):
    before, after = stages["language_id"]
    assert set(after) <= set(before)
    gone = set(before) - set(after)
    assert all(not any(c.isalpha() for c in r.text or "") for r in gone)


def test_near_duplicate_stage(stages):
    from test_chosen_path import brute

    before, after = stages["near_duplicates"]
    _, classes = brute([r.doc_id for r in before], [r.text for r in before])
    assert {r.doc_id for r in after} == set(classes) and len(after) == len(set(classes))


def test_near_duplicates_with_repeated_ids(spark, make_docs):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(5, a), (5, a + " x"), (5, b), (5, b), (6, b + " y"), (None, a + " z"), (None, "c d e f g h"), (None, "c d e f g h"), (7, ""), (7, ""), (8, None), (9, "alone in here"), (9, "alone too")]
    made = P.keep_one_of_near_copies(spark, make_docs(rows), "").collect()
    texts = sorted((str(r.doc_id), str(r.text)) for r in made if r.text not in (a, a + " x"))
    assert texts == sorted([("5", b), ("None", "c d e f g h"), ("7", ""), ("7", ""), ("8", "None"), ("9", "alone in here"), ("9", "alone too")])
    assert sum(r.text in (a, a + " x") for r in made) == 1


def test_pii_stage(stages):
    before, after = stages["pii"]
    old = {r.doc_id: r for r in before}
    assert len(after) == len(before)
    for r in after:
        for mail in re.findall(r"[\w.]+@mail\d*\.example\.com", old[r.doc_id].text):
            assert mail not in r.text
        assert r.n_chars == len(r.text) and (r.lang, r.source) == (old[r.doc_id].lang, old[r.doc_id].source)


def test_mixing_stage(stages):
    from test_mixing import brute

    before, after = stages["mixing"]
    want = brute([(r.doc_id, r.text, r.source) for r in before])
    times = defaultdict(int)
    for r in after:
        times[r.doc_id] += 1
    assert times == {i: w[3] // w[0] for i, w in want.items() if w[3]}


def test_packing_stage(stages):
    before, after = stages["packing"]
    pieces = defaultdict(int)
    for r in after:
        pieces[r.doc_id] += r.piece == 0
    times = defaultdict(int)
    for r in before:
        times[r.doc_id] += 1
    assert pieces == times


def test_run(spark, sf, stages):
    rows = P.run(spark, sf).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, stages["packing"][1]))


def test_odd_rows(spark, odd_docs, clashing):
    docs = clashing(odd_docs)
    for name, f in P.STAGES:
        made = f(spark, docs, "").cache()
        made.count()
        assert name == "packing" or made.columns == docs.columns
        docs = made
    for _, f in P.STAGES:
        assert f(spark, odd_docs.limit(0), "").collect() == []


def test_language_stage_rejects_what_no_language_explains(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    russian = "Вчера вечером мы долго гуляли по старому городу и говорили о погоде, книгах и о том, что будет завтра. "
    chinese = "昨天晚上我们在老城里散步了很久谈论天气书籍以及明天会发生什么事情"
    random_letters = "xqzjvkw pqxzrtg wvkjqxz bzxqkjw gqpvzxk jwqxvkz rtzqxwv kqjzxvw " * 4
    texts = {-1: russian, -2: chinese, -3: random_letters}
    short = {-10 - k: " ".join(r.text.split()[3:7]) for k, r in enumerate(docs.where("lang is not null and length(text) > 400").limit(40).collect())}
    odd = spark.createDataFrame([(k, t) for k, t in {**texts, **short}.items()], "doc_id long, text string")
    all_docs = docs.unionByName(odd.withColumn("doc_id", odd.doc_id.cast(docs.schema["doc_id"].dataType)), allowMissingColumns=True)
    kept = {r.doc_id for r in P.keep_known_language(spark, all_docs, sf).select("doc_id").collect()}
    assert not kept & set(texts)
    assert set(short) <= kept
