import hashlib
from collections import defaultdict

import duckdb
import pytest

from eventframe.llm import mixing
from eventframe.llm.oracles import MIXING
from eventframe.llm.queries import op8_source_mixing


def fill(sizes, weights, share=1.5, most=2):
    """Targets by rounds, as the words of the rule have it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        per = left / sum(w[s] for s in open_)
        over = {s for s in open_ if per * w[s] > most * sizes[s]}
        if not over:
            return target | {s: per * w[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 100, "b": 1, "c": 50, None: 7}, {"x": 5, "y": 5, "z": 5}, {"a": 0, "b": 9}, {"a": 1000, "b": 10, "c": 10, "d": 10, "é": 3, "Z": 500}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df, (3, 1, 2), 1.5, 2).collect()}
    assert got == pytest.approx(fill(sizes, (3, 1, 2)))


def brute(rows):
    sizes, words = defaultdict(int), {}
    for i, text, source in rows:
        words[i] = len((text or "").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split())
        sizes[source] += words[i]
    target = fill(dict(sizes), (3, 1, 2))
    queue = []
    for copy in (1, 2):
        at = defaultdict(int)
        for o, i, source in sorted((hashlib.md5(f"{i}:{copy}".encode()).hexdigest(), i, s) for i, _, s in rows):
            at[source] += words[i]
            if words[i]:
                queue.append((((copy - 1) * sizes[source] + at[source]) / target[source], o, i))
    taken, total = defaultdict(int), 0
    for _, _, i in sorted(queue):
        total += words[i]
        if total > sum(target.values()):
            break
        taken[i] += words[i]
    return {i: (words[i], sizes[s], target[s], taken[i]) for i, _, s in rows}


def test_against_brute_force(make_docs, clashing):
    rows = [(i, "w " * (i * 7919 % 83), ["a", "b", "c"][min(2, i % 5)]) for i in range(600)]
    docs = make_docs([(i, t, "en", s) for i, t, s in rows])
    want = brute(rows)
    got = mixing.mixed_counts(clashing(docs)).collect()
    assert len(got) == 600
    for r in got:
        w = want[r.doc_id]
        assert (r.size, r.source_size, r.taken) == (w[0], w[1], w[3]) and r.target == pytest.approx(w[2])
    rowed = defaultdict(int)
    for r in mixing.mixed_rows(clashing(docs)).collect():
        rowed[r.doc_id] += 1
    assert rowed == {i: w[3] // w[0] for i, w in want.items() if w[3]}


def test_query_against_sql(spark, sf):
    got = sorted(map(tuple, op8_source_mixing(spark, sf).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(MIXING).fetchall())
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])
    by = defaultdict(lambda: [0, 0.0])
    docs = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for i, size, _, target, taken in got:
        assert taken in (0, size, 2 * size)
        by[docs[i]][0] += taken
        by[docs[i]][1] = target
    longest = max(r[1] for r in got)
    assert all(abs(a - b) <= longest for a, b in by.values())


def test_odd_rows(odd_docs, clashing):
    got = mixing.mixed_counts(clashing(odd_docs)).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.taken <= 2 * r.size for r in got)
    assert sorted((r.size, r.taken) for r in got if r.size == 0) == [(0, 0)] * 4
    n = sum(r.taken // r.size for r in got if r.size)
    assert mixing.mixed_rows(odd_docs).count() == n
    assert mixing.mixed_rows(odd_docs).columns == odd_docs.columns
    assert mixing.mixed_counts(odd_docs.limit(0)).collect() == [] and mixing.mixed_rows(odd_docs.limit(0)).collect() == []


def test_many_repeated_rows(make_docs, monkeypatch):
    """Numbers of repeated rows are dealt in parts; repeated rows and rows without an id spread over the shuffled order."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    rows = [(7, "five words are in this", "en", "a")] * 333 + [(None, f"text {i} of no id", "en", "b") for i in range(120)] + [(i, "w " * (i % 9), "en", "a") for i in range(100, 200)]
    found, taken = mixing.mix_sources(make_docs(rows))
    found = found.collect()
    assert len(found) == len(rows) and len({r.row_key for r in found}) == len(rows)
    assert sorted(r.row_key.twin for r in found if r.id == 7) == list(range(1, 334))
    got = taken.collect()
    assert len({(r.row_key, r["copy"]) for r in got}) == len(got)
    for who in (lambda k: k.id == 7, lambda k: k.id is None):
        finish = [r.finish for r in got if who(r.row_key)]
        assert max(finish) - min(finish) > 0.5  # not in one bucket
    counts = mixing.mixed_counts(make_docs(rows)).collect()
    assert len(counts) == len(rows) and {r.doc_id: r.source_size for r in counts}[None] == 600
    by, target = defaultdict(int), {}
    for r in counts:
        by[r.source_size] += r.taken
        target[r.source_size] = r.target
    assert all(abs(by[s] - target[s]) <= 10 for s in by)
    assert mixing.mixed_rows(make_docs(rows)).count() == sum(r.taken // r.size for r in counts if r.size)
