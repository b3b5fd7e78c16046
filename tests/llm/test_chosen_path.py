import random
import re
from collections import defaultdict

import numpy as np
import pytest

from eventframe.llm import chosen_path as C
from eventframe.llm.queries import op3_chosen_path_join
from eventframe.llm.shingles import shingle_sets


def word_sets(texts, words=5):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        out.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    return out


def brute(ids, texts, threshold=0.8):
    """(links, class) per row, by an inverted index over true word tuples."""
    sets, inv = word_sets(texts), defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            inv[g].append(i)
    common = defaultdict(int)
    for rows in inv.values():
        for x in range(len(rows)):
            for y in range(x):
                common[rows[y], rows[x]] += 1
    links, root = [0] * len(ids), list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), c in common.items():
        if c >= threshold * (len(sets[a]) + len(sets[b]) - c):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    low = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return links, [low.get(find(i)) for i in range(len(ids))]


def compare(df, out):
    rows = df.select("doc_id", "text").collect()
    ids, texts = [r.doc_id for r in rows], [r.text for r in rows]
    links, classes = brute(ids, texts)
    key = lambda t: tuple(-1 if v is None else v for v in t)
    assert sorted((key((r.doc_id, r.n_links, r.class_id)) for r in out.collect())) == sorted(map(key, zip(ids, links, classes)))
    return links


def test_shingles_match_word_tuples():
    import pyarrow as pa

    texts = ["", "a", "a b", "a b c d e", "a b c d e f", "x\ty\n z\r\x0b\x0cw v", "w" * 60 + " " + "v" * 60 + " a b c d", "日本 語 a b c d", "a b c d e a b c d e f", " lead and trail "] * 3
    got = list(shingle_sets(pa.array(texts, pa.large_string()), chunk_bytes=40))
    assert [len(s) for s in got] == [len(s) for s in word_sets(texts)]
    assert got[3].tolist() == got[13].tolist() and not set(got[1].tolist()) & set(got[2].tolist())


def near(rng, words, share):
    return [w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in words]


@pytest.fixture(scope="module")
def copies(make_docs):
    rng = random.Random(5)
    passage = [f"p{k}" for k in range(80)]
    rows, n = [], 0
    for size in (8, 40, 150, 400):
        for group in (2, 3, 60):
            base = [f"w{rng.randrange(10**5)}" for _ in range(size)]
            for _ in range(group):
                rows.append((n, " ".join(near(rng, base, rng.choice([0, 0.005, 0.02, 0.05])))))
                n += 1
    for _ in range(60):
        rows.append((n, " ".join([f"w{rng.randrange(10**5)}" for _ in range(rng.randrange(3, 200))] + passage)))
        n += 1
    return make_docs(rows)


def test_all_links_found(copies):
    links = compare(copies, C.jaccard_classes(copies))
    assert sum(n > 0 for n in links) > 100


def test_blocks_give_the_same(copies, clashing):
    """Buckets and groups far over their block sizes, and a join in place of a broadcast."""
    old, C.BROADCAST_ROWS = C.BROADCAST_ROWS, 0
    try:
        compare(copies, C.jaccard_classes(clashing(copies), block_rows=7, set_block_rows=5))
    finally:
        C.BROADCAST_ROWS = old


def test_odd_rows(odd_docs):
    compare(odd_docs, C.jaccard_classes(odd_docs))
    assert C.jaccard_classes(odd_docs.limit(0)).collect() == []


def test_whole_table(spark, sf):
    assert any(compare(spark.read.parquet(f"{sf}/documents.parquet"), op3_chosen_path_join(spark, sf)))


def test_sql_says_the_same(sf):
    import duckdb

    from eventframe.llm.oracles import CHOSEN_PATH

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    ids, texts = zip(*con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall())
    links, classes = brute(list(ids), list(texts))
    assert sorted(con.execute(CHOSEN_PATH).fetchall()) == sorted(zip(ids, classes, links))


def test_tokens_estimate_similarity():
    rng = np.random.default_rng(0)
    for n in (12, 200, 600):
        gap = []
        for _ in range(60):
            s = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            a, b = np.unique(s[: int(n * 0.9)]), np.unique(np.r_[s[: int(n * 0.8)], s[int(n * 0.9) :]])
            make = C.bin_tokens if n >= C.DENSE else C.tokens
            gap.append((make(a) == make(b)).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(gap)) < 0.03


def test_paths_meet():
    """Two sets whose tokens agree in 4 of 5 places share a bucket with the target probability."""
    rng, runs = np.random.default_rng(2), C.runs_for(0.8, 0.9999)
    met = 0
    for _ in range(2000):
        a = rng.integers(0, 1 << 32, C.TOKENS, dtype=np.uint32)
        b = np.where(rng.random(C.TOKENS) < 0.8, a, a + 1).astype(np.uint32)
        met += bool(set(C.paths(a, runs, 0).tolist()) & set(C.paths(b, runs, 0).tolist()))
    assert met >= 1997


def test_local_splits_keep_pairs():
    rng = np.random.default_rng(3)
    sk = rng.integers(0, 256, (900, C.TOKENS), dtype=np.uint8)
    sk[1::2] = np.where(rng.random((450, C.TOKENS)) < 0.9, sk[::2], sk[1::2])
    found = set()
    for rows in C.split_on(np.arange(900), sk, 1, 6, 64):
        i, j = C.sketches_link(sk[rows], sk[rows], 40)
        found |= {(int(rows[x]), int(rows[y])) for x, y in zip(i, j) if rows[x] < rows[y]}
    assert len({(k, k + 1) for k in range(0, 900, 2)} & found) >= 445


def test_buckets_lose_pairs_independently():
    rng = np.random.default_rng(4)
    sk = rng.integers(0, 256, (600, C.TOKENS), dtype=np.uint8)
    sk[1] = sk[0]
    sk[1, np.random.default_rng(1).choice(C.TOKENS, size=4, replace=False)] ^= 1  # what every bucket was split on first
    links = [set(zip(*map(list, C.bucket_links(int(key), sk, 38)))) for key in C.paths(rng.integers(0, 2**32, C.TOKENS, dtype=np.uint32), 4, 0)]
    assert sum((0, 1) in x for x in links) >= 12


def test_runs_include_all_losses():
    least = C.least_for(0.8, 0.9999, 0.2)
    assert C.missed(0.8, C.runs_for(0.8, 0.9999, least), least) <= 1e-4
    assert C.missed(0.8, 4, 39) > 1e-4  # with the sketch filter as it was
    rng = np.random.default_rng(5)
    lost = 0
    for key in range(150):  # buckets of 300 sets in which a pair agrees in 38 of 64 places
        sk = rng.integers(0, 256, (300, C.TOKENS), dtype=np.uint8)
        sk[1, :38] = sk[0, :38]
        i, j = C.bucket_links(key * 1_000_003, sk, least)
        lost += not ((i == 0) & (j == 1)).any()
    assert lost <= 20
