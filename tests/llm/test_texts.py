"""HTML extraction, language ID and packing."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from eventframe.llm import html_render, language_id, packing
from eventframe.llm.queries import op4_html_extraction, op5_language_id, op7_best_fit_packing


@pytest.mark.parametrize(
    "source,text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b", "a\n\nb"),
        ("<div>a</div><div>b</div>", "a\nb"),
        ("<p>a<br>b</p>c", "a\nb\n\nc"),
        ("<p>one <b>two</b>\n  three</p>", "one two three"),
        ("<head><title>t</title><style>s</style></head><body>x<script>if (a < b) {}</script>y", "xy"),
        ("<!-- c --><p hidden>no</p><p style='color:red; display : none'>no</p><p style='visibility:hidden'>no</p>yes", "yes"),
        ("<template>no</template><noscript>no</noscript><dialog>no</dialog><dialog open>yes</dialog>", "yes"),
        ("<ul><li>a<li>b<ol start=3><li>x<li value=7>y</ol></ul>", "- a\n- b\n  3. x\n  7. y"),
        ("<ul><li><p>a</p><p>b</p></li></ul>", "- a\n\n  b"),
        ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
        ("<table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3<tr><td>x<td>44</table>", "Name       Qty\nApple pie  3\nx          44"),
        ("<table><tbody><tr><td>a</td><td>b<br>c</td></tr><tr><td colspan=2>wide cell</td></tr></tbody></table>", "a  b\n   c\nwide cell"),
        ("<table><tr><td><table><tr><td>i<td>j</table><td>k</table>", "i  j  k"),
        ("<pre>\n a  b\n   c</pre>d", " a  b\n   c\n\nd"),
        ("a<h1>T</h1>b", "a\n\nT\n\nb"),
        ("<blockquote>q</blockquote>", "  q"),
        ("<p>x</div></span>y</p>z", "xy\n\nz"),
        ("5 < 6 and <b", "5 < 6 and"),
        ('<a title="x>y" href=\'>\'>link</a>', "link"),
        ("<details><summary>s</summary>hidden</details><details open><summary>s</summary>shown</details>", "s\ns\nshown"),
        ("<textarea>a <b> c</textarea>", "a <b> c"),
        ("<input type=hidden value=no><input type=submit value=Go>", "Go"),
        ("&nbsp;&eacute;&#x41;&unknown;", "\xa0éA&unknown;"),
        ("<p>a<table><tr><td>c</td></tr></table>b", "a\n\nc\n\nb"),
        ("<select><option>a<option>b</select>", "a\nb"),
        ("<p>x <math><mi>a</mi><mo>+</mo><mi>b</mi><annotation>no</annotation></math></p>", "x a+b"),
        ("<svg><title>no</title><g><text>label <tspan>one</tspan></text>no</g><text>two</text></svg>", "label one two"),
        ("<object data=x.swf><p>instead</p></object>", "instead"),
        ("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b><p>no</p></div><div hidden><b style='visibility:visible'>no</b></div>", "yes"),
        ("<ul><li style='visibility:hidden'>no<li>yes</ul>", "- yes"),
        ("<ruby>\u6f22<rp>(</rp><rt>kan</rt><rp>)</rp></ruby>", "\u6f22kan"),
        ("<table><tr><td rowspan=2>A<td>b<tr><td>c<tr><td>d<td>e</table>", "A  b\n   c\nd  e"),
        ("<table><tr><td>x<td rowspan=0>A<td>b<tr><td>yy<td>c<tbody><tr><td>d<td>e</table>", "x   A  b\nyy     c\nd   e"),
        ("<table><tr><td colspan=12345>wide<td>z<tr><td>a</table>", "wide  z\na"),
        ("<ol reversed><li>a<li>b<li>c</ol><ol reversed start=9><li>x<li value=-3>y<li>z</ol>", "3. a\n2. b\n1. c\n\n9. x\n-3. y\n-4. z"),
        ("<style>/* .c {display:block} */ .a, p#b.c { color: red; DISPLAY: none } @media print { .d { display: none } } em{visibility:hidden} .e{display:none} div.e{display:block}</style>"
         "<p class='x a'>no</p><p id=b class=c>no</p><p id=b>yes</p><p class=d>yes</p><em>no<i style='visibility:visible'>yes</i></em><div class=e>yes</div><p class=a style='display:block'>yes</p>", "yes\n\nyes\n\nyes\nyes\n\nyes"),
        ("<table><tr><td>" + "long " * 40 + "<td>b<tr><td>c<td>d</table>", ("long " * 40).strip() + "  b\nc" + " " * 200 + "d"),
        ("<div>" * 300 + "<ul><li>deep</ul>" + "</div>" * 300 + "after", "- deep\n\nafter"),
    ],
)
def test_rendering(source, text):
    assert html_render.render(source)[1] == text


def test_bad_pages_take_linear_time():
    import time

    t = time.process_time()
    for bad in ("<div>" * 50_000, "<" * 50_000, '<a "' * 25_000, "<p>" * 25_000 + "</x>" * 25_000, "<table><tr><td>" * 10_000, "<ul><li>" * 10_000, "&" * 50_000, "<!--" * 20_000,
                "<table><tr>" + "<td>x" * 20_000, "<table><tr><td colspan=1000 rowspan=65534>y" + "<tr>" + "<td>x" * 3000, "<table>" + "<tr><td>a<td>b" * 20_000 + "<tr><td>" + "w" * 200_000 + "<td>c", "<style>" + ".a{display:none}" * 5000 + "</style>" + "<p class=b>x" * 5000, "<b style='visibility:hidden'>x" * 20_000):
        assert len(html_render.render(bad)[1]) <= 100 * len(bad)
    assert time.process_time() - t < 20


def test_every_visible_word_is_there(spark, sf):
    """A plain walk over tags by the standard library: each word outside hidden elements is in the text, as often, and no other but list marks."""
    import re
    from collections import Counter
    from html.parser import HTMLParser

    class Walk(HTMLParser):
        def __init__(self):
            super().__init__()
            self.out, self.inside = [], []

        def handle_starttag(self, tag, attrs):
            if tag not in ("br", "img", "hr", "input", "meta", "link", "wbr", "col", "area", "base", "source", "track", "embed"):
                a = dict(attrs)
                gone = tag in ("head", "script", "style", "template", "noscript", "title", "iframe") or "hidden" in a or re.search(r"display\\s*:\\s*none|visibility\\s*:\\s*hidden", a.get("style") or "")
                self.inside.append((tag, bool(gone)))
            if tag not in ("b", "i", "em", "strong", "a", "span", "code", "u", "small", "sub", "sup"):
                self.out.append(" ")

        def handle_endtag(self, tag):
            if any(t == tag for t, _ in self.inside):
                while self.inside.pop()[0] != tag:
                    pass
            if tag not in ("b", "i", "em", "strong", "a", "span", "code", "u", "small", "sub", "sup"):
                self.out.append(" ")

        def handle_data(self, data):
            if not any(g for _, g in self.inside):
                self.out.append(data)

    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        walk = Walk()
        walk.feed(r.html or "")
        walk.close()
        want, got = Counter("".join(walk.out).split()), Counter(html_render.render(r.html or "")[1].split())
        assert not want - got, (r.page_id, want - got)
        assert all(re.fullmatch(r"-|\\d+\\.", w) for w in got - want), (r.page_id, got - want)


def test_html_rows(spark, sf):
    rows = spark.createDataFrame([(1, None), (2, ""), (None, "<title> a  b </title>x"), (4, "y"), (4, "y")], "page_id long, html string")
    got = [tuple(r) for r in html_render.extract_text(rows.selectExpr("*", "'z' AS id", "'z' AS title")).collect()]
    assert got == [(1, None, ""), (2, None, ""), (None, "a b", "x"), (4, None, "y"), (4, None, "y")]
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op4_html_extraction(spark, sf).collect()
    assert len(rows) == len(pages) and all((r.title, r.text) == html_render.render(pages[r.page_id] or "") for r in rows)
    assert html_render.extract_text(spark.createDataFrame([], "page_id long, html string")).collect() == []


# ---- language ID


def brute_grams(text, buckets):
    """Buckets of all n-grams, symbol by symbol, with whole numbers of Python."""
    import unicodedata

    clean = []
    for c in f" {text.lower()} ":
        c = ord(c) if unicodedata.category(c)[0] in "LM" else 32
        if c != 32 or not clean or clean[-1] != 32:
            clean.append(c)
    full, out = 2**64 - 1, []
    for n in language_id.SIZES:
        for i in range(len(clean) - n + 1):
            h = 0
            for c in clean[i : i + n]:
                h = (h + c) * 0x9E3779B97F4A7C15 & full
            h = (h + n) & full
            for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
                h = (h ^ h >> 33) * m & full
            out.append((h ^ h >> 33) % buckets)
    return sorted(out)


@pytest.mark.parametrize("chunk", [1, 2, 5, 64, 1 << 20])
def test_grams_of_pieces_are_those_of_the_whole(monkeypatch, chunk):
    monkeypatch.setattr(language_id, "CHUNK", chunk)
    for text in ("Ünïted wörds, 123 and more! " * 20, "", " ,. ", "a", "no" + " " * 200 + "yes", "x.y" * 70):
        got = [int(b) for g in language_id.grams(text, 1 << 12) for b in g]
        assert sorted(got) == brute_grams(text, 1 << 12), text


def brute_predict(model, text):
    total = model.prior.astype(float).copy()
    for b in brute_grams(text, model.buckets):
        total = total + model.log_prob[b]
    return total


@pytest.mark.parametrize("chunk", [40, 1 << 20])
def test_batches_score_as_texts_alone(monkeypatch, chunk):
    rng = np.random.default_rng(2)
    model = language_id.Model(["a", "b", "c"], np.log(rng.random((1 << 10, 3))).astype(np.float32), np.array([-1.0, -2.0, -0.5]))
    texts = ["the cat", "", "x", "12 . 3", "Straße İstanbul", "a" * 30, "many words, and then more of them " * 8, " lead and trail ", "日本語"]
    monkeypatch.setattr(language_id, "CHUNK", chunk)
    n = np.zeros(len(texts))
    got = language_id.score_texts(texts, model, n)
    for i, t in enumerate(texts):
        has = any(c.isalpha() for c in t)
        assert got[i] == pytest.approx(brute_predict(model, t) if has else model.prior, abs=1e-6) and n[i] == (len(brute_grams(t, 8)) if has else 0)


def test_language_query(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op5_language_id(spark, sf).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows) and held
    assert all(0 <= r.score <= 1 for r in rows)
    lettered = [r for r in held if any(c.isalpha() for c in docs[r.doc_id].text or "")]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in lettered) >= 0.95 * len(lettered)


def test_language_scores_match_brute_force(spark, make_docs):
    train = make_docs([(i, t, g) for i, (t, g) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("le chien et le chat", "fr"), (None, "en"), ("no label", None)])])
    m = language_id.fit(train, buckets=1 << 11)
    assert m.languages == ["de", "en", "fr"] and np.allclose(np.exp(m.log_prob.astype(float)).sum(axis=0), 1, atol=1e-3)
    texts = ["the dog", "und", "le chat " * 900, "x", "", "12 34"]
    got = language_id.predict(make_docs([(i, t) for i, t in enumerate(texts)]), m).orderBy("doc_id").collect()
    for t, r in zip(texts[:4], got):
        s = brute_predict(m, t)
        assert r.lang_pred == m.languages[int(s.argmax())] and r.score == pytest.approx(1 / np.exp(s - s.max()).sum(), abs=1e-6)
    assert [(r.lang_pred, r.score) for r in got[4:]] == [("und", 0.0)] * 2


def test_language_odd_rows(spark, odd_docs, clashing):
    m = language_id.fit(clashing(odd_docs))
    rows = language_id.predict(clashing(odd_docs), m).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r.lang_pred for r in rows).count("und") == 4
    empty = language_id.fit(odd_docs.limit(0))
    assert {(r.lang_pred, r.score) for r in language_id.predict(odd_docs, empty).collect()} == {("und", 0.0)}
    assert language_id.predict(odd_docs.limit(0), m).collect() == []


def test_fit_sample_is_bounded(make_docs):
    docs = make_docs([(i, f"text number {i} of many", "en") for i in range(400)])
    m = language_id.fit(docs, sample_docs=50, buckets=1 << 11)
    with pytest.raises(ValueError):
        language_id.fit(docs, max_languages=0)
    assert m.languages == ["en"]


def test_all_labelled_rows_count(make_docs):
    """More rows than any sample took: each counts in the model, and each has its say in the floors, read without itself."""
    docs = make_docs([(i, f"word{'abcdefghij'[i % 10]} {'klmno'[i % 5]}" if i % 20 else "zyx wvu zyx", "en") for i in range(24_000)])
    c = language_id.count(docs, buckets=1 << 11)
    assert c.docs.tolist() == [24_000]
    want = np.zeros(1 << 11, dtype=np.int64)
    for r, n in docs.groupBy("text").count().collect():
        want += n * np.bincount(brute_grams(r, 1 << 11), minlength=1 << 11)
    assert (c.grams[:, 0] == want).all()
    assert language_id.fit(docs, buckets=1 << 11).log_prob == pytest.approx(c.model().log_prob)


@pytest.mark.parametrize("chunk", [8, 1 << 16])
def test_floors_leave_each_text_out(monkeypatch, make_docs, chunk):
    texts = ["the cat and the dog", "a dog and a cat", "the end of the day", "12 . 3", "x"]
    docs = make_docs([(i, t, "en") for i, t in enumerate(texts)] + [(9, "le chat", "fr"), (10, None, "en"), (11, "no label", None)])
    c, shown = language_id.count(docs, buckets=1 << 11), defaultdict(list)
    if chunk < 20:
        monkeypatch.setattr(language_id, "CHUNK", chunk)
    total = sum(np.bincount(brute_grams(t, 1 << 11), minlength=1 << 11) for t in texts)
    column = np.log(c.grams[:, 0] + 0.5)
    for t in texts[:3]:
        pieces = [t[:2], t[:4], t]
        rest = total - np.bincount(brute_grams(t, 1 << 11), minlength=1 << 11) + 0.5
        means, n = language_id.means_without(pieces, column, c.grams[:, 0], int(c.grams[:, 0].sum()), 0.5)
        assert means == pytest.approx([np.mean(np.log(rest / rest.sum())[brute_grams(x, 1 << 11)]) for x in pieces]) and n.tolist() == [len(brute_grams(x, 8)) for x in pieces]
    assert (column == np.log(c.grams[:, 0] + 0.5)).all()
    monkeypatch.undo()
    for t in (*texts[:3], "x"):
        for x in [*(t[: 1 << k] for k in range(1, len(t).bit_length()) if any(ch.isalpha() for ch in t[: 1 << k])), t]:
            rest = total - np.bincount(brute_grams(t, 1 << 11), minlength=1 << 11) + 0.5
            g = brute_grams(x, 1 << 11)
            shown[int(np.log2(len(g)))].append(np.mean(np.log(rest / rest.sum())[g]))
    want = {k: np.median(v) - max(2.0, 4 * (np.median(v) - np.quantile(v, 0.05))) for k, v in shown.items()}
    got = language_id.fit_floors(docs, c)
    assert set(got) == {"en"} and got["en"] == pytest.approx(want, abs=0.02)


# ---- packing


@pytest.fixture(scope="module")
def full():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_word_cache_equals_tokenizer(spark, sf, full):
    t = packing.tokenizer("word_bpe_49k.json")
    odd = ["", "  ", "a\x1cb \x1f c", "a b c\u0085d​x", "don't I'LL we've 's'", "ÀÉ ßẞ İI ΣΑΣ ſs", "é ́x", "日本語 テスト 한국어", "x,,, y... z?!*** $$$ a.b", "<|endoftext|> <|startoftext|>", "x <|endoftext|> y", "a,<|endoftext|>b <|ENDOFTEXT|> <|endoftext|", "1234 ½ ²", "😀👍🏽", "a" * 500, "Ǆ ŉ ﬁ", "re's.'t,", "\ud83d".encode("utf-16", "surrogatepass").decode("utf-16", "replace")]
    for text in odd + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]:
        assert np.frombuffer(t.ids(text), "<u4").tolist() == full(text), text[:80]


def test_cache_generations(monkeypatch, full):
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    t = packing.WordTokenizer("word_bpe_49k.json")
    text = " ".join(f"word{k % 13}x the," for k in range(60))
    assert np.frombuffer(t.ids(text), "<u4").tolist() == full(text) and len(t.new) <= 5


def check_packing(rows, docs, full, size, end=1):
    """Exact round trip: pieces are the documents, sequences are gapless and never too long."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    want = defaultdict(list)
    for i, text in docs:
        ids = np.array([*full(text or ""), end], dtype="<u4")
        for p, a in enumerate(range(0, len(ids), size)):
            want[i].append((p, a, len(ids[a : a + size]), zlib.crc32(ids[a : a + size].tobytes())))
    assert {i: sorted(v) for i, v in want.items()} == {i: sorted((r.piece, r.start, r.length, r.ids_crc32) for r in v) for i, v in by_doc.items()}
    for v in by_seq.values():
        at = 0
        for r in sorted(v, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    total = sum(r.length for r in rows)
    return len(by_seq), -(-total // size)


def test_packing_query(spark, sf, full):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    made, least = check_packing(op7_best_fit_packing(spark, sf).collect(), docs, full, 4096)
    assert made <= 1.02 * least + 1


@pytest.mark.parametrize("bins", [1, 3, 1000])
def test_packing_small(spark, make_docs, full, bins):
    docs = [(i, "word " * ((i * 37) % 61)) for i in range(300)]
    rows = packing.pack(make_docs(docs), size=32, open_bins=bins, packer_docs=100, with_ids=True).collect()
    made, least = check_packing(rows, docs, full, 32)
    assert made <= (1.7 if bins == 1 else 1.2) * least
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, packing.pack(make_docs(docs), size=32, open_bins=bins, packer_docs=100, with_ids=True).collect()))


def test_bins_close_in_the_query():
    """With the query's own parameters, bins close, few sequences are lost by that, and no more bins are open than allowed."""
    import inspect

    default = {k: v.default for k, v in inspect.signature(packing.pack).parameters.items()}
    lengths = np.minimum(np.random.default_rng(4).lognormal(6.0, 1.2, default["packer_docs"]).astype(int) + 1, default["size"])
    bins = packing.OpenBins(default["size"], default["open_bins"])
    for x in lengths.tolist():
        bins.place(x)
        assert bins.open <= default["open_bins"]
    assert bins.closed > default["open_bins"] and bins.made <= 1.02 * -(-lengths.sum() // default["size"])


def test_packing_odd_rows(odd_docs, clashing, full):
    rows = packing.pack(clashing(odd_docs)).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in odd_docs.collect()], full, 4096)
    assert packing.pack(odd_docs.limit(0)).collect() == []


def test_best_fit_against_plain_search():
    rng = np.random.default_rng(0)
    for most in (2, 7, 50):
        bins, free, open_ = packing.OpenBins(100, most), [], []
        for n in rng.integers(1, 101, 500).tolist():
            fits = [b for b in open_ if free[b] >= n]
            if fits:
                least = min(free[b] for b in fits)
                fits = [b for b in fits if free[b] == least]
            else:
                if len(open_) >= most:
                    tight = min(free[b] for b in open_)
                    closing = [b for b in open_ if free[b] == tight]
                else:
                    closing = []
                free.append(100)
                fits = [len(free) - 1]
            b, at = bins.place(n)
            assert b in fits and at == 100 - free[b]
            if fits == [len(free) - 1] and free[-1] == 100:
                if closing:
                    gone = [x for x in closing if x not in sum(bins.bins, [])]
                    open_.remove(gone[0])
                open_.append(b)
            free[b] -= n
            if not free[b]:
                open_.remove(b)
        assert bins.open == len(open_)
