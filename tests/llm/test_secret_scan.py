import hashlib
import re

from eventframe.llm import secret_scan as S
from eventframe.llm.queries import op1_secret_scan


def brute(text):
    text = text or ""
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_spans():
    h = "0123456789abcdef" * 2
    cases = [
        "", "token=abcdef", "token = \"abc\"", "Token: 'abcdef1'", "token:token : abcdefgh", f"x{h}y", f"api_key={h} apikey:{h}", "AKIA" + "A" * 16, "AKIA" + "A" * 15, "AKIAAKIA" + "B" * 14,
        "ſecret=abcdefg", "toKen=abcdefg", "passwd==abcdef", "password\"  :  \"aaaaaa.b", h[:23] + " " + h[:24], "é" * 5 + "secret:" + "z" * 9, "token=token=abcdef;secret=token=secret",
    ]
    for c in cases:
        assert S.base_spans(c) == brute(c), c


def test_whole_table(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op1_secret_scan(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
        line = ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in base)
        both = sorted(base + brute_random(texts[r.doc_id], S.encoding("byte_bpe_50k.tiktoken")))
        assert r.spans == ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in both)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("random:")] == [s for s in line.split(",") if s]


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"


def stretches(text, inside):
    """(start, end) of the longest stretches of characters for which inside holds, character by character."""
    out, start = [], None
    for i in range(len(text) + 1):
        if i < len(text) and inside(i):
            start = i if start is None else start
        elif start is not None:
            out.append((start, i))
            start = None
    return out


def brute_random(text, enc, ratio=1.9):
    """The token test once more, with a flag for each character and no patterns."""
    text = text or ""
    free = [c in LETTERS + DIGITS + "+/_=-" for c in text]
    runs = stretches(text, lambda i: free[i])
    for a, _, b in brute(text):
        free[a:b] = [False] * (b - a)

    def digest(x):
        hexes = len(x) in (32, 40, 56, 64, 96, 128) and (set(x) <= set("0123456789abcdef") or set(x) <= set("0123456789ABCDEF"))
        groups = x.split("-")
        return hexes or [len(g) for g in groups] == [8, 4, 4, 4, 12] and set("".join(groups)) <= set("0123456789abcdefABCDEF")

    def random(x):
        letters = sum(c in LETTERS for c in x)
        if digest(x) or not letters:
            return False
        words = numbers = 0
        kind = lambda c: "U" if c in LETTERS[:26] else "l" if c in LETTERS[26:] else "d" if c in DIGITS else "-"
        i = 0
        while i < len(x):
            j = i
            while j < len(x) and kind(x[j]) == kind(x[i]):
                j += 1
            if kind(x[i]) == "U" and j < len(x) and kind(x[j]) == "l":  # the last capital begins the next word
                words += j - 1 - i if j - 1 - i >= 4 else 0
                i = j - 1
                j += 1
                while j < len(x) and kind(x[j]) == "l":
                    j += 1
            words += j - i if kind(x[i]) in "Ul" and j - i >= 4 else 0
            numbers += kind(x[i]) == "d"
            i = j
        return not (words >= 0.7 * letters and numbers <= 3) and len(x) < ratio * len(enc.encode_ordinary(x))

    found = []
    for lo, hi in runs:
        if hi - lo < 20:
            continue
        for a, b in stretches(text[lo:hi], lambda i: free[lo + i]):
            a, b = lo + a, lo + b
            x = text[a:b]
            if b - a < 20 or digest(x):
                continue
            if random(x):
                found.append((a, 3, b))
            else:
                found += [(a + c, 3, a + d) for c, d in stretches(x, lambda i: x[i] in LETTERS + DIGITS) if d - c >= 20 and random(x[c:d])]
    return found


def test_method_spans_against_brute_force(spark, sf):
    import random

    enc, rng = S.encoding("byte_bpe_50k.tiktoken"), random.Random(3)
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    base62, pieces = LETTERS + DIGITS, ["token=", "word", "_", "/", "AKIA" + "B" * 16, "0123456789abcdef" * 2, " ", "ThisIsAName", "é", "x9", "password: ", "-"]
    texts += ["".join(rng.choice([*pieces, "".join(rng.choices(base62, k=rng.randint(5, 40)))]) for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    texts += ["kJhGfDsAqWeRtYuIoPlMnBvCx", "".join(rng.choices(base62, k=5000)), "abcdefgh" * 3000, "".join(rng.choices(LETTERS, k=700)) + "=" + "word" * 300]
    seen = 0
    for text in texts:
        want = brute_random(text, enc)
        assert S.method_spans(text or "", S.base_spans(text or ""), enc, 1.9) == want, (text or "")[:200]
        seen += len(want)
    assert seen > 300
    assert S.method_spans("kJhGfDsAqWeRtYuIoPlMnBvCx", [], enc, 1.9)


def test_very_many_spans():
    import time

    text, start = " ".join(f"token=abcdef{k} 9fK2mQ7xZ4bT1vR8wL3n{k}" for k in range(20_000)), time.time()
    base = S.base_spans(text)
    assert len(base) == 20_000 and len(S.method_spans(text, base, S.encoding("byte_bpe_50k.tiktoken"), 1.9)) == 20_000
    assert time.time() - start < 4


def test_method():
    enc = S.encoding("byte_bpe_50k.tiktoken")
    found = lambda t: S.method_spans(t, S.base_spans(t), enc, 1.9)
    key = "9fK2mQ7xZ4bT1vR8wL3nH6pY"
    assert found(f"see {key} here") == [(4, 3, 4 + len(key))]
    for clean in (
        "123e4567-e89b-42d3-a456-426614174000", "D41D8CD98F00B204E9800998ECF8427E", "my_long_variable_name_number_2", "ThisIsACamelCaseIdentifier42", "internationalizationconfiguration", "1234567890123456789012345", "a-very-long-slug-for-a-page-2024",
        "=" * 40, "_" * 30,
    ):
        assert found(clean) == [], clean
    assert found(f"token={key}") == []  # reported already


def test_odd_rows(odd_docs, clashing):
    rows = S.scan_secrets(clashing(odd_docs)).collect()
    assert len(rows) == odd_docs.count() and all(r.spans == [] for r in rows)
    assert S.scan_secrets(odd_docs.limit(0)).collect() == []


def test_random_parts_of_runs():
    enc = S.encoding("byte_bpe_50k.tiktoken")
    found = lambda t: S.method_spans(t, S.base_spans(t), enc, 1.9)
    key, letters = "9fK2mQ7xZ4bT1vR8wL3n", "qXzKvWpJhTgRmBcYdNsF"
    for text in (f"client_authorization={key}", f"api/v2/accounts/credentials/{key}", letters, f"AKIA{'A' * 16}/{key}"):
        assert any(a <= text.index(text[-20:]) and b == len(text) for a, _, b in found(text)), text
