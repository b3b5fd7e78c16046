"""Language ID: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import mix

SIZES = (1, 2, 3)
#: Characters hashed at once: of short texts together, or of a piece of a long one.
CHUNK = 1 << 16


def symbols(text: str) -> np.ndarray:
    """Code points, with all but letters and marks as spaces."""
    u = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(LETTER[np.minimum(u, len(LETTER) - 1)], u, 32).astype(np.uint64)


def hashes(u: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(n, buckets of the n-grams that start at each place) for each n in SIZES."""
    h = np.zeros(len(u), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, min(max(SIZES), len(u)) + 1):
            h = (h[: len(u) - n + 1] + u[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
            if n in SIZES:
                yield n, (mix(h + np.uint64(n)) % np.uint64(buckets)).astype(np.int32)


def grams(text: str, buckets: int) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of the text, lower-cased, with every run of non-letters as one space. A long text goes
    through in pieces; each begins with the symbols before it that its first n-grams need, so that it counts as if whole."""
    text, before = f" {text.lower()} ", np.zeros(0, dtype=np.uint64)
    for lo in range(0, len(text), CHUNK):
        u = symbols(text[lo : lo + CHUNK])
        last = np.r_[before[-1:] if len(before) else np.zeros(1, np.uint64), u[:-1]]
        u = np.concatenate([before, u[(u != 32) | (last != 32)]])
        for n, h in hashes(u, buckets):
            yield h[max(0, len(before) - n + 1) :]
        before = u[max(0, len(u) - max(SIZES) + 1) :]


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts as one array, the text that each belongs to)."""
    u = symbols("".join(f" {x.lower()} " for x in texts))
    size = np.array([len(x.lower()) + 2 for x in texts])
    first = np.zeros(len(u), dtype=bool)
    first[np.cumsum(size) - size] = True
    keep = first | (u != 32) | (np.r_[np.uint64(0), u[:-1]] != 32)
    return u[keep], np.repeat(np.arange(len(texts)), size)[keep]


def joined_hashes(u: np.ndarray, owner: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, buckets of the n-grams, the text of each), without n-grams across texts."""
    for n, h in hashes(u, buckets):
        keep = owner[: len(h)] == owner[n - 1 :]
        yield n, h[keep], owner[: len(h)][keep]


def batch_sums(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(sums of log-probabilities over each text's n-grams (texts, languages), numbers of n-grams), for texts with a letter
    each: hashed as one array, whose n-grams across texts are left out."""
    u, owner = joined(texts)
    size = np.bincount(owner, minlength=len(texts))
    out, number = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts))
    columns = np.ascontiguousarray(model.log_prob.T)
    for n, h, _ in joined_hashes(u, owner, model.buckets):
        many = size - n + 1  # a text with a letter has three symbols at least
        starts = np.cumsum(many) - many
        number += many
        for k, column in enumerate(columns):
            out[:, k] += np.add.reduceat(column[h], starts, dtype=np.float64)
    return out, number


def _letters() -> np.ndarray:
    """Which code points are letters or marks; the last entry stands for all beyond the supplementary ideographs."""
    import unicodedata

    table = np.zeros(0x32000, dtype=bool)
    for c in range(len(table)):
        table[c] = unicodedata.category(chr(c))[0] in "LM"
    return table


LETTER = _letters()


def has_letter(text: str) -> bool:
    return text.isascii() and any(c.isalpha() for c in text[:64]) or any(c.isalpha() for c in text)


@dataclass
class Model:
    languages: list[str]
    log_prob: np.ndarray  # (buckets, languages), float32
    prior: np.ndarray

    @property
    def buckets(self) -> int:
        return len(self.log_prob)


@dataclass
class Counts:
    languages: list[str]
    grams: np.ndarray  # (buckets, languages)
    docs: np.ndarray  # labelled rows per language

    def model(self, alpha: float = 0.5) -> Model:
        counts = self.grams + alpha
        prob = np.log(counts) - np.log(counts.sum(axis=0, keepdims=True))
        return Model(self.languages, prob.astype(np.float32), np.log(self.docs / self.docs.sum()) if len(self.docs) else np.zeros(0))


def count(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key: tuple[str, ...] = (), sample_docs: int | None = None, buckets: int = 1 << 15, max_languages: int = 256) -> Counts:
    """Counts n-grams of the whole texts of all labelled rows (or, where sample_docs is given, of at most so many, those of the smallest
    hash of the key columns and the text) on the executors; the driver gets one count per language and bucket. Rows
    without text or language are no examples. There are max_languages x buckets counts at most; more languages are an error."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(*key, text_col).alias("h")).where("text is not null and lang is not null")
    per = rows.groupBy("lang").count().limit(max_languages + 1).collect()
    if len(per) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    total = sum(r["count"] for r in per)
    if sample_docs is not None and total > sample_docs:  # the hashes below some edge, a quarter more than the sample on average, give the sample's own edge
        near = rows.where(F.col("h") < F.lit(int(-(2**63) + 2**64 * min(1.0, 1.25 * sample_docs / total)) if 1.25 * sample_docs < total else 2**63 - 1)).select("h").toArrow()["h"].to_numpy()
        if len(near) > sample_docs:
            rows = rows.where(F.col("h") < F.lit(int(np.partition(near, sample_docs)[sample_docs])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        n: dict[str, int] = {}
        held: dict[str, list[str]] = {}
        size: dict[str, int] = {}

        def add(lang: str) -> None:
            for _, h, _ in joined_hashes(*joined(held.pop(lang)), buckets):
                total[lang] += np.bincount(h, minlength=buckets)
            size.pop(lang)

        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                text, lang = x.as_py(), y.as_py()
                c = total.setdefault(lang, np.zeros(buckets, dtype=np.int64))
                n[lang] = n.get(lang, 0) + 1
                if len(text) > CHUNK // 2:
                    for g in grams(text, buckets):
                        c += np.bincount(g, minlength=buckets)
                    continue
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text) + 2
                if size[lang] > CHUNK:
                    add(lang)
        for lang in list(held):
            add(lang)
        for lang, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(at) + 1)), pa.array(np.r_[at, -1]), pa.array(np.r_[c[at], n[lang]])], ["lang", "bucket", "n"])

    made = rows.select("text", "lang").mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    lang, bucket, n = (made[c].to_numpy() for c in ("lang", "bucket", "n"))
    languages = sorted(set(lang))
    number = {x: k for k, x in enumerate(languages)}
    place = np.fromiter((number[x] for x in lang), int, len(lang))
    counts, docs_of = np.zeros((buckets, len(languages)), dtype=np.int64), np.zeros(len(languages))
    grams_only = bucket >= 0
    counts[bucket[grams_only], place[grams_only]] = n[grams_only]
    docs_of[place[~grams_only]] = n[~grams_only]
    return Counts(languages, counts, docs_of)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key: tuple[str, ...] = (), sample_docs: int | None = None, buckets: int = 1 << 15, alpha: float = 0.5, max_languages: int = 256) -> Model:
    """The model of the counted rows, by default all labelled ones. Priors are the languages' shares in them. The matrix has
    max_languages x buckets single-precision numbers at most."""
    return count(docs, text_col, lang_col, key, sample_docs, buckets, max_languages).model(alpha)


def score_texts(texts: list[str], model: Model, n_grams: np.ndarray | None = None) -> np.ndarray:
    """Log-likelihood plus log-prior, (texts, languages): each text's n-grams times the log-probability matrix, for many texts at
    once; longer texts go piece by piece. A text without a letter has the prior alone. n_grams, if given, is filled with the texts' numbers of n-grams."""
    out, number = np.tile(model.prior, (len(texts), 1)), np.zeros(len(texts))
    batch: list[int] = []
    held = 0
    for i, text in [*enumerate(texts), (-1, "")]:
        if batch and (i < 0 or held + len(text) > CHUNK):
            out[batch], number[batch] = (a + b for a, b in zip((out[batch], number[batch]), batch_sums([texts[k] for k in batch], model)))
            batch, held = [], 0
        if i < 0 or not has_letter(text):
            continue
        if len(text) <= CHUNK // 2:
            batch.append(i)
            held += len(text)
            continue
        for g in grams(text, model.buckets):
            number[i] += len(g)
            c = np.bincount(g)
            at = np.flatnonzero(c)
            out[i] += c[at] @ model.log_prob[at].astype(np.float64)
    if n_grams is not None:
        n_grams[:] = number
    return out


#: Means are counted in steps of one in so many.
STEPS = 1024


def means_without(pieces: list[str], column: np.ndarray, counts: np.ndarray, total: int, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """(mean log-likelihood per n-gram, number of n-grams) of each piece in a model of all counted texts but the last piece, which is one of them.
    column: logarithms of counts + alpha, changed for a while only where the text has n-grams; counts and total of its language."""
    buckets, joint = len(column), len(pieces[-1]) <= CHUNK // 2
    if joint:
        parts = [(h, own) for _, h, own in joined_hashes(*joined(pieces), buckets)]
        h, owner = np.concatenate([h for h, _ in parts]), np.concatenate([own for _, own in parts])
        mine = np.bincount(h[owner == len(pieces) - 1], minlength=buckets)
    else:
        mine = np.zeros(buckets, dtype=np.int64)
        for g in grams(pieces[-1], buckets):
            mine += np.bincount(g, minlength=buckets)
    at = np.flatnonzero(mine)
    before = column[at]
    column[at] = np.log(counts[at] - mine[at] + alpha)
    if joint:
        sums, number = np.bincount(owner, column[h], len(pieces)), np.bincount(owner, minlength=len(pieces))
    else:
        sums, number = np.zeros(len(pieces)), np.zeros(len(pieces), dtype=np.int64)
        for i, x in enumerate(pieces):
            for g in grams(x, buckets):
                sums[i], number[i] = sums[i] + column[g].sum(), number[i] + len(g)
    column[at] = before
    return sums / number - np.log(total - mine.sum() + alpha * buckets), number


def fit_floors(docs: DataFrame, counts: Counts, text_col: str = "text", lang_col: str = "lang", alpha: float = 0.5, spreads: float = 4.0, allowance: float = 2.0) -> dict[str, dict[int, float]]:
    """The least mean log-likelihood per n-gram that texts of a language show, by the binary logarithm of their number of n-grams.

    counts are those of all labelled rows of docs. Each of these rows, whole and cut to 2, 4, 8 … characters, is read in its own language by
    the model of all others. The floor is the median less the larger of allowance and so many times the distance from the median to the
    fifth percentile, over all means in steps of 1/STEPS."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    if not counts.languages:
        return {}
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        number, totals = {x: k for k, x in enumerate(c.languages)}, c.grams.sum(axis=0)
        columns: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        seen: Counter[tuple[int, int, int]] = Counter()
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                text, k = x.as_py(), number[y.as_py()]
                if c.docs[k] < 2 or not has_letter(text):
                    continue
                if k not in columns:
                    columns[k] = np.log(c.grams[:, k] + alpha), np.ascontiguousarray(c.grams[:, k])
                pieces = [p for i in range(1, len(text).bit_length()) if has_letter(p := text[: 1 << i])] + [text]
                means, n_grams = means_without(pieces, *columns[k], totals[k], alpha)
                seen.update(zip([k] * len(pieces), np.log2(n_grams).astype(int).tolist(), np.floor(means * STEPS).astype(int).tolist()))
        k, size, step = (np.array([x[i] for x in seen], dtype=np.int64) for i in range(3))
        yield pa.RecordBatch.from_arrays([pa.array([c.languages[i] for i in k], pa.string()), pa.array(size), pa.array(step), pa.array(list(seen.values()), pa.int64())], ["lang", "class", "step", "n"])

    shown = rows.mapInArrow(read, "lang string, class long, step long, n long").groupBy("lang", "class", "step").agg(F.sum("n").alias("n"))
    floors: dict[str, dict[int, float]] = {}
    for r in shown.groupBy("lang", "class").agg(F.percentile("step", [0.5, 0.05], F.col("n")).alias("q")).toLocalIterator():
        middle, low = (q / STEPS for q in r["q"])
        floors.setdefault(r["lang"], {})[r["class"]] = middle - max(allowance, spreads * (middle - low))
    return floors


def floor_of(floors: dict[str, dict[int, float]], lang: str, n_grams: float) -> float:
    """The lowest floor of texts of this length and longer ones, since shorter ones vary more; for a language with less than two
    labelled rows the lowest of all languages, and none if there is no floor at all."""
    if lang not in floors:
        return min((floor_of(floors, x, n_grams) for x in floors), default=-np.inf)
    own, at = floors[lang], int(np.log2(n_grams))
    return min((v for c, v in own.items() if c >= at), default=own[max(own)])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", floors: dict[str, dict[int, float]] | None = None) -> DataFrame:
    """One row per row of docs: id_col, lang_pred, score (the posterior probability of lang_pred, 0 to 1).

    `und` with score 0 for null, empty and letterless texts, and for all texts if the model has no language. Equal texts get
    equal predictions; ties go to the first language by code point. A text that is a field of id_col (text_col "row.text") is sent once. The matrix is broadcast; its size is bounded by fit.
    With floors there is a column typical: whether the text's n-grams are as likely in lang_pred as those of its texts are.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    inner = text_col.removeprefix(f"{id_col}.") if text_col.startswith(f"{id_col}.") else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for part in (batch.slice(lo, 256) for batch in batches for lo in range(0, batch.num_rows, 256)):
            texts = [x.as_py() or "" for x in (part.column(1) if inner is None else part.column(0).field(inner))]
            lettered = [bool(m.languages) and has_letter(x) for x in texts]
            n_grams = np.zeros(len(texts))
            s = score_texts([x if ok else "" for x, ok in zip(texts, lettered)], m, n_grams)
            lang, score, typical = [], [], []
            for row, ok, n in zip(s, lettered, n_grams):
                best = int(row.argmax()) if ok else -1
                lang.append(m.languages[best] if ok else "und")
                score.append(1.0 / float(np.exp(np.maximum(row - row[best], -700.0)).sum()) if ok else 0.0)
                typical.append(bool(ok and (row[best] - m.prior[best]) / n >= floor_of(floors or {}, m.languages[best], n)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(typical)], ["id", "lang_pred", "score", "typical"])

    rows = docs.select(F.col(id_col).alias("id"), *([F.col(text_col).cast("string").alias("text")] if inner is None else []))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double, typical boolean").select(F.col("id").alias(id_col), "lang_pred", "score", *(["typical"] if floors is not None else []))
