"""Secret scan: pattern rules plus a token-efficiency test.

A random string costs a tokenizer many tokens: its characters per token under a byte-level BPE vocabulary stay low,
while words, even rare ones, merge into few. Strings that are random for a known reason (digests, UUIDs) or that are
identifiers made of words are excluded first.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: What stands between the separators of a run.
PART = re.compile(r"[A-Za-z0-9]{20,}")
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)", re.ASCII)
#: Hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512, and of the shorter common checksums.
DIGEST_LENGTHS = frozenset({32, 40, 56, 64, 96, 128})
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
SEGMENT = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


@lru_cache(maxsize=2)
def encoding(vocab: str):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocab), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(vocab, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the three pattern rules."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def excluded(run: str) -> bool:
    """Known digests and identifiers: random for a reason, or made of words or counters."""
    if DIGEST.fullmatch(run) and len(run) in DIGEST_LENGTHS or UUID.fullmatch(run):
        return True
    letters = sum(c.isalpha() for c in run)
    if not letters:
        return True  # a number or a rule of dashes
    # words joined by case or by separators: letters sit in long segments, digits in few
    segments = SEGMENT.findall(run)
    words = sum(len(s) for s in segments if len(s) >= 4 and s[-1].isalpha())
    return words >= 0.7 * letters and sum(s[0].isdigit() for s in segments) <= 3


def method_spans(text: str, taken: list[tuple[int, int, int]], enc, max_ratio: float) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of what the token test finds beside the spans taken, which are sorted by start."""
    covered: list[list[int]] = []  # what the spans cover, as intervals apart from each other
    for s, _, e in taken:
        if covered and s <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], e)
        else:
            covered.append([s, e])
    found = []

    def dense(run: str) -> bool:
        return not excluded(run) and len(run) < max_ratio * len(enc.encode_ordinary(run))

    for m in RUN.finditer(text):
        at, rest = m.start(), []
        for s, e in covered[bisect_right(covered, at, key=lambda c: c[1]) :]:  # what base spans leave of the run
            if s >= m.end():
                break
            rest.append((at, s))
            at = e
        for a, b in [*rest, (at, m.end())]:
            run = text[a:b] if b - a >= 20 else ""
            if not run or DIGEST.fullmatch(run) and len(run) in DIGEST_LENGTHS or UUID.fullmatch(run):
                continue
            if dense(run):
                found.append((a, 3, b))
            else:  # words joined to a random part dilute it
                found += [(a + p.start(), 3, a + p.end()) for p in PART.finditer(run) if dense(p[0])]
    return found


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str = "byte_bpe_50k.tiktoken", max_ratio: float = 1.9
) -> DataFrame:
    """One row per row of docs: id and spans, an array of (kind, start, end) in code points, end exclusive, sorted by
    start and then by kind.

    Kinds assign, access and hex are pattern matches; random is a run of 20 or more token characters, or what the others leave
    of one, or else a part of 20 or more letters and digits of it, with fewer than max_ratio characters per token, counted whole
    at any length, and no known digest or identifier. A null or empty
    text has no spans. Rows are independent: repeated rows each give their own result, and other columns are not read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(vocab)
        for batch in batches:
            out = []
            for x in batch.column(1):
                text = x.as_py() or ""
                base = base_spans(text)
                spans = sorted(base + method_spans(text, base, enc, max_ratio))
                out.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(SPAN))], ["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>").select(F.col("id").alias(id_col), "spans")


def spans_text(spans, kinds: tuple[str, ...] = KINDS):
    """kind:start:end of the spans of these kinds, comma-joined."""
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
