"""Word shingles of whole texts as 64-bit hashes, vectorised over Arrow string buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes that separate words: space and tab to carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LONG_WORD = 48
_M1, _M2, _P = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_S = np.uint64(33)


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _S)) * _M1
        h = (h ^ (h >> _S)) * _M2
        return h ^ (h >> _S)


def word_hashes(buf: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in buf, and where each text's words start among them; edges: byte offsets of the texts."""
    solid = ~SPACE[buf]
    inner = edges[(edges > 0) & (edges < len(buf))]
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    opens[inner] = solid[inner]
    closes[:-1] &= ~solid[1:]
    closes[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    size = ends - starts
    h = size.astype(np.uint64)
    order = np.argsort(-np.minimum(size, LONG_WORD + 1), kind="stable")  # so that the words of over k bytes are a prefix
    at, count = starts[order], np.searchsorted(-np.minimum(size, LONG_WORD + 1)[order], -np.arange(LONG_WORD + 1))
    ho = h[order]
    with np.errstate(over="ignore"):
        for k in range(min(LONG_WORD, int(size.max(initial=0)))):
            n = count[k]  # words of over k bytes
            ho[:n] = (ho[:n] ^ buf[at[:n] + k]) * _P
            ho[:n] ^= ho[:n] >> np.uint64(29)
    h[order] = ho
    for i in np.flatnonzero(size > LONG_WORD):
        h[i] = xxhash.xxh3_64_intdigest(buf[starts[i] : ends[i]].tobytes())
    return mix(h), np.searchsorted(starts, edges)


def shingle_sets(texts: pa.Array, words: int = 5, chunk_bytes: int = 1 << 21) -> Iterator[np.ndarray]:
    """Each text's set of shingle hashes, sorted. A text of fewer words has one shingle, of all it has; without words, none."""
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    factors = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + chunk_bytes, side="right")) - 1)
        b = min(b, n)
        h, first = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        with np.errstate(over="ignore"):
            s = h[: max(0, len(h) - words + 1)] * factors[0]
            for k in range(1, words):
                s = s + h[k : k + len(s)] * factors[k]
            s = mix(s)
            for i in range(b - a):
                lo, hi = first[i], first[i + 1]
                if hi - lo >= words:
                    yield np.unique(s[lo : hi - words + 1])
                elif hi > lo:
                    short = (h[lo:hi] * factors[: hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
                    yield mix(np.array([short], dtype=np.uint64))
                else:
                    yield np.zeros(0, dtype=np.uint64)
        a = b


def set_key(s: np.ndarray) -> bytes:
    """128 bits that identify a shingle set."""
    return xxhash.xxh3_128_digest(s.tobytes())
