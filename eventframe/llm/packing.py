"""Best-fit packing of tokenized documents into sequences of a fixed length."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_of

#: Characters that Unicode calls white space; the tokenizer drops them and joins nothing across them.
WHITE = re.compile("[\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
ODD_WHITE = re.compile("[\x1c-\x1f]")
#: Words whose tokens don't depend on normalisation: Latin letters that lower-case one to one and are composed already.
PLAIN = re.compile("[A-Za-z\u00df-\u00f6\u00f8-\u00ff\u00c0-\u00d6\u00d8-\u00de]+")
#: Marks that make one piece together, none of which begins a contraction.
MARKS = re.compile(r"[.,;:!?*$%&#]+")
#: Words in each of the two generations of the cache: some 100 MB at most.
CACHE_WORDS = 450_000


class WordTokenizer:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes, word by word through a cache.

    The vocabulary's tokenizer lower-cases, drops white space and never merges across it, so a text's ids are those of its
    words in turn. Words of plain Latin letters go straight to the BPE model; all others through the whole tokenizer.
    """

    def __init__(self, name: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(public_tokenizers.path(name))
        self.model = self.full.model
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(printable)]
        self.bytes_as = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def word(self, w: str) -> bytes:
        if w.isascii() and w.isalpha():
            return array("I", [t.id for t in self.model.tokenize(w.lower())]).tobytes()
        if PLAIN.fullmatch(w):
            return array("I", [t.id for t in self.model.tokenize(w.lower().encode().decode("latin-1").translate(self.bytes_as))]).tobytes()
        head = PLAIN.match(w)
        if head and MARKS.fullmatch(w, head.end()):  # a word and the marks behind it are two pieces
            return self.get(head[0]) + self.get(w[head.end() :])
        return array("I", self.full.encode(w, add_special_tokens=False).ids).tobytes()

    def get(self, w: str) -> bytes:
        found = self.new.get(w)
        if found is None:
            found = self.old.get(w)
            if found is None:
                found = self.word(w)
            if len(w) <= 64:
                if len(self.new) >= CACHE_WORDS:
                    self.old, self.new = self.new, {}
                self.new[w] = found
        return found

    def ids(self, text: str) -> bytes:
        words = text.split() if not ODD_WHITE.search(text) else [w for w in WHITE.split(text) if w]
        out = list(map(self.new.get, words))
        if None in out:
            for i, x in enumerate(out):
                if x is None:
                    out[i] = self.get(words[i])
        return b"".join(out)


@lru_cache(maxsize=2)
def tokenizer(name: str) -> WordTokenizer:
    return WordTokenizer(name)


class OpenBins:
    """A fixed number of open bins. An integer is the bitset of free spaces that occur; the best fit for a piece is its
    lowest set bit at or above the piece's length. When all bins are open and none fits, the fullest closes."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.open, self.made = size, most, 0, 0
        self.bits, self.closed = 0, 0
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def _put(self, free: int, b: int) -> None:
        if not free:
            self.open -= 1
            return
        self.bins[free].append(b)
        self.bits |= 1 << free

    def _take(self, free: int) -> int:
        b = self.bins[free].pop()
        if not self.bins[free]:
            self.bits &= ~(1 << free)
        return b

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        fit = self.bits >> length
        if fit:
            free = length + ((fit & -fit).bit_length() - 1)
            b = self._take(free)
        else:
            if self.open >= self.most:
                fullest = (self.bits & -self.bits).bit_length() - 1
                self._take(fullest)
                self.open, self.closed = self.open - 1, self.closed + 1
            free, b = self.size, self.made
            self.made += 1
            self.open += 1
        self._put(free - length, b)
        return b, self.size - free


def cut_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str = "word_bpe_49k.json", end_id: int = 1, size: int = 4096, with_ids: bool = False
) -> DataFrame:
    """Tokenized documents, each with end_id at its end, cut into pieces of size tokens (the last may be shorter): id,
    piece, start, length, ids_crc32 and, with_ids, the ids. A null text is an empty one: its only piece is end_id."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(vocab)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                who, piece, start, length, crc, ids = [], [], [], [], [], []
                for k, x in enumerate(rows.column(1)):
                    data = t.ids(x.as_py() or "") + end
                    for p, lo in enumerate(range(0, len(data), 4 * size)):
                        part = data[lo : lo + 4 * size]
                        who.append(k)
                        piece.append(p)
                        start.append(lo // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
                cols = [rows.column(0).take(pa.array(who, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), names + (["ids"] if with_ids else []))

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocab: str = "word_bpe_49k.json",
    end_id: int = 1,
    size: int = 4096,
    open_bins: int = 64,
    packer_docs: int = 16_384,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id_col, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Pieces go by hash to packers of about packer_docs documents each; a packer takes its pieces one by one, in the order of
    a hash that knows nothing of their lengths, and holds at most open_bins open bins; where none fits and all are open, the
    fullest closes. Only the lengths are needed for that: with_ids moves the ids along. A sequence's offsets are gapless
    from 0, and reruns give the same sequences. Repeated rows are packed as often as they occur; rows with a null
    text or id are packed like others. An empty table gives no rows.
    """
    pieces = cut_pieces(docs, id_col, text_col, vocab, end_id, size, with_ids)
    kind = pieces.schema["id"].dataType.simpleString()
    packers = blocks_of(docs.count(), packer_docs)
    extra = ["ids"] if with_ids else []
    dealt = pieces.withColumn("packer", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(packers)))
    dealt = dealt.repartition(packers, "packer").sortWithinPartitions("packer", F.xxhash64(F.lit(2), "id", "piece", "ids_crc32"), "id", "piece", "start", "length", "ids_crc32")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bins = None, None
        for batch in batches:
            seq, off = [], []
            for packer, length in zip(batch.column("packer").to_pylist(), batch.column("length").to_pylist()):
                if packer != held:
                    held, bins = packer, OpenBins(size, open_bins)
                b, o = bins.place(length)
                seq.append((packer << 40) + b)
                off.append(o)
            keep = [batch.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(seq, pa.int64()), pa.array(off, pa.int64()), *(batch.column(c) for c in extra)], ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *extra])

    out = dealt.mapInArrow(fill, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long" + (", ids array<int>" if with_ids else ""))
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *extra)
