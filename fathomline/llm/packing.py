"""Lexical retrieval packing into sequences of at most ``window`` tokens.

A document's token ids (and one closing id 0) are cut into whole windows, each a sequence of its own, and a tail.
Tails are packed: dealt by range of a two-value minhash of their ids, so that lexically near tails meet, and
taken in shards of ``SHARD`` tails. Each shard has a BM25 inverted index over token ids as terms, with document
frequencies counted over all tails of the corpus (a vector as long as the vocabulary). Each tail not yet used
becomes a seed, longest first; the unused neighbours the index returns for its rarest terms fill its window in
the order of their scores, then, where these do not suffice, the next unused tails of the shard. The last one is
cut to fit; what is left of it stays unused. What remains at a shard's end is cut into sequences
whose lengths are powers of two, so no sequence is padded.

A shard holds a fixed number of tails, each shorter than a window, so memory is bounded whatever the skew: the
range sort includes doc_id, and thousands of equal tails simply fill several shards.

Edge cases: null and empty texts are the closing id alone; repeated rows are packed once each (their pieces carry
the same doc_id); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import dicts, small_batches, staged, text_or_empty
from fathomline.llm.tokens import encoder

WINDOW = 1024
SHARD = 1024
VOCABULARY = 50_257
QUERY_TERMS = 32
K1, B = 1.2, 0.75

OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_CUT = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("near", pa.int64()), ("ids", pa.binary())]


def _hash_tables() -> tuple[np.ndarray, np.ndarray]:
    x = np.arange(VOCABULARY, dtype=np.uint64) + np.uint64(1)
    tables = []
    for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        h = x * np.uint64(m)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        tables.append((h >> np.uint64(33)).astype(np.int64))
    return tables[0], tables[1]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def cut_documents(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Whole windows (``ids`` null) and tails (``ids``: 16-bit ids; ``near``: their minhash) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder().ids
        one, two = _hash_tables()
        for b in dicts(batches):
            rows = []
            for doc, text in zip(b["doc_id"], b["text"], strict=True):
                ids = encode(text)
                ids.append(0)
                raw = np.frombuffer(array("H", ids), np.uint16)
                n = len(raw)
                whole = n // window * window
                if whole:
                    wide = raw.astype("<u4")
                    rows += [(doc, at, window, zlib.crc32(wide[at : at + window]), n, None, None) for at in range(0, whole, window)]
                if whole < n:
                    tail = raw[whole:]
                    rows.append((doc, whole, n - whole, 0, n, int(one[tail].min()) << 31 | int(two[tail].min()), tail.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _CUT, strict=True)], [n for n, _ in _CUT])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, near long, ids binary")


def document_frequencies(tails: DataFrame) -> tuple[np.ndarray, int]:
    """Over all tails: in how many each id stands, and the number of tails. At most a row for each id of the vocabulary comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(VOCABULARY + 1, np.int64), 0
        for b in batches:
            for x in b.column(0):
                df[np.unique(np.frombuffer(x.as_buffer(), np.uint16))] += 1
                n += 1
        df[VOCABULARY] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at], pa.int64())], ["term", "df"])

    out = np.zeros(VOCABULARY + 1, np.int64)
    for r in tails.select("ids").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out[:VOCABULARY], int(out[VOCABULARY])


class Index:
    """BM25 over the tails of one shard, postings in arrays sorted by term."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray) -> None:
        self.n = len(tails)
        length = np.array([len(t) for t in tails])
        doc = np.repeat(np.arange(self.n), length)
        key, tf = np.unique(np.concatenate(tails).astype(np.int64) * self.n + doc, return_counts=True)
        term, self.doc = np.divmod(key, self.n)
        norm = K1 * (1 - B + B * length / length.mean())
        self.impact = idf[term] * tf * (K1 + 1) / (tf + norm[self.doc])
        self.terms, self.first = np.unique(term, return_index=True)
        self.last = np.append(self.first[1:], len(term))
        weight = np.where(self.last - self.first > 1, idf[self.terms], -1.0)  # a term of the seed alone finds nothing
        # The strongest terms of each tail: sort by (tail, weight descending), keep the first few.
        slot = np.repeat(np.arange(len(self.terms)), self.last - self.first)
        order = np.lexsort((slot, -weight[slot], self.doc))
        starts = np.searchsorted(self.doc[order], np.arange(self.n + 1))
        self.best = [order[a : min(b, a + QUERY_TERMS)] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        self.slot, self.weight = slot, weight

    def neighbours(self, seed: int) -> np.ndarray:
        """All tails with a positive score, best first, ties by place in the shard."""
        slots = self.slot[self.best[seed]]
        slots = slots[self.weight[slots] > 0]
        if not len(slots):
            return slots
        at = np.concatenate([np.arange(a, b) for a, b in zip(self.first[slots], self.last[slots], strict=True)])
        score = np.bincount(self.doc[at], self.impact[at], self.n)
        found = np.flatnonzero(score > 0)
        return found[np.argsort(-score[found], kind="stable")]


def pack_shard(tails: list[np.ndarray], idf: np.ndarray, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (tail, first id, length)."""
    index = Index(tails, idf)
    at, size = np.zeros(len(tails), np.int64), np.array([len(t) for t in tails])
    out, queue, ahead = [], np.argsort(-size, kind="stable"), 0
    rest: list[list[tuple[int, int, int]]] = []
    for seed in queue:
        if not size[seed]:
            continue
        seq, room = [], window

        def take(i: int) -> None:
            nonlocal room
            n = min(room, int(size[i]))
            seq.append((int(i), int(at[i]), n))
            at[i] += n
            size[i] -= n
            room -= n

        take(seed)
        if room:
            found = index.neighbours(seed)
            for i in found[size[found] > 0]:
                take(i)
                if not room:
                    break
        while room and ahead < len(queue):
            if size[queue[ahead]]:
                take(queue[ahead])
            else:
                ahead += 1
        (out if not room else rest).append(seq)
    for seq in rest:  # one at most: the last
        left = sum(n for *_, n in seq)
        while left:
            want = 1 << (left.bit_length() - 1)
            part, left = [], left - want
            while want:
                i, first, n = seq.pop(0)
                part.append((i, first, min(n, want)))
                if n > want:
                    seq.insert(0, (i, first + want, n - want))
                want -= min(n, want)
            out.append(part)
    return out


def pack(docs: DataFrame, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    cut = staged(cut_documents(docs, window), "packing-cut")
    whole = cut.where("ids is null").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    tails = cut.where("ids is not null")
    df, n = document_frequencies(tails)
    idf = np.log1p((n - df + 0.5) / (df + 0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            ids = [np.frombuffer(r[3], np.uint16) for r in held]
            rows = []
            for seq in pack_shard(ids, idf, window):
                offset = 0
                for i, first, length in seq:
                    doc, start, tokens, _ = held[i]
                    rows.append((doc, start + first, length, crc(ids[i][first : first + length]), tokens, number * 2 + 1, offset))
                    offset += length
                number += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], [x.split()[0] for x in OUT.split(", ")])

        for b in dicts(batches):
            for row in zip(b["doc_id"], b["start"], b["doc_tokens"], b["ids"], strict=True):
                held.append(row)
                if len(held) == shard:
                    yield flush()
        if held:
            yield flush()

    near = tails.select("doc_id", "start", "doc_tokens", "ids", "near").repartitionByRange("near", "doc_id").sortWithinPartitions("near", "doc_id", "ids")
    return whole.unionByName(near.select("doc_id", "start", "doc_tokens", "ids").mapInArrow(run, OUT))


def query(docs: DataFrame) -> DataFrame:
    return pack(docs)
