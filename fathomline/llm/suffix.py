"""Suffix-array deduplication: bytes covered by a string of ``LENGTH`` bytes that starts anywhere else, removed.

Which suffixes must meet. Each possible start i of a string of LENGTH bytes is owned by one anchor: the least
hash of the GRAM-byte strings inside the LENGTH bytes from i (leftmost on ties). Equal strings have equal anchors at
equal distances, and the starts of one anchor are a run, so a document is cut into fragments (a run and the bytes
its strings span), named by (anchor hash, digest). A fragment whose anchor hash occurs once has no repeated string.
Fragments that occur more than once are repeated throughout. Only anchors with several different fragments
are left: there one text of each fragment enters the suffix sort.

The sort is two-stage, over blocks of whole anchor groups: suffixes smaller than their successors are
sorted directly; the others are induced by scanning the buckets of first bytes in order, each suffix placing its
predecessor. Common prefixes of adjacent suffixes of LENGTH bytes or more mark repeated starts.

Skew: equal documents are one text throughout (a document with an equal partner is removed whole, if it is long
enough, and its text still meets the others). Anchors are counted after partial aggregation. Anchor groups of more
than GROUP fragments are salted over several sorts; what is left unmatched there, and one suffix of each class found,
meet in an aggregation, first by a hash of the bytes that some neighbouring strings share, then by that of each.

Edge cases: a null text is empty; texts shorter than LENGTH bytes keep all; strings never cross documents; repeated
rows are equal documents; runs of one byte or of a period collapse into counted fragments; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import small_batches, staged, text_or_empty
from fathomline.llm.shingles import blocks, mix, prefix_hashes

LENGTH, GRAM = 200, 64
GROUP = 1000
NEIGHBOURS = 8
BLOCK_BYTES = 1 << 20
_LOW = np.uint64(0xFFFFFFFF)


# -- the sort


def two_stage(text: bytes, depth: int = LENGTH) -> np.ndarray:
    """The suffix array, exact in the first ``depth`` bytes of each suffix."""
    t = np.frombuffer(text, np.uint8)
    n = len(t)
    if n < 2:
        return np.arange(n)
    after = np.append(t[1:].astype(np.int16), -1)
    differs = np.flatnonzero(t != after)
    rising = (t < after)[differs[np.searchsorted(differs, np.arange(n))]]  # a run of equal bytes is as its last
    letters = text.decode("latin-1")
    direct = np.array(sorted(np.flatnonzero(rising).tolist(), key=lambda i: letters[i : i + depth]), np.int64)
    first = t[direct] if len(direct) else t[:0]
    cuts = np.searchsorted(first, np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    pending[t[-1]].append(np.array([n - 1], np.int64))  # what the end of the text induces
    out = []
    for c in np.unique(t).tolist():
        layer = np.concatenate(pending[c]) if pending[c] else np.empty(0, np.int64)
        bucket = []
        while len(layer):  # suffixes of one, two ... times this byte before a smaller one
            bucket.append(layer)
            before = layer[layer > 0] - 1
            layer = before[t[before] == c]
        bucket.append(direct[cuts[c] : cuts[c + 1]])
        done = np.concatenate(bucket)
        out.append(done)
        before = done[done > 0] - 1
        byte = t[before]
        before, byte = before[byte > c], byte[byte > c]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        at = np.flatnonzero(np.diff(byte)) + 1
        for part in np.split(before, at):
            if len(part):
                pending[t[part[0]]].append(part)
    return np.concatenate(out)


def common_prefixes(text: bytes, p: np.ndarray, q: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Bytes that the suffixes p[i] and q[i] share, ``most`` at most; both have that many."""
    t = np.frombuffer(text + bytes(8), np.uint8)
    word = np.zeros(len(text) + 1, np.uint64)
    for j in range(8):
        word |= t[j : j + len(word)].astype(np.uint64) << np.uint64(8 * j)
    out = np.full(len(p), most, np.int64)
    live = np.arange(len(p))
    for k in range(0, most, 8):
        apart = word[p[live] + k] ^ word[q[live] + k]
        here = apart != 0
        if here.any():
            low = apart[here] & (~apart[here] + np.uint64(1))
            out[live[here]] = np.minimum(most, k + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3))
            live = live[~here]
    return out


def repeated_starts(fragments: list[tuple[bytes, int]], length: int = LENGTH) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of fragments (bytes, owned starts): which owned starts have an equal string elsewhere in the block; and which
    of those lead their class, the first in suffix order."""
    text = b"".join(f for f, _ in fragments)
    base = np.cumsum([0] + [len(f) for f, _ in fragments])
    owned = np.zeros(len(text), bool)
    for at, (_, n) in zip(base, fragments, strict=False):
        owned[at : at + n] = True
    array = two_stage(text, length)
    array = array[owned[array]]
    equal = np.zeros(len(array) + 1, bool)
    equal[1:-1] = common_prefixes(text, array[:-1], array[1:], length) >= length
    hit, lead = np.zeros(len(text), bool), np.zeros(len(text), bool)
    hit[array] = equal[:-1] | equal[1:]
    lead[array] = ~equal[:-1] & equal[1:]
    cut = lambda x: [x[at : at + n] for at, (_, n) in zip(base, fragments, strict=False)]
    return cut(hit), cut(lead)


# -- fragments


def fragments(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """For blocks of texts: arrays (index of text, anchor hash, digest, start, owned starts, copies) of their fragments.
    Neighbouring equal fragments of one text are one with their number in ``copies``."""
    window = length - gram + 1
    for a, b in blocks(texts):
        part = texts[a:b]
        size = np.array([len(t) for t in part])
        data = np.frombuffer(b"".join(part), np.uint8)
        if len(data) < length:
            continue
        at = np.cumsum(size) - size
        sums, scale = prefix_hashes(data)
        g = mix((sums[gram:] - sums[:-gram]) * scale[: len(data) - gram + 1], 11)
        least = (g & ~_LOW) | np.arange(len(g), dtype=np.uint64)
        span = 1
        while span * 2 <= window:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if window > span:
            least = np.minimum(least[: len(least) - (window - span)], least[window - span :])
        owner = (least & _LOW).astype(np.int64)
        mark = np.zeros(len(data) + 1, np.int8)
        long = size >= length
        mark[at[long]] += 1
        np.subtract.at(mark, at[long] + size[long] - length + 1, 1)
        start = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
        if not len(start):
            continue
        own = owner[start]
        new = np.flatnonzero(np.append(True, (np.diff(start) != 1) | (np.diff(own) != 0)))
        # Starts of neighbouring texts are consecutive only if the first text has no tail, which LENGTH > 1 rules out.
        n = np.diff(np.append(new, len(start)))
        first, own = start[new], own[new]
        doc = np.searchsorted(at, first, side="right") - 1
        end = first + n - 1 + length
        digest = mix((sums[end] - sums[first]) * scale[first] + n.astype(np.uint64), 12)
        same = np.append(False, (g[own[1:]] == g[own[:-1]]) & (digest[1:] == digest[:-1]) & (n[1:] == n[:-1]) & (doc[1:] == doc[:-1]) & (first[1:] == first[:-1] + n[:-1]))
        head = np.flatnonzero(~same)
        copies = np.diff(np.append(head, len(first)))
        yield a + doc[head], g[own[head]].astype(np.int64), digest[head].astype(np.int64), first[head] - at[doc[head]], n[head], copies


def neighbours(fragment: bytes, n: int, shown: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of some owned starts: (hash of the bytes shared, starts, hashes of their strings), NEIGHBOURS starts or fewer together."""
    sums, scale = prefix_hashes(np.frombuffer(fragment, np.uint8))
    keys = mix((sums[length : length + n] - sums[:n]) * scale[:n], 13).astype(np.int64)
    g = mix((sums[gram:] - sums[:-gram]) * scale[: len(fragment) - gram + 1], 11)[: length - gram + 1]
    anchor = int(np.argmin(g >> np.uint64(32)))
    group = (anchor - shown) // NEIGHBOURS
    for b in np.unique(group).tolist():
        first = anchor - b * NEIGHBOURS  # the last start of the group; all its strings hold the bytes from here
        end = first - NEIGHBOURS + 1 + length
        key = int(mix((sums[end : end + 1] - sums[first : first + 1]) * scale[first : first + 1] + np.uint64(b), 14).astype(np.int64)[0])
        at = shown[group == b]
        yield key, at, keys[at]


def _runs(flags: np.ndarray) -> np.ndarray:
    """[from, to) pairs, flat, of the runs of true."""
    return np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))


# -- Spark


def _column(b: pa.RecordBatch, name: str) -> list:
    return b.column(b.schema.get_field_index(name)).to_pylist()


def _fragment_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(hash, digest, rid, start, n, copies); of equal texts in a task, one writes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            rids, data = [], []
            for r, t in zip(_column(b, "rid"), _column(b, "data"), strict=True):
                if len(t) >= length and r not in seen:
                    seen.add(r)
                    rids.append(r)
                    data.append(t)
            rid = np.array(rids, np.int64)
            for doc, *rest in fragments(data, length, gram):
                h, d, s, n, c = rest
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(d), pa.array(rid[doc]), pa.array(s.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(c.astype(np.int32))], ["hash", "digest", "rid", "start", "n", "copies"])

    return texts.select("rid", "data").mapInArrow(run, "hash long, digest long, rid long, start int, n int, copies int")


def _compressed(texts: DataFrame, once: bool) -> DataFrame:
    """Texts as zstd frames, for shuffles; ``once``: of equal texts in a task, one."""
    names = [c for c in texts.columns if c != "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        seen: set[int] = set()
        for b in batches:
            keep = []
            for r in _column(b, "rid"):
                keep.append(not (once and r in seen))
                seen.add(r) if once else None
            b = b.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in names), pa.array([pack(t) for t in _column(b, "data")], pa.binary())], [*names, "packed"])

    schema = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in names) + ", packed binary"
    return texts.mapInArrow(run, schema)


def _sorted_groups(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Suffix sort of (hash, salt, salted, digest, single, rid, start, n, fragment), whole (hash, salt) groups together.

    Kind 0: (rid, lo, hi) repeated starts of single fragments. Kind 1, of salted groups: what is unmatched, and one
    suffix of each class. These rows hold the starts of up to NEIGHBOURS neighbouring strings and their hashes;
    ``key`` is a hash of the bytes that the strings share, cut at places counted from the anchor, so strings
    that are equal are in rows whose keys are.
    """
    names = ["kind", "rid", "lo", "hi", "hash", "key", "single", "starts", "keys"]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            hits, leads = repeated_starts([(r["fragment"], r["n"]) for r in held], length)
            out = []
            for r, hit, lead in zip(held, hits, leads, strict=True):
                if r["single"]:
                    edges = (_runs(hit) + r["start"]).tolist()
                    out += [(0, r["rid"], lo, hi, None, None, None, None, None) for lo, hi in zip(edges[::2], edges[1::2], strict=True)]
                if r["salted"]:
                    for key, at, keys in neighbours(r["fragment"], r["n"], np.flatnonzero(lead | ~hit), length, gram):
                        out.append((1, r["rid"], r["start"] + int(at[0]), None, r["hash"], key, r["single"], (at + r["start"]).tolist(), keys.tolist()))
            held.clear()
            for i in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i : i + 20_000], strict=True), kinds, strict=True)], names)

        for b in batches:
            for r in b.to_pylist():
                group = r["hash"], r["salt"]
                if group != last and size >= BLOCK_BYTES:
                    yield from flush()
                    size = 0
                last = group
                held.append(r)
                size += len(r["fragment"])
        if held:
            yield from flush()

    cols = ["hash", "salt", "salted", "single", "rid", "start", "n", "fragment"]
    return rows.repartition("hash", "salt").sortWithinPartitions("hash", "salt", "digest").select(*cols).mapInArrow(run, "kind int, rid long, lo int, hi int, hash long, key long, single boolean, starts array<int>, keys array<long>")


def repeats(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Of texts (rid, data), rid naming equal texts alike: (rid, lo, hi), the starts [lo, hi) of strings that also start elsewhere
    in another text, or elsewhere in the same."""
    found = _fragment_rows(texts, length, gram)
    place = F.xxhash64("rid", "start")
    again = found.groupBy("hash").agg(F.min(place).alias("x"), F.max(place).alias("y"), F.max("copies").alias("c")).where("x <> y or c > 1").select("hash")
    again = staged(again, "suffix-anchors")
    found = staged(found.join(again, "hash").distinct(), "suffix-fragments")

    kinds = found.groupBy("hash", "digest").agg(F.count("*").alias("times"), F.max("copies").alias("copies"), F.min(F.struct("rid", "start", "n")).alias("at"))
    kinds = staged(kinds.select("hash", "digest", ((F.col("times") == 1) & (F.col("copies") == 1)).alias("single"), "at.*"), "suffix-kinds")
    groups = staged(kinds.groupBy("hash").agg(F.count("*").alias("size"), F.max("single").alias("open")).where("size > 1 and open"), "suffix-groups")

    # Fragments that occur again: repeated throughout.
    whole = found.join(kinds.where("not single").select("hash", "digest"), ["hash", "digest"])
    whole = whole.select("rid", F.col("start").alias("lo"), (F.col("start") + F.col("n") * F.col("copies")).alias("hi"))

    # One text of each other fragment, and of those it may partly equal.
    wanted = kinds.join(groups, "hash").select("rid", F.struct("hash", "digest", "single", "start", "n", "size").alias("want"))
    wanted = staged(wanted.groupBy("rid").agg(F.collect_list("want").alias("wants")), "suffix-wanted")  # a text's own fragments

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        names = ["hash", "digest", "single", "rid", "start", "n", "size", "fragment"]
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        for b in batches:
            rows = []
            for rid, packed, wants in zip(_column(b, "rid"), _column(b, "packed"), _column(b, "wants"), strict=True):
                data = unpack(packed)
                rows += [(w["hash"], w["digest"], w["single"], rid, w["start"], w["n"], w["size"], data[w["start"] : w["start"] + w["n"] - 1 + length]) for w in wants]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    rows = _compressed(texts.select("rid", "data"), True).join(wanted, "rid").select("rid", "packed", "wants")
    rows = rows.mapInArrow(cut, "hash long, digest long, single boolean, rid long, start int, n int, size long, fragment binary")
    salts = F.ceil(F.col("size") / GROUP)
    rows = rows.select("*", F.pmod("digest", salts).alias("salt"), (salts > 1).alias("salted"))
    rows = staged(_sorted_groups(rows, length, gram).distinct(), "suffix-sorted")  # equal texts of several tasks cut the same fragments

    parts = rows.where("kind = 0").select("rid", "lo", "hi")
    met = rows.where("kind = 1")
    place = F.struct("rid", "lo")
    keys = staged(met.groupBy("hash", "key").agg(F.min(place).alias("x"), F.max(place).alias("y")).where("x <> y").select("hash", "key"), "suffix-met")
    each = met.join(keys, ["hash", "key"]).select("hash", "rid", "single", F.explode(F.arrays_zip(F.col("starts").alias("lo"), F.col("keys").alias("string"))).alias("s")).select("hash", "rid", "single", "s.*")
    each = staged(each, "suffix-strings")
    keys = staged(each.groupBy("hash", "string").agg(F.min(place).alias("x"), F.max(place).alias("y")).where("x <> y").select("hash", "string"), "suffix-met")
    across = each.where("single").join(keys, ["hash", "string"]).select("rid", "lo", (F.col("lo") + 1).alias("hi"))
    return whole.unionByName(parts).unionByName(across)


def _named(base: DataFrame, shared: list[int]) -> tuple[DataFrame, DataFrame]:
    """Texts with their id, 64 bits, and one row per id; ``shared``: ids that two texts have, so that a second hash takes their place."""
    rid = F.xxhash64("data")
    if shared:
        rid = F.when(rid.isin(shared), F.xxhash64(F.sha2("data", 256))).otherwise(rid)
    texts = base.withColumn("rid", rid)
    return texts, staged(texts.groupBy("rid").agg(F.count("*").alias("times"), F.min(F.sha2("data", 256)).alias("x"), F.max(F.sha2("data", 256)).alias("y")), "suffix-texts")


def _shared_names(known: DataFrame) -> list[int]:
    """Ids that two texts have: of 10^10 texts, some three."""
    return [r["rid"] for r in known.where("x <> y").select("rid").collect()]


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text_too: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, ``kept``, the remaining bytes."""
    small_batches(docs.sparkSession)
    base = docs.select("doc_id", text_or_empty().cast("binary").alias("data"))
    texts, known = _named(base, [])
    if shared := _shared_names(known):
        texts, known = _named(base, shared)
    twice = known.where("times > 1").select("rid", F.lit(0).alias("lo"), F.lit((1 << 31) - 1).alias("hi"))
    spans = repeats(texts, length, gram).unionByName(twice).groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    spans = staged(spans, "suffix-spans")  # a text's own spans

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * text_too
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * text_too

    def one(data: bytes, spans: list[dict] | None) -> tuple:
        n, runs = len(data), []
        for lo, hi in sorted((s["lo"], min(s["hi"], n - length + 1)) for s in spans or ()):
            if lo < hi:
                if runs and lo <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], hi - 1 + length)
                else:
                    runs.append([lo, hi - 1 + length])
        at, kept = 0, []
        for lo, hi in runs:
            kept.append(data[at:lo])
            at = hi
        kept = b"".join([*kept, data[at:]])
        return n, n - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), *([kept] if text_too else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            if b.num_rows:
                rows = [one(unpack(p), s) for p, s in zip(_column(b, "packed"), _column(b, "spans"), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types[1:], strict=True))], names)

    joined = _compressed(texts.select("doc_id", "rid", "data"), False).join(spans, "rid", "left").select(F.col("doc_id").cast("long").alias("doc_id"), "packed", "spans")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * text_too)


def query(docs: DataFrame) -> DataFrame:
    return deduplicated(docs)
