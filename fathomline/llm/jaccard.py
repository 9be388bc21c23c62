"""N-gram Jaccard join: size-aware, heavy and light.

Documents are sets of word shingles; two link when ``den * |A n B| >= num * |A u B|``. Equal sets form one class and
are joined as one. Shingles are in one global order: those found to be frequent last, by count, the others by
hash. With o = ceil(num / den * n), a set of n shingles shares at least o with any partner, so the first c common
shingles lie among its first n - o + c.

* Small sets (light) enumerate all subsets of ``SUBSET`` shingles of that prefix; partners share such a subset.
* Large sets (heavy) enter the inverted lists of the shingles of their prefix (c = 1), which are scanned.
* Sets near enough to the boundary to have partners on its other side do both. The boundary is chosen by
  cost: subsets to write for all sets up to it against prefix shingles and the list entries they meet,
  from the histogram of set sizes over the whole table.

Lists are counted by an aggregation and met by a join, both of which take hot keys apart; no list is sorted or numbered
in one task. First each class is compared with the least member of one of its lists, which connects most near
copies of one text. What is connected by then is not compared again, and lists whose members are all connected are
dropped. Lists of at most SHORT classes are then met pair by pair; longer ones by blocks: the members of a list that
are not in its largest component are the few, and only blocks of these meet other blocks, as matrices of
bitmaps. In up to LINK_ROUNDS rounds each member names the one best partner it has in another component, so rows grow with the
members, not with their pairs; those are compared and the components merged. A member that finds none has none and leaves; the first
round is held over the small bitmaps of the profile, so that finer ones are made only of who is left. In the end what is left unrefuted
between components is named whole, each pair in the first list that its members are seen to share. Pairs pass a size test and a
parity-bitmap test (the bitmaps differ in no more bits than the sets do in members) before the sets themselves
are compared. The sets are computed again from the texts for the classes that need them, found through a bitmap of bounded
size and a join. Nothing is dropped: each pair with a common signature is connected, refuted or compared.

A class is named by 64 bits of its set; where a second hash shows that two sets have one name, these are named by both.

Edge cases: null or empty texts and texts without words have the empty set and link with nothing; texts of
fewer words than a shingle have one shingle, the whole sequence; repeated rows share a class; documents with a
null id link as others do but never name a component (but one of none but those has a null id); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import lean, scratch, small_batches, staged, text_or_empty
from fathomline.llm.components import components
from fathomline.llm.shingles import mix, shingle_sets

SUBSET = 2
#: Frequent shingles put last in the order, at most; the order never changes results.
FREQUENT = 1 << 18
FREQUENT_COUNT = 16
LOCAL_COUNT = 2
#: Lists of at most so many classes are met pair by pair; longer ones by blocks of about so many members or bytes.
SHORT = 16
BLOCK = 1024
BLOCK_BYTES = 8 << 20
#: Rounds in which members of long lists name their best partner, before what is left is named whole.
LINK_ROUNDS = 3
#: Of a member, so many of its lists are known to the tasks of its blocks.
NAMED = 4
#: Bits of the bitmap that tells which classes need their sets.
FILTER_BITS = 1 << 24
#: Up to so many classes, their text hashes are sent to all tasks instead.
FEW = 20_000
#: Shingles that a task counts at once, and distinct ones it keeps counts of.
_HELD = 1_000_000


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)


def bitmap(shingles: np.ndarray, wide: int = 2, least: int = 64) -> bytes:
    """Parities of the counts of shingles by hash, in the next power of two of ``wide`` n bits, ``least`` at least."""
    bits = least
    while bits < wide * len(shingles):
        bits *= 2
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fine_bitmap(shingles: np.ndarray) -> bytes:
    """16 bits for each shingle as far as that stays below a kilobyte, then 2: near copies of usual length seldom pass by chance."""
    return bitmap(shingles, 16 if len(shingles) <= 512 else 2, 64 if len(shingles) <= 512 else 8192)


def bits_apart(a: bytes, b: bytes) -> int:
    """In how many bits two bitmaps differ; the longer is folded, which never adds differences."""
    if len(a) < len(b):
        a, b = b, a
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    n = len(a)
    while n > len(b):
        n //= 2
        x = (x >> (n * 8)) ^ (x & ((1 << (n * 8)) - 1))
    return (x ^ y).bit_count()


def most_apart(na: int, nb: int, num: int, den: int) -> int:
    """The greatest symmetric difference of two linked sets of these sizes."""
    return na + nb - 2 * ceil_div(num * (na + nb), num + den)


class Scheme:
    """Which signatures a set of n shingles writes."""

    def __init__(self, num: int, den: int, boundary: int, subset: int = SUBSET) -> None:
        self.num, self.den, self.boundary, self.subset = num, den, boundary, subset
        self.least = next(n for n in range(1, 10**6) if self.overlap(n) >= subset)  # smaller sets have no such subsets to share

    def overlap(self, n: int) -> int:
        return ceil_div(self.num * n, self.den)

    def prefix(self, n: int, c: int) -> int:
        return min(n, n - self.overlap(n) + c)

    def light(self, n: int) -> bool:
        return self.least <= n <= self.boundary

    def heavy(self, n: int) -> bool:
        """Not light, or of a size that a partner which is not light may have."""
        return not self.light(n) or n * self.den >= self.num * (self.boundary + 1) or self.num * n <= self.den * (self.least - 1)

    def signatures(self, ordered: np.ndarray) -> np.ndarray:
        n, out = len(ordered), []
        if self.heavy(n):
            out.append(ordered[: self.prefix(n, 1)])
        if self.light(n):
            pre = ordered[: self.prefix(n, self.subset)]
            at = np.array(list(combinations(range(len(pre)), self.subset)))
            h = np.zeros(len(at), np.uint64)
            for j in range(self.subset):
                h = mix(h * np.uint64(0xD6E8FEB86659FD93) + pre[at[:, j]], 7)
            out.append(h)
        return np.concatenate(out) if len(out) > 1 else out[0]


def choose_boundary(sizes: dict[int, int], met: float, num: int, den: int, subset: int = SUBSET) -> int:
    """The size up to which enumerating subsets is cheapest in all. ``met``: other entries a prefix shingle meets in its list."""
    s = Scheme(num, den, 0, subset)
    best, cost, total = s.least - 1, 0.0, 0.0
    for n in range(s.least, 256):
        total += sizes.get(n, 0) * (comb(s.prefix(n, subset), subset) - s.prefix(n, 1) * (1 + met))
        if total <= cost:
            best, cost = n, total
        if comb(s.prefix(n, subset), subset) > 1000:
            break
    return best


def _texts(b: pa.RecordBatch, name: str = "text") -> list[bytes]:
    return [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in b.column(b.schema.get_field_index(name)).cast(pa.large_binary())]


def _set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set: a sum of one hash of its members and an exclusive or of another."""
    return int(mix(s, 3).sum(dtype=np.uint64).astype(np.int64)), int(np.bitwise_xor.reduce(mix(s, 4)).astype(np.int64))


def _renamed(cid: int, check: int) -> int:
    both = np.array([cid, check], np.int64).view(np.uint64)
    return int(mix(mix(both[:1], 5) + both[1:], 6).astype(np.int64)[0])


def _name(s: np.ndarray, shared: frozenset[int]) -> int:
    """The class of a set; ``shared``: names that two sets have, so that the second hash takes part."""
    cid, check = _set_key(s)
    return _renamed(cid, check) if cid in shared else cid


def profile(docs: DataFrame, k: int, shared: frozenset[int] = frozenset()) -> DataFrame:
    """One row per document (kind 0: doc_id, row hash, n, class, check, bitmap), and per task its frequent shingles
    (kind 1: class = shingle, n = documents, counted lossily) and totals (kind 2: n shingles, class distinct ones)."""
    names = ["kind", "doc_id", "h", "n", "cid", "check", "bits"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        known, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        total = fresh = 0

        def fold() -> None:
            nonlocal held, size, known, counts, total, fresh
            u, n = np.unique(np.concatenate(held), return_counts=True)
            total, fresh = total + int(n.sum()), fresh + len(u)
            u, n = u[n > 1], n[n > 1]
            if len(known):
                both, inverse = np.unique(np.concatenate([known, u]), return_inverse=True)
                known, counts = both, np.bincount(inverse, np.concatenate([counts, n]), len(both)).astype(np.int64)
            else:
                known, counts = u, n
            if len(known) > _HELD // 2:
                keep = counts >= LOCAL_COUNT
                known, counts = known[keep], counts[keep]
            held, size = [], 0

        for b in batches:
            if not b.num_rows:
                continue
            sets = shingle_sets(_texts(b), k)
            keys = [(_name(s, shared), _set_key(s)[1]) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * len(sets), kinds[0]), b.column(0), b.column(1), pa.array([len(s) for s in sets], kinds[3]), pa.array([c for c, _ in keys], kinds[4]), pa.array([c for _, c in keys], kinds[5]), pa.array([bitmap(s) if len(s) else None for s in sets], kinds[6])], names
            )
            held += sets
            size += sum(map(len, sets))
            if size > _HELD:
                fold()
        if size:
            fold()
        keep = counts >= LOCAL_COUNT
        u, n = known[keep].astype(np.int64), counts[keep]
        none = lambda m, t: pa.nulls(m, t)
        for i in range(0, len(u), 100_000):
            m = len(u[i : i + 100_000])
            yield pa.RecordBatch.from_arrays([pa.array([1] * m, kinds[0]), none(m, kinds[1]), none(m, kinds[2]), pa.array(n[i : i + m], kinds[3]), pa.array(u[i : i + m], kinds[4]), none(m, kinds[5]), none(m, kinds[6])], names)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([2], kinds[0]), none(1, kinds[1]), none(1, kinds[2]), pa.array([total], kinds[3]), pa.array([fresh], kinds[4]), none(1, kinds[5]), none(1, kinds[6])], names)

    schema = "kind int, doc_id long, h long, n long, cid long, check long, bits binary"
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text")).mapInArrow(lean(run), schema)


class Order:
    """The global order of shingles."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray) -> None:
        at = np.argsort(frequent)
        self.frequent, self.counts = frequent[at], counts[at]

    def sort(self, s: np.ndarray) -> np.ndarray:
        """``s`` is sorted by hash."""
        if not len(self.frequent):
            return s
        at = np.minimum(np.searchsorted(self.frequent, s), len(self.frequent) - 1)
        last = self.frequent[at] == s
        if not last.any():
            return s
        tail = s[last]
        return np.concatenate([s[~last], tail[np.lexsort((tail, self.counts[at[last]]))]])


def _signatures(docs: DataFrame, k: int, shared: frozenset[int], order: Order, scheme: Scheme) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            sigs, cids = [], []
            for s in shingle_sets(_texts(b), k) if b.num_rows else []:
                if not len(s) or (cid := _name(s, shared)) in seen:
                    continue  # of equal sets in a task, one writes
                seen.add(cid)
                sig = scheme.signatures(order.sort(s))
                sigs.append(sig)
                cids.append(np.full(len(sig), cid, np.int64))
            if sigs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).astype(np.int64)), pa.array(np.concatenate(cids))], ["sig", "cid"])

    return docs.select(text_or_empty().alias("text")).mapInArrow(lean(run), "sig long, cid long")


def _sets(docs: DataFrame, k: int, shared: frozenset[int], needed: DataFrame, rows: DataFrame) -> DataFrame:
    """(cid, set) of the classes in ``needed``, one row each, from one pass over the texts.

    A few classes are found by the hash of a text of theirs, so that only those texts leave the scan. Many are found
    through a bitmap of their ids of bounded size, where the sets are made, and a join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            cids, sets = [], []
            for s in shingle_sets(_texts(b), k) if b.num_rows else []:
                if not len(s) or (cid := _name(s, shared)) in seen:
                    continue
                at = cid % FILTER_BITS
                if flags is None or flags[at >> 3] >> (at & 7) & 1:
                    seen.add(cid)
                    cids.append(cid)
                    sets.append(s.tobytes())
            if cids:
                yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(sets, pa.binary())], ["cid", "members"])

    texts, flags = docs.select(text_or_empty().alias("text")), None
    if needed.count() <= FEW:
        one = rows.join(F.broadcast(needed), "cid").groupBy("cid").agg(F.min("h").alias("text_hash")).select("text_hash")
        texts = texts.join(F.broadcast(one), F.xxhash64("text") == F.col("text_hash"), "left_semi")
    else:
        slot = (F.pmod("cid", F.lit(FILTER_BITS)) + 1).alias("slot")  # bitmap positions count from 1
        parts = needed.select(slot).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
        flags = np.zeros(FILTER_BITS // 8 + 4096, np.uint8)  # FILTER_BITS bits, whatever the number of classes
        for r in parts:
            flags[(r["bucket"] - 1) * 4096 :][:4096] = np.frombuffer(r["bits"], np.uint8)
    return texts.mapInArrow(lean(run), "cid long, members binary").join(needed, "cid", "left_semi").dropDuplicates(["cid"])


def _fine(sets: DataFrame) -> DataFrame:
    """(cid, n, bits): fine bitmaps of sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [np.frombuffer(x.as_buffer(), np.uint64) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in each], pa.int64()), pa.array([fine_bitmap(s) for s in each], pa.binary())], ["cid", "n", "bits"])

    return sets.select("cid", "members").mapInArrow(lean(run), "cid long, n long, bits binary")


def _near(pairs: DataFrame, bits: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose sizes and bitmaps do not refute them."""

    @F.pandas_udf("boolean")
    def may(a, b, na, nb):  # noqa: ANN001
        import pandas as pd

        return pd.Series([bits_apart(x, y) <= most_apart(m, n, num, den) for x, y, m, n in zip(a, b, na.tolist(), nb.tolist(), strict=True)], dtype=bool)

    one = bits.select(F.col("cid").alias("a"), F.col("bits").alias("bits_a"), F.col("n").alias("na"))
    two = bits.select(F.col("cid").alias("b"), F.col("bits").alias("bits_b"), F.col("n").alias("nb"))
    sizes = F.least("na", "nb") * den >= F.greatest("na", "nb") * num
    return pairs.join(one, "a").join(two, "b").where(sizes).where(may("bits_a", "bits_b", "na", "nb")).select("a", "b")


def bits_apart_all(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many bits each row of a differs from each row of b; 64-bit words, the wider matrix is folded."""
    while a.shape[1] > b.shape[1]:
        a = a[:, : a.shape[1] // 2] ^ a[:, a.shape[1] // 2 :]
    while b.shape[1] > a.shape[1]:
        b = b[:, : b.shape[1] // 2] ^ b[:, b.shape[1] // 2 :]
    return np.stack([np.bitwise_count(row ^ b).sum(1, dtype=np.int64) for row in a]) if len(a) else np.empty((0, len(b)), np.int64)


def _meetings(at: DataFrame, fine: DataFrame) -> DataFrame:
    """One row per member of a list and two blocks that meet there, the member in one of them.

    Members of the largest component of a list have blocks of their own, which meet only those of the others. Blocks
    are drawn by hash; their number comes from counts and bytes, so no list is sorted or numbered anywhere. ``inner``: the
    first block meets itself there too, so a list of one block for each kind has one row for each member."""
    sizes = at.join(fine.select("cid", F.length("bits").alias("n")), "cid").groupBy("sig", "label").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    whole = sizes.groupBy("sig").agg(F.max_by("label", "c").alias("major"), F.sum("c").alias("c"), F.sum("n").alias("n"), F.max("c").alias("mc"), F.max_by("n", "c").alias("mn"))
    cut = lambda c, n: F.greatest(F.ceil(c / BLOCK), F.ceil(n / BLOCK_BYTES)).cast("int")
    whole = whole.select("sig", "major", cut(F.col("c") - F.col("mc"), F.col("n") - F.col("mn")).alias("few"), cut(F.col("mc"), F.col("mn")).alias("many"))
    rows = at.join(whole, "sig").join(fine, "cid")
    draw = F.xxhash64("cid", F.lit(11))
    block = F.when(F.col("label") == F.col("major"), F.col("few") + F.pmod(draw, F.col("many"))).otherwise(F.pmod(draw, F.col("few"))).cast("int")
    rows = rows.withColumn("block", block)
    meets = F.when(F.col("block") >= F.col("few"), F.col("few")).otherwise(F.col("few") + F.col("many"))
    rows = rows.withColumn("other", F.explode(F.filter(F.sequence(F.lit(0), meets - 1), lambda x: x != F.col("block"))))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    inner = F.col("j") == F.col("few") + F.pmod("i", "many")
    return rows.select("sig", "i", "j", inner.alias("inner"), "block", "cid", "n", "label", "bits", "names")


def _of_blocks(at: DataFrame, fine: DataFrame, num: int, den: int, whole: bool) -> DataFrame:
    """Pairs (a, b) of one list, in different components, that sizes and bitmaps do not refute.

    ``whole``: all of them, each in the first list that its members are seen to share. Otherwise each member's best, the one with most
    bits to spare, so at most one row for each member of a block and then for each member."""
    kinds = [("cid", pa.int64()), ("other", pa.int64()), ("spare", pa.int64())]

    def meet(sig: int, i: int, j: int, inner: bool, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[int, int], list[tuple]] = {}
        for block, cid, n, label, bits, names in held:
            groups.setdefault((block, len(bits)), []).append((cid, n, label, bits, names))
        parts = {}
        for key, g in groups.items():
            named = np.full((len(g), NAMED), sig, np.int64)
            for r, x in enumerate(g):
                named[r, : len(x[4])] = x[4]
            parts[key] = (*(np.array([x[c] for x in g], np.int64) for c in (0, 1, 2)), np.frombuffer(b"".join(x[3] for x in g), np.uint64).reshape(len(g), -1), named)
        for (x, wx), (ca, na, la, ba, sa) in parts.items():
            for (y, wy), (cb, nb, lb, bb, sb) in parts.items():
                if not (x == i and (y == j or inner and y == i and wx <= wy)):
                    continue
                na2, nb2 = na[:, None], nb[None, :]
                ok = (np.minimum(na2, nb2) * den >= np.maximum(na2, nb2) * num) & (la[:, None] != lb[None, :])
                if not ok.any():
                    continue
                spare = na2 + nb2 - 2 * -(-num * (na2 + nb2) // (num + den)) - bits_apart_all(ba, bb)
                ok &= spare >= 0
                if whole:
                    for c in range(NAMED):
                        for d in range(NAMED):
                            ok &= ~((sa[:, c, None] == sb[None, :, d]) & (sa[:, c, None] < sig))
                    p, q = np.nonzero(ok)
                    if len(p):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ca[p], cb[q])), pa.array(np.maximum(ca[p], cb[q])), pa.array(spare[p, q])], [k for k, _ in kinds])
                    continue
                spare = np.where(ok, spare, -1)
                for best, own, others in ((spare.argmax(1), ca, cb), (spare.argmax(0), cb, ca)):
                    left = spare[np.arange(len(own)), best] if own is ca else spare[best, np.arange(len(own))]
                    has = np.flatnonzero(left >= 0)
                    if len(has):
                        yield pa.RecordBatch.from_arrays([pa.array(own[has]), pa.array(others[best[has]]), pa.array(left[has])], [k for k, _ in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now != r[:4]:
                    if held:
                        yield from meet(*now, held)
                    now, held = r[:4], []
                held.append(r[4:])
        if held:
            yield from meet(*now, held)

    rows = _meetings(at, fine).repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    found = rows.mapInArrow(lean(run), "cid long, other long, spare long")
    if not whole:
        found = found.groupBy("cid").agg(F.max(F.struct("spare", "other")).alias("best")).select("cid", F.col("best.other").alias("other"))
    return found.select(F.least("cid", "other").alias("a"), F.greatest("cid", "other").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(p) + len(q) - len(np.union1d(p, q)) if len(p) + len(q) < 64 else len(np.intersect1d(p, q, assume_unique=True))
                keep.append(den * common >= num * (len(p) + len(q) - common))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("cid").alias("a"), F.col("members").alias("x"))
    two = sets.select(F.col("cid").alias("b"), F.col("members").alias("y"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "x", "y").mapInArrow(lean(run), "a long, b long")


class _State:
    """What is known so far: sets fetched, labels of components."""

    def __init__(self, docs: DataFrame, rows: DataFrame, k: int, shared: frozenset[int], num: int, den: int) -> None:
        self.rows = rows
        self.docs, self.k, self.shared, self.num, self.den = docs, k, shared, num, den
        self.sets: DataFrame | None = None
        self.labels: DataFrame | None = None

    def nodes(self, pairs: DataFrame) -> DataFrame:
        return staged(pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct(), "jaccard-nodes")

    def fetch(self, needed: DataFrame) -> None:
        """Get the sets of classes that are not there yet."""
        if self.sets is not None:
            needed = needed.join(self.sets.select("cid"), "cid", "left_anti")
        needed = staged(needed, "jaccard-needed")
        if self.sets is None or needed.limit(1).count():
            more = staged(_sets(self.docs, self.k, self.shared, needed, self.rows), "jaccard-sets")
            self.sets = more if self.sets is None else self.sets.unionByName(more)

    def still_open(self, lists: DataFrame, longer_than: int = 1) -> DataFrame:
        """Lists that have members in several components: (sig, cid, first), the label and the number of members."""
        if self.labels is None:
            at = lists.withColumn("label", F.col("cid"))
        else:
            at = lists.join(self.labels, F.col("cid") == F.col("node"), "left").select(*lists.columns, F.coalesce("label", "cid").alias("label"))
        apart = at.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("members"))
        apart = apart.where((F.col("lo") != F.col("hi")) & (F.col("members") > longer_than)).select("sig", "members")
        return staged(at.join(staged(apart, "jaccard-apart"), "sig"), "jaccard-open")

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Pairs that are not connected yet."""
        if self.labels is None:
            return pairs
        one = self.labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        two = self.labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        return pairs.join(one, "a", "left").join(two, "b", "left").where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")

    def compare(self, pairs: DataFrame) -> tuple[bool, DataFrame]:
        """Whether any of the pairs link, and the classes that stand in them; if any link, their components are merged."""
        pairs = staged(pairs, "jaccard-compare")
        nodes = self.nodes(pairs)
        if not pairs.limit(1).count():
            return False, nodes
        self.fetch(nodes)
        sets = self.sets.join(nodes, "cid", "left_semi")
        found = staged(_verified(pairs, sets, self.num, self.den), "jaccard-links")
        linked = bool(found.limit(1).count())
        if linked:
            self.join(found)
        return linked, nodes

    def join(self, links: DataFrame) -> None:
        """Merge components along links: these are few nodes, the labels so far, however large the components."""
        if self.labels is None:
            self.labels = components(links)
            return
        one = self.labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        two = self.labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        roots = links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
        merged = components(roots)
        moved = merged.select(F.col("node").alias("label"), F.col("label").alias("to"))
        old = self.labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        new = merged.join(self.labels.select("node"), "node", "left_anti").select("node", "label")
        self.labels = staged(old.unionByName(new), "jaccard-labels")


def _shared_names(table: DataFrame) -> frozenset[int]:
    """Names that two sets have: of 10^10 sets, some three."""
    named = table.where("kind = 0 and n > 0").groupBy("cid").agg(F.min("check").alias("x"), F.max("check").alias("y"))
    return frozenset(r["cid"] for r in named.where("x <> y").select("cid").collect())


def linked_classes(docs: DataFrame, k: int, num: int, den: int, boundary: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Documents (doc_id, h, n, cid) and, if any classes link, (node, label) of those: the components of classes."""
    small_batches(docs.sparkSession)
    table = staged(profile(docs, k), "jaccard-profile")
    shared = _shared_names(table)
    if shared:
        table = staged(profile(docs, k, shared), "jaccard-profile")
    rows = table.where("kind = 0")
    frequent = table.where("kind = 1").groupBy("cid").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_COUNT).orderBy(F.desc("n"), "cid").limit(FREQUENT).collect()
    order = Order(np.array([r["cid"] for r in frequent], np.int64).view(np.uint64), np.array([r["n"] for r in frequent], np.int64))
    if boundary is None:
        sizes = {r["n"]: r["count"] for r in rows.where("n > 0").groupBy(F.least("n", F.lit(256)).alias("n")).count().collect()}
        total, distinct = table.where("kind = 2").agg(F.sum("n"), F.sum("cid")).first()
        boundary = choose_boundary(sizes, (total or 0) / max(1, distinct or 0) - 1 if total else 0.0, num, den)
    scheme = Scheme(num, den, boundary)

    # Lists of two classes or more, each class once.
    with scratch(docs.sparkSession):
        entries = staged(_signatures(docs, k, shared, order, scheme), "jaccard-signatures")
        several = entries.groupBy("sig").agg(F.min("cid").alias("first"), F.max("cid").alias("last")).where("first <> last").select("sig", "first")
        lists = staged(entries.join(several, "sig").groupBy("sig", "cid", "first").agg(F.lit(1).alias("one")).drop("one"), "jaccard-lists", keep=True)
    bits = staged(rows.where("n > 0").groupBy("cid").agg(F.first("bits").alias("bits"), F.first("n").alias("n")), "jaccard-bitmaps")
    state = _State(docs, rows, k, shared, num, den)

    def near(pairs: DataFrame) -> DataFrame:
        return staged(_near(state.apart(pairs), bits, num, den), "jaccard-pairs")

    def compare(pairs: DataFrame) -> None:
        # One partner for each class first, where there are many: near copies of one text are mostly connected by that.
        n, classes = pairs.agg(F.count("*"), F.count_distinct("b")).first()
        if n > 2 * classes:
            state.compare(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
            pairs = state.apart(pairs)
        state.compare(pairs)

    state.compare(near(lists.where("first <> cid").groupBy(F.col("cid").alias("b")).agg(F.min("first").alias("a")).select("a", "b")))
    at = state.still_open(lists)
    short = at.where(F.col("members") <= SHORT).select("sig", "cid", "label")
    two = short.select("sig", F.col("cid").alias("b"), F.col("label").alias("lb"))
    pairs = short.join(two, "sig").where("cid < b and label <> lb").select(F.col("cid").alias("a"), "b")
    first = at.where((F.col("members") > SHORT) & (F.col("first") != F.col("cid"))).select(F.col("first").alias("a"), F.col("cid").alias("b"))
    compare(near(pairs.unionByName(first).distinct()))

    at = state.still_open(at.select("sig", "cid", "first"), SHORT)
    if at.limit(1).count():

        def of_blocks(by: DataFrame, whole: bool) -> DataFrame:
            names = at.groupBy("cid").agg(F.sort_array(F.collect_list("sig")).alias("names")).select("cid", F.slice("names", 1, NAMED).alias("names"))
            return _of_blocks(at.select("sig", "cid", "label"), by.join(names, "cid"), num, den, whole)

        def fine() -> DataFrame:
            members = staged(at.select("cid").distinct(), "jaccard-members")
            state.fetch(members)
            return staged(_fine(state.sets.join(members, "cid", "left_semi")), "jaccard-fine")

        by = bits
        for turn in range(LINK_ROUNDS):
            linked, named = state.compare(of_blocks(by, False))
            # Who has a partner names one, so all others are done. Lists that become short by that have not been met yet.
            at = state.still_open(at.select("sig", "cid", "first").join(named, "cid", "left_semi"))
            if turn == 0:
                by = fine()
            if not linked:
                break
        state.compare(of_blocks(by if by is not bits else fine(), True))
    return rows.select("doc_id", "h", "n", "cid"), state.labels


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, boundary: int | None = None) -> DataFrame:
    """Per document (doc_id, h, n_shingles, component_id, first_h): the component's least doc_id and, of the rows with
    it, the least xxhash64 of a text; h is that of the row's own text."""
    with scratch(docs.sparkSession):
        rows, labels = linked_classes(docs, k, num, den, boundary)
        if labels is None:
            named = rows.withColumn("label", F.col("cid"))
        else:
            named = rows.join(labels, F.col("cid") == F.col("node"), "left").select("doc_id", "h", "n", F.coalesce("label", "cid").alias("label"))
        named = named.select("doc_id", "h", "n", "label")
        least = named.where("label is not null").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("least"), F.count("*").alias("members"))
        # Components of one need no join, so only those of more meet.
        least = staged(least.where("members > 1").select("label", "least"), "jaccard-least")
        out = named.join(least, "label", "left")
        alone = F.col("least").isNull()
        out = out.select("doc_id", "h", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"), F.when(alone, F.col("h")).otherwise(F.col("least.h")).alias("first_h"))
        return staged(out, "jaccard-found", keep=True)


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, k=4, num=85, den=100).select("doc_id", "n_shingles", "component_id")
