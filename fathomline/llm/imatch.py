"""I-Match fingerprints with several randomised lexicon subsets, in DataFrame functions only.

The lexicon is the terms (runs of letters and digits, lower-cased) whose document frequency over all documents lies
in a band: in at least max(2, N / 1000) documents and at most max(8, N / 20), that is, of middling inverse document
frequency. Copies of one text that make up more than the lower bound count as one document, so that no group of copies takes
its own terms out of the band. The lexicon is held as a bitmap of 2 ** LEXICON_BITS places by term hash, so its size is fixed; a rare term that
shares a place with a lexicon term counts as one.

A fingerprint sorts the distinct lexicon terms of a text and hashes what is left of them in each of 2 * SUBSETS
random lexicon subsets. Subsets come at two neighbouring densities (1 / 2 ** level and half of that), the level
being that at which a text of its number of terms keeps between one and two of them, so that short and long
texts alike lose only some hashes to an edit. A text with fewer than FEW_TERMS lexicon terms takes all its terms in
their place, by the same subsets; one without terms has the hash of none.
Likeness is the share of equal hashes among the subsets that both fingerprints have and at least one fills.

The next document is found without ranking all rows in one place: rows are dealt into ranges of doc_id, each
range's first row also goes to the range before it (the very first to the last), and a window within each range
looks one row ahead. Ranges hold about RANGE_ROWS rows, more beyond RANGES of them; rows of one doc_id share a range.

Edge cases: a null text is empty; a null doc_id sorts first; rows of one doc_id follow each other by the hash of
their text, so of repeated rows one is the other's next document; the only row of a table is its own next
document; empty texts share one fingerprint; an empty table gives no rows; very long texts are rows as any other; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fathomline.llm.common import staged, text_or_empty

LEXICON_BITS = 20
SUBSETS = 24
RANGE_ROWS = 500
RANGES = 1 << 16
FEW_TERMS = 8
NOT_A_TERM = r"[^\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    """Sorted hashes of the distinct terms."""
    words = F.filter(F.split(F.lower(text), NOT_A_TERM), lambda w: w != "")
    return F.sort_array(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))


def lexicon(docs: DataFrame, text: Column) -> DataFrame:
    """One row, ``bits``: the bitmap of the terms in the band, as 64-bit words."""
    n = docs.count()
    least = max(2, -(-n // 1000))
    h = F.xxhash64(text)
    many = docs.groupBy(h.alias("h")).count().where(F.col("count") > least).collect()  # fewer than 1000 texts, by the bound
    if many:
        n -= sum(r["count"] - 1 for r in many)
        copied = h.isin([r["h"] for r in many])
        one_each = docs.where(copied).groupBy(h.alias("h")).agg(F.first(text).alias("text")).select("text")
        docs, text = docs.where(~copied).select(text.alias("text")).unionByName(one_each), F.col("text")
    most = max(8, n // 20)
    df = docs.select(F.explode(terms(text)).alias("term")).groupBy("term").agg(F.count("*").alias("df")).where(F.col("df").between(least, most))
    place = F.pmod("term", F.lit(1 << LEXICON_BITS))
    words = df.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))).alias("bits"))
    size = (1 << LEXICON_BITS) // 64
    every = docs.sparkSession.range(size).withColumnRenamed("id", "word")
    full = every.join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return staged(full.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("bits")), "imatch-lexicon")  # a fixed number of words


def with_fingerprint(df: DataFrame, text: str, bits: DataFrame, prefix: str) -> DataFrame:
    """Adds PREFIX_level (int) and PREFIX_subs (array of strings)."""
    known = F.col(f"{prefix}_lexicon")  # a column of its own: a subquery may not stand in a lambda

    def in_lexicon(t: Column) -> Column:
        place = F.pmod(t, F.lit(1 << LEXICON_BITS))
        return F.call_function("shiftrightunsigned", F.get(known, F.shiftright(place, 6).cast("int")), (place % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1

    all_, kept, level, subsets, subs = (f"{prefix}_{x}" for x in ("all", "kept", "level", "subsets", "subs"))
    df = df.withColumn(all_, terms(F.col(text)))
    df = df.withColumn(f"{prefix}_lexicon", bits.scalar()).withColumn(kept, F.filter(all_, in_lexicon)).drop(f"{prefix}_lexicon")
    df = df.withColumn(kept, F.when(F.size(kept) < FEW_TERMS, F.col(all_)).otherwise(F.col(kept)))
    df = df.withColumn(level, F.when(F.size(kept) == 0, -1).otherwise(F.floor(F.log2(F.size(kept).cast("double") + 0.5)) + 1).cast("int"))

    numbers = F.array(*[F.lit(j) for j in range(SUBSETS)])
    mask = F.expr(f"shiftleft(1L, greatest({level}, 0))") - 1
    # A subset of half the density is part of that of the full one, so it is looked for in what that has left.
    full = F.transform(numbers, lambda j: F.filter(kept, lambda t: F.xxhash64(t, j).bitwiseAND(mask) == 0))
    df = df.withColumn(subsets, F.when(F.col(level) < 0, F.array(F.col(all_))).otherwise(full))
    half = F.transform(subsets, lambda s, j: F.filter(s, lambda t: F.xxhash64(t, j).bitwiseAND(mask * 2 + 1) == 0))
    df = df.withColumn(subsets, F.when(F.col(level) < 0, F.col(subsets)).otherwise(F.concat(F.col(subsets), half)))
    hashed = F.transform(subsets, lambda s: F.when((F.size(s) == 0) & (F.col(level) >= 0), "-").otherwise(F.lower(F.lpad(F.hex(F.shiftrightunsigned(F.xxhash64(s), 32)), 8, "0"))))
    return df.withColumn(subs, hashed).drop(all_, kept, subsets)


def as_text(prefix: str) -> Column:
    return F.concat_ws(":", F.col(f"{prefix}_level").cast("string"), F.array_join(f"{prefix}_subs", "."))


def likeness(a: str, b: str) -> Column:
    """Of two fingerprints, 0 to 1."""
    la, lb, x, y = F.col(f"{a}_level"), F.col(f"{b}_level"), F.col(f"{a}_subs"), F.col(f"{b}_subs")
    one, two = (lambda c: F.slice(c, 1, SUBSETS)), (lambda c: F.slice(c, SUBSETS + 1, SUBSETS))
    pairs = F.when(la == lb, F.arrays_zip(x.alias("p"), y.alias("q"))).when(la + 1 == lb, F.arrays_zip(two(x).alias("p"), one(y).alias("q"))).when(la == lb + 1, F.arrays_zip(one(x).alias("p"), two(y).alias("q")))
    filled = F.size(F.filter(pairs, lambda z: (z["p"] != "-") | (z["q"] != "-")))
    equal = F.size(F.filter(pairs, lambda z: (z["p"] != "-") & (z["p"] == z["q"])))
    own = F.when((la >= 0) & (lb >= 0) & (filled > 0), equal / filled)
    return F.when((la == lb) & (x == y), 1.0).otherwise(F.coalesce(own, F.lit(0.0))).cast("double")


def with_next(docs: DataFrame, order: str, tie: str, values: dict[str, str]) -> DataFrame:
    """Adds, for each (name, column) of ``values``, that column of the next row by (order, tie); the last row's next is the first."""
    key = F.coalesce(F.col(order).cast("long"), F.lit(-(1 << 63)).cast("long"))
    n = docs.count()
    ranges = min(RANGES, max(1, -(-n // RANGE_ROWS)))
    cuts = sorted(set(docs.agg(F.min(key), F.percentile_approx(key, [i / ranges for i in range(1, ranges)] or [0.5], max(50_000, 4 * ranges))).select("*").first()[1] or [])) if n else []
    least = docs.agg(F.min(key)).first()[0] if n else 0
    cuts = [c for c in cuts if c > least]
    step = max(64, 1 << (len(cuts).bit_length() // 2))
    lit = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<long>") if xs else F.array().cast("array<long>")
    # Ranges before the key, in two levels: whole steps of cuts, then within one.
    coarse, fine = lit(cuts[step - 1 :: step]), lit(cuts)
    steps = F.size(F.filter(coarse, lambda c: c <= F.col("next_key"))) if cuts else F.lit(0)
    within = F.size(F.filter(F.slice(fine, steps * step + 1, F.lit(step)), lambda c: c <= F.col("next_key"))) if cuts else F.lit(0)
    df = docs.withColumn("next_key", key).withColumn("next_range", steps * step + within)
    # (range, 0: a row, 1: a copy for the row before it, 2: such a copy behind all rows)
    here = F.struct(F.col("next_range").alias("range"), F.lit(0).alias("copy"))
    before = F.struct((F.col("next_range") - 1).alias("range"), F.lit(1).alias("copy"))
    around = F.struct(F.lit(len(cuts)).alias("range"), F.lit(2).alias("copy"))
    is_cut = F.array_contains(F.slice(fine, F.greatest(F.col("next_range"), F.lit(1)), F.lit(1)), F.col("next_key")) & (F.col("next_range") > 0) if cuts else F.lit(False)
    df = df.withColumn("next_at", F.explode(F.when(F.col("next_key") == F.lit(least).cast("long"), F.array(here, around)).when(is_cut, F.array(here, before)).otherwise(F.array(here))))
    by = W.partitionBy(F.col("next_at.range")).orderBy((F.col("next_at.copy") == 2).cast("int"), "next_key", tie, "next_at.copy")
    df = df.select("*", *[F.lead(c).over(by).alias(name) for name, c in values.items()])
    return df.where("next_at.copy = 0").drop("next_key", "next_range", "next_at")


def query(docs: DataFrame) -> DataFrame:
    base = docs.select("doc_id", text_or_empty().alias("text"))
    bits = lexicon(base, F.col("text"))
    base = with_fingerprint(base.withColumn("h", F.xxhash64("text")), "text", bits, "fp")
    rows = with_next(base, "doc_id", "h", {"next_text": "text", "next_level": "fp_level", "next_subs": "fp_subs"})
    quarter = F.expr("length(text) div 4").cast("int")
    rows = rows.withColumn("edited", F.concat(F.left("text", F.length("text") - quarter), F.left("next_text", quarter))).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.select("doc_id", "n_chars", "edited", "fp_level", "fp_subs", "next_level", "next_subs")
    rows = with_fingerprint(rows, "edited", bits, "ed")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text("fp").alias("fingerprint"), as_text("ed").alias("edited_fingerprint"),
        likeness("fp", "ed").alias("near_edited"), likeness("fp", "next").alias("near_next"),
    )
