from __future__ import annotations

import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.llm import common, imatch, jaccard, media, mixing, packing, pii, suffix, tokencount, toxicity, warczip
from fathomline.llm import queries as registered
from fathomline.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def some_docs(seed=1, n=60):
    """Random prose with copies, near copies, shared passages, nulls, empties, ties and repeated rows."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passage = prose(70)
    texts = [prose(rng.choice([1, 2, 3, 4, 5, 8, 12, 40, 200])) for _ in range(n)]
    for i in range(0, n, 7):
        w = texts[i].split()
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [texts[0], texts[1], prose(20) + " " + passage, passage + " " + prose(30), passage[:300], "", None, "x" * 450, "ab" * 300, "Éa ß 漢字 " * 40, "  \t\n", texts[5].upper()]
    rows = [(i, t, "en", rng.choice(["s1", "s2", "s2", "s3", None]), len(t) if t else 0) for i, t in enumerate(texts)]
    return rows + [rows[3], (None, texts[2], None, None, None), (None, None, None, "s1", None)]


@pytest.fixture(scope="module")
def rows():
    return some_docs()


@pytest.fixture(scope="module")
def docs(spark, rows):
    clashing = ["score", "label", "position", "h", "cid", "rid", "packed", "n"]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    return df.withColumns({c: F.lit("x") for c in clashing})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for f in (pii.query, tokencount.query, imatch.query, packing.query, suffix.query, media.query, mixing.query, jaccard.query):
        assert f(empty).count() == 0, f.__module__
    assert toxicity.query(empty, labels).count() == 0 and warczip.query(pages).count() == 0


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_matches_sql(name, spark, sf, matches_sql):
    matches_sql(registered.queries()[name](spark, sf), registered.oracle_sql()[name])


# -- 1


def test_surrogates(spark, docs):
    texts = [
        "Write to und.34@mail7.example.com or call +1 (017) 555-7713, card 4012888888881881 and 4012 8888 8888 1881.",
        "UND.34@MAIL7.EXAMPLE.COM came from 10.1.2.3 and 203.0.113.77; SSN 123-45-6789.",
        "Ms Anna Weber met Mr Weber; Мария Волков too. IBAN DE89 3704 0044 0532 0130 00. call +1 (017) 555-7714",
        None, "", "nothing here, 12 or 2021", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in pii.surrogates(df, "k").collect()}
    assert out[3].text is None and out[4].text == "" and out[5].text == texts[5] and out[5].pii_entities == 0
    for i in (0, 1, 2, 6):
        for private in ("und.34@mail7", "555-7713", "4012888888881881", "4012 8888", "UND.34", "10.1.2.3", "203.0.113.77", "123-45-6789", "Anna", "Weber", "Мария", "Волков", "DE89", "24be64"):
            assert private not in out[i].text
    cards = re.findall(r"\d{16}|(?:\d{4} ){3}\d{4}", out[0].text)
    assert len(cards) == 2 and cards[0] == cards[1].replace(" ", "") and pii.luhn(cards[0][:-1]) == int(cards[0][-1])
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", out[0].text) and re.search(r"\b10\.\d+\.\d+\.\d+", out[1].text)
    mail = re.search(r"\S+@\S+\.com", out[0].text)[0]
    assert mail.upper() in out[1].text  # one entity, two writings
    m = re.search(r"Ms (\S+) (\S+) met Mr (\S+); (\S+) (\S+) too", out[2].text)
    assert m[1] in pii.GIVEN["latin", "f"] and m[2] == m[3] and m[4] in pii.GIVEN["cyrillic", "f"]
    iban = re.search(r"IBAN (.{27})", out[2].text)[1].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    other = {r.doc_id: r.text for r in pii.surrogates(df, "another key").collect()}
    assert other[0] != out[0].text and {r.doc_id: r.text for r in pii.surrogates(df, "k").collect()} == {k: r.text for k, r in out.items()}
    assert pii.surrogates(docs, "k").count() == docs.count()


def test_surrogates_stay_distinct(spark, monkeypatch):
    names = [f"Q{chr(97 + i % 26)}{chr(97 + i // 26)}o" for i in range(150)]  # unlisted family names, more than the list holds
    df = spark.createDataFrame([(i, f"Mr {n} wrote to a{i}@b.com") for i, n in enumerate(names)], "doc_id long, text string")
    for few in (pii.BROADCAST_ENTITIES, 0):
        monkeypatch.setattr(pii, "BROADCAST_ENTITIES", few)
        out = [re.match(r"Mr (\S+) wrote to (\S+)", r.text) for r in pii.surrogates(df, "k").orderBy("doc_id").collect()]
        assert len({m[1] for m in out}) == len(names) and len({m[2] for m in out}) == len(names)
    assert len({pii.permute(b"k", "x", i, 1000) for i in range(1000)}) == 1000


def test_permutations_have_no_fixed_points():
    for size in (2, 3, 10, 1000, 1 << 12):
        made = [pii.derange(b"k", "x", i, size) for i in range(size)]
        assert sorted(made) == list(range(size)) and all(a != b for a, b in enumerate(made))
        assert all(pii.unpermute(b"k", "x", pii.permute(b"k", "x", i, size), size) == i for i in range(0, size, 7))


def test_addresses_stay_in_their_range():
    import ipaddress

    for text in ("172.16.5.4", "127.0.0.1", "169.254.1.1", "10.9.8.7", "192.168.0.1", "100.64.3.2", "8.8.8.8", "198.51.100.7"):
        made = {ipaddress.ip_address(pii.surrogate(f"k{i}".encode(), "ip", text)) for i in range(40)}
        home = [r for r in pii.RANGES4 if ipaddress.ip_address(text) in r]
        assert all([r for r in pii.RANGES4 if m in r] == home for m in made) and ipaddress.ip_address(text) not in made
    text = "from fe80::1ff:fe23:4567:890a and 2001:4860:4860::8888 at 12:30:45, std::vector<int> a::b"
    out, n, _ = pii.redact(b"k", text, {})
    assert n == 2 and "fe80::1ff" not in out and "4860" not in out and out.endswith(" at 12:30:45, std::vector<int> a::b") and re.search(r"from fe[89ab]", out)


def test_security_numbers_can_be_issued():
    made = [pii.surrogate(b"k", "ssn", f"{100 + i:03d}-{10 + i % 80:02d}-{1000 + i:04d}") for i in range(500)]
    assert len(set(made)) == 500 and all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", m) for m in made)


def test_names_are_one_person_throughout_a_text():
    out, n, seen = pii.redact(b"k", "Anna Weber met Weber and Anna. MR JOHN WEBER left; Weber stayed.", {})
    m = re.fullmatch(r"(\S+) (\S+) met (\S+) and (\S+)\. MR (\S+) (\S+) left; (\S+) stayed\.", out)
    assert m and m[2] == m[3] == m[7] and m[6] == m[2].upper() and m[1] == m[4] and "Weber" not in out and n == 7 and len(seen) == 3
    out, n, _ = pii.redact(b"k", "Ms Priya O'Brien-Smith came. Dr. Stone However stayed. Patel", {})
    assert n == 3 and "O'Brien" not in out and "Priya" not in out and "However stayed. Patel" in out
    assert pii.find("MS OFFICE and DR UNIT in MR SCANS") == []
    assert [k for *_, k, _ in pii.find("Ms Priya Patel")] == ["given:latin:f", "family:latin"]


def test_many_names_stay_distinct(spark):
    letters = "abcdefghijklmnopqrst"
    names = ["Q" + "".join(letters[i // 20**j % 20] for j in range(4)) for i in range(12_000)]  # several times what two listed names make
    df = spark.createDataFrame([(i, "\n".join(f"Mr {n}" for n in names[i : i + 100])) for i in range(0, len(names), 100)], "doc_id long, text string")
    out = [w for r in pii.surrogates(df, "k").collect() for w in re.findall(r"Mr (\S+)", r.text)]
    assert len(out) == len(set(out)) == len(names) and not set(out) & set(names)


def test_columns_of_the_caller_stay(spark):
    df = spark.createDataFrame([(1, "mail a@b.com", "x", "y", "z")], "doc_id long, text string, pii_out string, pii_row string, pii_map string")
    r = pii.surrogates(df, "k").first()
    assert (r.pii_out, r.pii_row, r.pii_map, r.pii_entities) == ("x", "y", "z", 1)


def test_secrets_without_digits_are_found():
    for text, value in (("password = swordfish", "swordfish"), ("token: abcdefgh", "abcdefgh"), ("AKIA" + "Q" * 16, "AKIA" + "Q" * 16), ("sk-" + "a" * 20, "sk-" + "a" * 20), ("ghp_" + "b" * 20, "ghp_" + "b" * 20)):
        assert [x[2:] for x in pii.find(text)] == [("token", value)], text


def test_long_secrets_are_replaced_to_their_end():
    value = "eyJ" + "aB3_" * 400 + ".SIGNATURE"
    text, n, _ = pii.redact(b"k", f"token={value} end", {})
    assert n == 1 and len(text) == len(f"token={value} end") and text.endswith(" end") and "SIGNATURE" not in text and "aB3_aB3_" not in text


def test_surrogates_stay_distinct_beyond_the_lists(spark):
    letters = [chr(ord("а") + i) for i in range(17)]
    names = [f"Щ{a}{b}{c}" for a in letters for b in letters for c in letters][:4500]  # more than two or three listed names make
    df = spark.createDataFrame([(i, f"Dr {n} was here") for i, n in enumerate(names)], "doc_id long, text string")
    out = [r.text for r in pii.surrogates(df, "k").collect()]
    assert len(set(out)) == len(names) and not set(out) & {r.text for r in df.collect()}


def test_masks_and_secrets_of_few_signs(spark):
    texts = ["password: ******** 1", "password: a***** 1", "password: b***** 1", "password: !?!?!? 1", "password=sk-*** 1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = [r.text for r in pii.surrogates(df, "k").orderBy("doc_id").collect()]
    assert out[0] == texts[0] and all(a != b for a, b in zip(out[1:], texts[1:], strict=True)) and len(set(out)) == len(texts)
    small = {pii.surrogate(b"k", "token", "a*****", n) for n in range(3, 40)}
    assert len(small) == 37 and all(len(pii.name_word(b"k", "family:latin", "Qo", n).split("-")) == max(2, n) for n in (0, 2, 3, 16, 40))


def test_phones_without_separators_and_with_trunk_zero():
    for phone in ("+15553239830", "+442079460958", "06 12 34 56 78", "030 1234567", "020 7946 0958", "0171/1234567"):
        text, n, _ = pii.redact(b"k", f"call {phone}.", {})
        assert n == 1 and phone not in text and re.sub(r"\d", "0", text) == re.sub(r"\d", "0", f"call {phone}.") and text[5:7] in ("+1", "+4", "01", "02", "03", "04", "05", "06", "07", "08", "09")
    digits = [re.sub(r"\D", "", pii.surrogate(b"k", "phone", p)) for p in ("+1 555-323-9830", "+15553239830", "+1 (555) 323-9830")]
    assert len(set(digits)) == 1  # one entity in three writings
    for other in ("01.02.2020 12:30", "01-02-2020", "09 12 2019 10", "0-306-40615-2", "+10000000.50", "2021-03-04 05.06.07"):
        assert not pii.find(other), other


# -- 2


def test_token_tree_edits():
    from fathomline.llm.tokens import encoder

    count, rng = encoder().count, random.Random(2)
    for trial in range(150):
        text = "".join(rng.choice(["ab", " ", "  ", "\n", "don't ", "12", "é", "漢", "日本。", "a(b);", "カ\n", "x" * 30, ". "]) for _ in range(rng.randint(0, 150)))
        tree = tokencount.SegmentTree(text, count, run_chars=rng.choice([1, 8, 40]))
        assert tree.tokens == count(text)
        for _ in range(4):
            a = rng.randint(0, len(tree.text))
            b = min(len(tree.text), a + rng.choice([0, 1, 5, 60]))
            tree.edit(a, b, rng.choice(["", " ", "new", " two words ", "'s", "9"]))
            assert tree.tokens == count(tree.text), (trial, tree.text)
            level = tree.levels[0]
            assert sum(n for n, _ in level) == len(tree.text)
            assert tree.levels == tokencount.SegmentTree(tree.text, count, leaves=list(level)).levels


def test_token_edit_reuses_runs():
    from fathomline.llm.tokens import encoder

    tree = tokencount.SegmentTree("word and more " * 5000, encoder().count)
    before = tree.encoded_chars
    tree.edit(30_000, 30_010, "changed")
    assert tree.encoded_chars - before < 4 * tokencount.RUN_CHARS and tree.tokens == encoder().count(tree.text)


def test_token_counts(spark, docs, rows):
    from fathomline.llm.tokens import encoder

    count = encoder().count
    want = Counter()
    for i, t, *_ in rows:
        t = t or ""
        n = len(t) // 2
        want[i, count(t), count(t[:n] + t[:24] + t[min(n + 16, len(t)) :])] += 1
    got = Counter((r.doc_id, r.n_tokens, r.edited_tokens) for r in tokencount.query(docs).collect())
    assert got == want


def test_texts_without_spaces_are_cut():
    from fathomline.llm.tokens import encoder

    for text in ("これは長い文章です。" * 400, "f(x1,y2);" * 400, "短い\n" * 900):
        tree = tokencount.SegmentTree(text, encoder().count)
        whole = tree.encoded_chars
        assert tree.tokens == encoder().count(text) and len(tree.levels[0]) > 4
        tree.edit(1500, 1503, "新しい")
        assert tree.tokens == encoder().count(tree.text) and tree.encoded_chars - whole < 4 * tokencount.RUN_CHARS


def test_kept_trees_take_edit_after_edit(spark):
    from fathomline.llm.tokens import encoder

    texts = [(1, "some words and more " * 300), (2, None), (3, "日本語。" * 500), (4, "tail")]
    kept = tokencount.trees(spark.createDataFrame(texts, "doc_id long, text string").withColumn("tokens", F.lit(7)))
    want = {i: t or "" for i, t in texts}
    for a, b, new in ((0, 3, "x"), (700, 2000, " two\n"), (10_000, 10_000, "end")):
        rows = tokencount.edited(kept.selectExpr("*", f"least({a}, length(text)) as a", f"least({b}, length(text)) as b", f"'{new}' as new")).collect()
        want = {i: t[:a] + new + t[b:] for i, t in want.items()}
        assert {r.doc_id: (r.text, r.edited_tokens, sum(r.tokens)) for r in rows} == {i: (t, *[encoder().count(t)] * 2) for i, t in want.items()}
        assert all(r.reencoded_chars < 5 * tokencount.RUN_CHARS for r in rows)
        kept = spark.createDataFrame([(r.doc_id, r.text, r.chars, r.tokens) for r in rows], tokencount.TREE)


def test_ids_are_those_of_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    from fathomline.llm.tokens import encoder

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    for text in ["", " a  b\n\n c", "it's 漢字 naïve ÀÉ", "<|endoftext|>", "  x y", "ǅ ɐ Ω я ٣ ½", "a" * 3000, "😀👍🏽"]:
        assert encoder().ids(text) == t.encode(text, add_special_tokens=False).ids, text


# -- 3


def test_imatch(spark, docs, rows):
    out = imatch.query(docs).collect()
    assert len(out) == len(rows)
    order = sorted(((-(1 << 63) if i is None else i), t or "") for i, t, *_ in rows)
    hashed = {r.text: r.h for r in spark.createDataFrame([(t,) for _, t in order], "text string").select("text", F.xxhash64("text").alias("h")).collect()}
    order.sort(key=lambda x: (x[0], hashed[x[1]]))
    want = Counter()
    for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        k = len(t) // 4
        want[i, len(t), hashlib.sha256((t[: len(t) - k] + after[:k]).encode()).hexdigest()] += 1
    assert Counter((-(1 << 63) if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256) for r in out) == want
    by_text = defaultdict(set)
    texts = dict(zip((i for i, *_ in rows), (t or "" for _, t, *_ in rows), strict=True))
    for r in out:
        if r.doc_id is not None:
            by_text[texts[r.doc_id]].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.near_edited == 1 or r.fingerprint != r.edited_fingerprint
    assert all(len(v) == 1 for v in by_text.values())
    only = imatch.query(spark.createDataFrame([(5, "one two three four")], "doc_id long, text string")).first()
    assert only.n_chars == 18 and only.edited_sha256 == hashlib.sha256(b"one two three one ").hexdigest()


def test_imatch_copies_keep_their_terms_in_the_band(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    text = [word() for _ in range(120)]
    near = [" ".join(text[:i] + [word()] + text[i + 1 :]) for i in (20, 50, 90)]
    others = [" ".join(word() for _ in range(100)) for _ in range(140)]
    rows = list(enumerate([*[" ".join(text)] * 80, *near, *others]))  # a third of all rows are copies
    out = {r.doc_id: r for r in imatch.query(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert len({out[i].fingerprint for i in range(80)}) == 1
    assert all(out[i].near_edited > 0.2 for i in range(79)) and out[79].near_next > 0.5 and out[80].near_next > 0.5
    assert sum(out[i].near_next for i in range(90, 220)) < 3


def test_next_rows_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(imatch, "RANGE_ROWS", 3)
    rng = random.Random(8)
    ids = [rng.randrange(10**6) for _ in range(400)]
    df = spark.createDataFrame([(i, str(i), i % 7) for i in ids], "doc_id long, text string, h long").repartition(5)
    out = Counter((r.doc_id, r.n) for r in imatch.with_next(df, "doc_id", "h", {"n": "text"}).collect())
    order = sorted(ids)
    assert out == Counter((a, str(b)) for a, b in zip(order, order[1:] + order[:1], strict=True))


def test_imatch_tells_edits_from_others(spark, sf):
    r = registered.op3_imatch_fingerprints(spark, sf).agg(F.avg("near_edited").alias("e"), F.avg("near_next").alias("n")).first()
    assert r.e > 0.2 and r.n < 0.1


def test_imatch_plan_has_no_python(spark, docs):
    plan = imatch.query(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# -- 4


def check_packing(out, want):
    """Gapless sequences of at most the window; all but powers of two are full; every id once."""
    seqs = defaultdict(list)
    for r in out:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 1024 and at & (at - 1) == 0
    assert Counter() == Counter({k: sum(r.length for r in out if r.doc_id == k) for k in want}) - Counter(want)


def test_packing(spark, docs, rows, monkeypatch):
    from fathomline.llm.tokens import encoder

    monkeypatch.setattr(packing, "SHARD", 16)
    out = packing.pack(docs, shard=16).collect()
    ids = {}
    total = Counter()
    for i, t, *_ in rows:
        ids.setdefault(i, []).append(encoder().array(t or "").tolist() + [0])
        total[i] += len(ids[i][-1])
    check_packing(out, total)
    assert Counter({k: sum(r.length for r in out if r.doc_id == k) for k in total}) == total
    for r in out:
        assert any(zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 and len(x) == r.doc_tokens for x in ids[r.doc_id])


def test_packing_joins_near_texts():
    rng = np.random.default_rng(1)
    topics = [rng.integers(1000 * i, 1000 * i + 300, 4000).astype(np.uint16) for i in range(1, 5)]
    tails = [topics[i % 4][j : j + 256] for i, j in zip(range(32), rng.integers(0, 3000, 32), strict=True)]
    df = np.zeros(packing.VOCABULARY, np.int64)
    for t in tails:
        df[np.unique(t)] += 1
    seqs = packing.pack_shard(tails, np.log1p((32 - df + 0.5) / (df + 0.5)))
    assert all(sum(n for *_, n in s) == 1024 for s in seqs)
    assert sum(len({i % 4 for i, *_ in s}) == 1 for s in seqs) >= 7


# -- 5


def test_two_stage_sort():
    rng = random.Random(1)
    for trial in range(60):
        n, letters = rng.randint(0, 300), rng.choice([1, 2, 4, 200])
        t = bytes(rng.randrange(letters) for _ in range(n))
        t = t[:20] * (n // 20 + 1) if trial % 3 == 0 else t
        assert suffix.two_stage(t, 1000).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def removed(texts, length=200):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes() if t else b""
        out.append((len(t), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int), 0]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group", [1000, 1])
def test_suffix_dedup(spark, docs, rows, group, monkeypatch):
    monkeypatch.setattr(suffix, "GROUP", group)
    want = Counter(zip((r[0] for r in rows), removed([(r[1] or "").encode() for r in rows]), strict=True))
    got = Counter((r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in suffix.query(docs).collect())
    assert got == want
    assert sum(k[1][1] for k in want) > 1000


def test_suffix_dedup_with_shared_names(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(suffix, "_shared_names", lambda known: sorted(r.rid for r in known.select("rid").collect())[::2])
    want = Counter(zip((r[0] for r in rows), removed([(r[1] or "").encode() for r in rows]), strict=True))
    assert Counter((r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in suffix.query(docs).collect()) == want


def test_suffix_dedup_gives_the_text(spark):
    same = "".join(random.Random(4).choice("abcdef") for _ in range(250))
    df = spark.createDataFrame([(1, "left " + same + " right"), (2, same + "!"), (3, "y")], "doc_id long, text string")
    kept = {r.doc_id: bytes(r.kept) for r in suffix.deduplicated(df, text_too=True).collect()}
    assert kept == {1: b"left  right", 2: b"!", 3: b"y"}


# -- 6


def test_media_formats():
    rng = np.random.default_rng(3)
    gray = rng.integers(0, 256, (13, 7), dtype=np.uint8)
    for data in (media.encode_pgm(gray), media.encode_bmp(gray), b"P2 # c\n7 13\n255\n" + b" ".join(b"%d" % v for v in gray.ravel())):
        assert (media.decode(data) == gray).all()
    rgb = rng.integers(0, 256, (3, 5, 3), dtype=np.uint8)
    assert (media.decode(b"P6\n#x\n5 3\n255\n" + rgb.tobytes()) == rgb).all()
    deep = rng.integers(0, 60000, (2, 3)).astype(">u2")
    assert (media.decode(b"P5 3 2 65535\n" + deep.tobytes()) == deep).all()
    for bad in (b"P9 1 1 1\n", b"P5 9 9 255\nx", b"nothing"):
        with pytest.raises(ValueError):
            media.decode(bad)


def test_area_resize_is_exact():
    rng = np.random.default_rng(4)
    g = rng.integers(0, 256, (12, 20)).astype(float)
    assert np.allclose(media.area_resize(g, 4, 5), g.reshape(4, 3, 5, 4).mean((1, 3)))
    assert np.allclose(media.area_resize(g, 36, 40)[::3, ::2], g)
    odd = media.area_resize(g, 5, 7)
    assert odd.mean() == pytest.approx(g.mean())


def test_media_tiles(spark):
    gray = np.arange(70 * 65, dtype=np.uint16).reshape(70, 65).astype(np.uint8)
    df = spark.createDataFrame([(1, bytearray(media.encode_pgm(gray))), (2, None), (3, bytearray(b"P5 9 9 255\nx"))], "id long, image binary")
    every = media.tiles(df, "id", "image").collect()
    assert [(r.id, r.npy, r.error) for r in every if r.id > 1] == [(2, None, None), (3, None, "Netpbm samples are cut short")]
    out = [r for r in every if r.id == 1]
    back = {(r.tile_row, r.tile_col): np.load(io.BytesIO(r.npy)) for r in out}
    assert set(back) == {(0, 0), (0, 1), (1, 0), (1, 1)} and (back[1, 1] == gray[64:, 64:]).all() and all(len(r.dhash) == 16 for r in out)


def test_text_media(docs, rows):
    def want(t):
        raw = (t or "").encode()
        p = raw + bytes(-len(raw) % 64 if raw else 64)
        return len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])

    got = media.query(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == Counter((r[0], *want(r[1])) for r in rows)
    assert len({(r.payload_sha256, r.media_sha256, r.feature) for r in got}) == len({r.payload_sha256 for r in got})

    def plain_hash(t):  # box means of each of the 8 x 9 areas by weights of whole rows and columns
        raw = (t or "").encode()
        g = np.frombuffer(raw + bytes(-len(raw) % 64 if raw else 64), np.uint8).reshape(-1, 64).astype(float)
        part = lambda n, m: np.array([[max(0.0, min(j + 1, (i + 1) * n / m) - max(j, i * n / m)) for j in range(n)] for i in range(m)])
        small = np.round(part(len(g), 8) @ g @ part(64, 9).T * 72 / g.size, 6)
        return np.packbits(small[:, :-1] < small[:, 1:]).tobytes().hex()

    wanted = Counter((r[0], plain_hash(r[1])) for r in rows)
    assert sum((Counter((r.doc_id, r.feature) for r in got) - wanted).values()) <= 2  # means that agree to 6 digits may round apart
    kinds = {media.text_image(r[1] or "")[1][:2] for r in rows}
    assert kinds == {b"P5", b"BM"}


# -- 7


def test_mixing(docs, rows):
    out = mixing.query(docs).collect()
    assert len(out) == len(rows)
    size, taken, target = Counter(), Counter(), {}
    sources = defaultdict(list)
    for i, t, _, s, _ in rows:
        sources[i, len(WORD.findall(t or ""))].append(s)
    for r in out:
        assert 0 <= r.taken <= 3 * r.size and (r.position is None) == (r.taken == 0)
        key = r.source_size, r.target
        size[key] += r.size
        taken[key] += r.taken
        target[key] = r.target
    total = sum(size.values())
    assert sum(target.values()) == pytest.approx(total) and all(abs(taken[k] - target[k]) <= 1 and target[k] <= 3 * k[0] for k in target)
    positions = [r.position for r in out if r.position is not None]
    assert positions == sorted(positions) and positions[0] == 0
    assert [tuple(r) for r in mixing.query(docs).collect()] == [tuple(r) for r in out]


def test_mixed_rows(docs):
    cols = ("doc_id", "text", "lang", "source", "n_chars")
    words = Counter()
    for r in mixing.mixed(docs, cols).collect():
        words[r.doc_id, r.source] += len(WORD.findall(r.text))
    want = Counter()
    for r in mixing.mix(docs, carry=("source",)).collect():
        want[r.doc_id, r.carry_source] += r.taken
    assert words == +want


def test_mixing_deals_rows_without_ids(spark):
    rows = [(None, f"w{i} " * (i % 7), "en", "hot", 0) for i in range(300)] + [(i, "a b c", None, None, None) for i in range(20)]
    df = spark.createDataFrame(rows, DOCS)
    out = mixing.query(df).collect()
    assert len(out) == 320 and sorted(r.size for r in out) == sorted(len(t.split()) for _, t, *_ in rows)
    placed = [r.position for r in out if r.doc_id is None and r.position is not None]
    assert len(set(placed)) == len(placed) > 200  # each has a place of its own
    assert [mixing.bucket_digits(n) for n in (0, 8_000, 8_001, 10**12)] == [1, 1, 2, mixing.MOST_DIGITS]


def test_mixing_places_do_not_depend_on_the_groups(docs, monkeypatch):
    few = [tuple(r) for r in mixing.query(docs).collect()]
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 1)
    assert [tuple(r) for r in mixing.query(docs).collect()] == few


# -- 8


def plain_hits(text, entries):
    """Weight and different entries of the longest entry at each word start, by trying all entries at all places."""
    folded, total, different = toxicity.fold(text), 0.0, set()
    spared = [(m.start(), m.end()) for p in toxicity.EXCEPTIONS for m in re.finditer(rf"(?<![^\W\d_]){p}(?![^\W\d_])", folded)]
    for a in range(len(folded)):
        if a and folded[a - 1].isalpha():
            continue
        here = [(len(w), x) for (w, stem), x in entries.items() if folded.startswith(w, a) and (stem or not folded[a + len(w) : a + len(w) + 1].isalpha())]
        if here:
            size, weight = max(here)
            if not any(x <= a and a + size <= y for x, y in spared):
                total += weight
                different.add(folded[a : a + size])
    return total, different, folded.count(" ") + 1


def test_matcher_against_all_entries_at_all_places(rows):
    entries = {(w, False): x for w, x in toxicity.SEED.items()} | {("the", False): 1.0, ("ther", True): 1.5, ("ma", True): 0.5, ("lor", True): 0.25, ("и", True): 0.75}
    m = toxicity.Matcher(entries)
    texts = [t or "" for _, t, *_ in rows] + ["trash can trash", "take out the trash, 1d10t", "the therm there" * 50, "sore loser rule loser"]
    for t in (t[:3000] for t in texts):
        total, different, words = plain_hits(t, entries)
        assert m.features(t) == pytest.approx((math.log1p(total / words**0.5), total / words**0.5, math.log1p(len(different) / words**0.5)))


def test_one_text_teaches_for_a_repeated_id(spark):
    docs = spark.createDataFrame([(1, t, "en", "s", 0) for t in ("a", "b", "b")] + [(2, None, None, None, None)], DOCS)
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert sorted(r.doc_id for r in toxicity.training_rows(docs, labels, 10).collect()) == [i for i in (1, 2) if zlib.crc32(str(i).encode()) % 5]


@pytest.mark.parametrize(("written", "read"), [("1d10t", "idiot"), ("STυPID", "stupid"), ("morоn", "moron"), ("l0$er", "loser"), ("2021", "2021"), ("tra​sh", "trash"), ("ＩＤＩＯＴ", "idiot")])
def test_fold(written, read):
    assert toxicity.fold(written) == read


def test_exceptions_and_boundaries():
    m = toxicity.Matcher({(w, False): x for w, x in toxicity.SEED.items()} | {("lowei", True): 3.0})
    assert m.features("take out the trash, circus clown") == (0, 0, 0) and m.features("") == (0, 0, 0)
    assert m.features("trash")[0] > 0 and m.features("trashy")[0] == 0 and m.features("loweizen")[0] > 0 and m.features("aloweizen")[0] == 0


def test_toxicity_held_out(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(400)]
    rows, labels = [], []
    for i in range(600):
        w = [rng.choice(words) for _ in range(rng.choice([5, 30, 300]))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "1diot", "grumzog" + rng.choice(["a", "en", "ist"])]))
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    docs, lab = spark.createDataFrame([*rows, (None, None, None, None, None)], DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.query(docs, lab).collect()}
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(600))
    held = [(out[i].predicted, y) for i, _, y in labels if out[i].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    # Labels of the held-out fold are not looked at.
    flipped = spark.createDataFrame([(i, q, 1 - y if out[i].held_out else y) for i, q, y in labels], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.score for r in toxicity.query(docs, flipped).collect()} == {k: r.score for k, r in out.items()}


# -- 9


def plain_components(rows, k, num, den):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t, *_ in rows:
        w = WORD.findall((t or "").translate(lower))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return Counter((rows[i][0], len(s), least.get(find(i)) if s else rows[i][0]) for i, s in enumerate(sets))


@pytest.mark.parametrize(("k", "num", "den", "boundary"), [(4, 85, 100, None), (4, 85, 100, 40), (5, 80, 100, None), (2, 60, 100, 12), (1, 50, 100, 6)])
def test_jaccard_join(spark, k, num, den, boundary):
    rows = some_docs(seed=k, n=80)
    df = spark.createDataFrame(rows, DOCS)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, k, num, den, boundary).collect())
    assert got == plain_components(rows, k, num, den)


def near_copies(seed: int, groups=((150, 60, 4), (40, 200, 12))):
    """Families of near copies, some a few words from each other, some too far, and others' passages in them."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows = []
    for size, words, most in groups:
        base = [word() for _ in range(words)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, most)):
                w[rng.randrange(len(w))] = word()
            rows.append((len(rows), " ".join(w), "en", "s", 0))
    rng.shuffle(rows)
    return [(i, t, lang, s, n) for i, (_, t, lang, s, n) in enumerate(rows)]


@pytest.mark.parametrize("rounds", [0, 3])
def test_long_lists_meet_by_blocks(spark, monkeypatch, rounds):
    rows = near_copies(rounds)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    for name, value in (("SHORT", 2), ("BLOCK", 8), ("LINK_ROUNDS", rounds), ("NAMED", 2)):
        monkeypatch.setattr(jaccard, name, value)
    made = []
    kept = jaccard._of_blocks
    monkeypatch.setattr(jaccard, "_of_blocks", lambda *a: (made.append((a[-1], kept(*a).count())), kept(*a))[1])
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, 4, 85, 100).collect())
    assert got == plain_components(rows, 4, 85, 100)
    assert made and made[-1][0] and all(n <= len(rows) for whole, n in made if not whole)


def test_members_without_a_partner_leave(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    shared = " ".join(word() for _ in range(30))  # most of each text, so that all of them stand in the lists of its shingles
    rows = [(i, f"{shared} {' '.join(word() for _ in range(20))}", "en", "s", 0) for i in range(40)] + near_copies(1)[:20]
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    monkeypatch.setattr(jaccard, "SHORT", 2)
    made, kept = [], jaccard._meetings
    monkeypatch.setattr(jaccard, "_meetings", lambda at, fine: (made.append((at.count(), kept(at, fine).count())), kept(at, fine))[1])
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(2), 4, 85, 100).collect())
    assert got == plain_components(rows, 4, 85, 100)
    assert made[0][0] >= 40 and made[0][0] == made[0][1]  # a row for each member of a list that fits a block
    assert all(n < made[0][1] / 2 for _, n in made[1:])


def test_only_the_result_stays_in_the_shared_folder(spark):
    at = Path(common.shared_dir(spark).removeprefix("file://"))
    before = {p.name for p in at.glob("*")}
    out = jaccard.near_duplicates(spark.createDataFrame(some_docs(seed=2), DOCS))
    assert {p.name.rpartition("-")[0] for p in at.glob("*") if p.name not in before} == {"jaccard-found"} and out.count()


def test_scratch_deletes_what_is_not_kept(spark):
    at = Path(common.shared_dir(spark).removeprefix("file://"))
    with common.scratch(spark):
        with common.scratch(spark):
            kept = common.staged(spark.range(3), "kept", keep=True)
            common.staged(spark.range(3), "gone")
        assert kept.count() == 3 and not list(at.glob("gone-*"))
    assert not list(at.glob("kept-*"))


def test_sets_of_one_name_are_told_apart(spark, monkeypatch):
    rows = some_docs(seed=3, n=40)
    df = spark.createDataFrame(rows, DOCS).repartition(2)
    seen = []

    def every_other(table):
        seen.extend(r.cid for r in table.where("kind = 0 and n > 0").select("cid").distinct().collect())
        return frozenset(sorted(seen)[::2])

    monkeypatch.setattr(jaccard, "_shared_names", every_other)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, 4, 85, 100).collect())
    assert got == plain_components(rows, 4, 85, 100)
    sets = shingle_sets([t.encode() for _, t, *_ in rows if t and t.split()], 4)
    assert {jaccard._name(x, frozenset()) for x in sets} >= set(seen) and not {jaccard._name(x, frozenset(seen)) for x in sets} & set(seen)


def test_shingles_and_bitmaps():
    a, b, c, d = shingle_sets([b"One two\tthree four", b"one  two three FOUR\n", b"one two", b" "], 4)
    assert (a == b).all() and len(a) == 1 and len(c) == 1 and len(d) == 0 and a[0] != c[0]
    rng = np.random.default_rng(5)
    for n, m in ((30, 31), (200, 300), (1000, 90)):
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        y = np.unique(np.r_[x[: n // 2], rng.integers(0, 2**63, m, dtype=np.uint64)])
        assert jaccard.bits_apart(jaccard.bitmap(x), jaccard.bitmap(y)) <= len(np.setxor1d(x, y))


def test_boundary_is_chosen_by_cost():
    assert jaccard.choose_boundary({5: 100, 30: 100}, 0.0, 85, 100) < 30 <= jaccard.choose_boundary({5: 100, 30: 100}, 50.0, 85, 100)


# -- 10


def test_warc_round_trip(spark):
    big, other = "<p>" + "x" * 2000, "<p>é" + "y" * 3000
    rows = [(1, "u", big), (2, "u", big), (3, None, big), (4, "u", other), (5, "u", "small"), (6, "u", "small"), (7, "u", None), (None, "u", big), (3, "u", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    manifest = warczip.write_packages(warczip.as_records(df), archive_bytes=2500)
    out = warczip.read_packages(manifest).collect()
    want = Counter()
    for p, _, h in rows:
        revisit = h == big and p != 3 and p is not None or (h == big and p is None)
        data = (h or "").encode()
        want[p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == want
    assert manifest.count() > 2 and all(bytes(r.payload) == (dict((p, h) for p, _, h in rows)[r.page_id] or "").encode() for r in out if r.record_type == "response")


@pytest.mark.parametrize("bits", [64, 1 << 24])
def test_warc_only_pages_that_may_be_revisits_are_shuffled(spark, monkeypatch, bits):
    def moved(df) -> int:
        """Rows that the plan of ``df`` brings to a shuffle, of those that have a payload."""
        rows, todo = 0, [df._jdf.queryExecution().optimizedPlan()]
        while todo:
            node = todo.pop()
            under = [node.children().apply(i) for i in range(node.children().size())]
            if node.nodeName() == "Join":
                rows += spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, under[0]).count()
            todo += under
        return rows

    monkeypatch.setattr(warczip, "FILTER_BITS", bits, raising=False)
    alone = [(n, "u", f"<p>{n}" + "x" * 1200) for n in range(200)] + [(1000 + n, "u", "small") for n in range(50)]
    copies = [(2000 + n, "u", "<p>" + "y" * 1500) for n in range(20)] + [(None, "u", "<p>" + "y" * 1500)]
    frame = lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert moved(warczip.as_records(frame(alone))) == 0
    records = warczip.as_records(frame(alone + copies))
    assert 20 <= moved(records) <= (21 + 200 if bits == 64 else 40)
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in warczip.read_packages(warczip.write_packages(records)).collect())
    assert got == Counter((n, "revisit" if n is None or 2000 <= n < 2019 else "response", 2019 if n is None or 2000 <= n < 2019 else None) for n, _, _ in alone + copies)


def test_zip_directories():
    import struct
    import zipfile

    data = warczip.zip_package([({"page": 1, "digest": "d"}, warczip.warc_record(1, "u", "response", None, b"abc", "d", 3))])
    read = lambda at, n: data[at : at + n]
    found = warczip.directory(len(data), read)
    assert found[warczip.DATA][2] == 0 and read(*found[warczip.DATA][:2]).startswith(b"WARC/1.1")
    # The same package with a ZIP64 end record in front of an end record whose fields say so.
    end = data.rfind(b"PK\x05\x06")
    count, size, start = struct.unpack_from("<HII", data, end + 10)
    record = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, count, count, size, start)
    big = data[:end] + record + struct.pack("<4sIQI", b"PK\x06\x07", 0, end, 1) + struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 2) + b"hi"
    assert warczip.directory(len(big), lambda at, n: big[at : at + n]) == found
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(warczip.DATA, b"x" * 1000)
    packed = out.getvalue()
    assert warczip.directory(len(packed), lambda at, n: packed[at : at + n])[warczip.DATA][2] == zipfile.ZIP_DEFLATED
    with pytest.raises(ValueError, match="end of central"):
        warczip.directory(5, lambda at, n: b"hello"[at : at + n])
    with pytest.raises(ValueError):
        warczip.parse_warc(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n")


def test_packages_of_several_archives(tmp_path):
    import json
    import zipfile

    records = {n: warczip.warc_record(n, "u", "response", None, b"body %d" % n, hashlib.sha1(b"body %d" % n).hexdigest(), 6) for n in range(4)}
    line = lambda n, at, **more: json.dumps({"page": n, "offset": at, "length": len(records[n]), **more})

    def package(name: str, indexes: list[list[str]]) -> str:
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_STORED) as z:
            z.writestr("archive/a.warc", records[0] + records[1])
            z.writestr("archive/b.warc", records[2] + records[3])
            for k, lines in enumerate(indexes):
                z.writestr(f"indexes/{k}.cdxj", "\n".join(lines))
        return f"file://{tmp_path / name}"

    one, three = len(records[0]), len(records[2])
    good = package("good", [[line(1, one, filename="a.warc"), line(2, 0, filename="b.warc")], [line(3, three, filename="b.warc"), line(0, 0, filename="a.warc")]])
    assert [(e["page"], payload) for e, _, payload in warczip.range_records(good)] == [(n, b"body %d" % n) for n in (1, 2, 3, 0)]
    for lines in ([line(0, 0)], [line(0, 0, filename="c.warc")], [line(0, 5 * one, filename="a.warc")]):
        with pytest.raises(ValueError, match="has a line that"):
            list(warczip.range_records(package("bad", [lines])))

