from __future__ import annotations

import random
import re
from collections import Counter

import pytest

import corpus_pipeline as cp
from fathomline.llm import mixing, toxicity
from fathomline.llm.tokens import encoder
from tests.llm.test_operators import DOCS, WORD, plain_components, some_docs

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A corpus with copies, toxic documents, personal data, nulls and an extra column."""
    rng = random.Random(11)
    rows = some_docs(seed=9, n=120)
    at = len(rows)
    for i in range(12):
        rows.append((at + i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(20)) + f" you idiot moron {i}", "en", "s1", 0))
    rows += [(at + 20 + i, f"number {i} write to person{i}@mail.example.com or +1 (555) 555-{1000 + i} now", "en", "s2", 0) for i in range(6)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS near_key", "1 AS toxic_score").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(r[0], 1, int("idiot" in (r[1] or ""))) for r in rows if r[0] is not None], LABELS).write.parquet(f"{path}/labels.parquet")
    return str(path), rows


def docs_of(spark, path):
    return spark.read.parquet(f"{path}/documents.parquet")


def test_toxic_go_and_clean_stay(spark, folder):
    path, rows = folder
    out = cp.drop_toxic(spark, docs_of(spark, path), path)
    assert out.columns == list(cp.COLUMNS)
    assert Counter(r.text for r in out.collect()) == Counter(r[1] for r in rows if "idiot" not in (r[1] or ""))


def test_one_of_each_group_stays(spark, folder):
    path, rows = folder
    out = Counter(r.doc_id for r in cp.drop_near_duplicates(spark, docs_of(spark, path), path).collect())
    groups = plain_components(rows, 5, 80, 100)
    want = Counter()
    for (doc, n, least), times in groups.items():
        if n == 0:
            want[doc] += times
        elif doc == least and doc is not None:
            want[doc] += 1
    assert out == want


def test_personal_data_go(spark, folder):
    path, rows = folder
    out = cp.replace_pii(spark, docs_of(spark, path), path).collect()
    assert len(out) == len(rows) and not any(re.search(r"person\d@mail|555-10", r.text or "") for r in out)
    clean = Counter(r[1] for r in rows if not re.search(r"person\d", r[1] or ""))
    assert clean - Counter(r.text for r in out) == Counter()


def test_mix_takes_effect(spark, folder):
    path, _ = folder
    docs = docs_of(spark, path)
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r.doc_id] += r.taken
    got = Counter()
    for r in cp.mix_sources(spark, docs, path).collect():
        got[r.doc_id] += len(WORD.findall(r.text))
    assert got == +want


def test_run(spark, folder):
    path, _ = folder
    out = cp.run(spark, path).collect()
    assert out and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out[0].asDict())
    sizes = Counter()
    for r in out:
        sizes[r.sequence_id] += r.length
    assert all(n <= 1024 and n & (n - 1) == 0 for n in sizes.values())


def test_stages_on_an_empty_table(spark, folder):
    path, _ = folder
    docs = docs_of(spark, path).limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, path).count() == 0


def test_packing_of_repeated_rows(spark, folder):
    path, rows = folder
    docs = docs_of(spark, path)
    out = cp.pack_sequences(spark, docs.unionByName(docs), path).collect()
    assert sum(r.length for r in out) == 2 * sum(encoder().count(r[1] or "") + 1 for r in rows)


def test_scores_need_no_labels_to_be_complete(spark, folder):
    path, rows = folder
    few = spark.read.parquet(f"{path}/labels.parquet").limit(5)
    assert toxicity.query(docs_of(spark, path), few).count() == len(rows)
