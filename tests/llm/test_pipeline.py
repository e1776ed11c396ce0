"""The pipeline against brute force on a small corpus, and the queries against their SQL."""

from __future__ import annotations

import os
import random
import sys

import brute
import public_tokenizers
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tests"))

import corpus_pipeline  # noqa: E402
from tankflow.llm import pii, queries  # noqa: E402
from tankflow.llm.common import materialise, prepare  # noqa: E402

SF = "/root/testdata/sf0.001"


def prose(r, n):
    return " ".join("".join(r.choice(["an", "er", "th", "ou", "st", "re", "le", "on"]) for _ in range(r.randrange(1, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """documents, labels and benchmark with planted toxic rows, copies, passages and personal data."""
    prepare(spark)
    r = random.Random(3)
    texts, toxic = [], set()
    for i in range(400):
        w = prose(r, r.randrange(30, 120)).split(" ")
        if i % 8 == 0:
            toxic.add(i)
            for _ in range(r.randrange(2, 7)):
                w.insert(r.randrange(len(w)), r.choice(["zlurk", "vorgle"]))
        texts.append(" ".join(w))
    items = [(i, prose(r, 30)) for i in range(5)]
    for i in range(1, 40, 4):
        texts[i] += " " + items[i % 5][1]
    for i in range(2, 60, 4):
        texts[i] += f" mail a{i}@b.example.com, call +1 (564) 555-45{i:02d} or 10.0.{i}.7"
    texts += [texts[50], texts[50], texts[51] + " more"] + [None, ""]
    rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append(rows[52])  # a repeated row
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(0, 400, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, items, toxic


def test_stages_against_brute_force(spark, folder):
    d, rows, items, toxic = folder
    docs, seen = spark.read.parquet(f"{d}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, d)
        if name != "sentencepiece":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema).repartition(3)
        seen[name] = out.collect() if name == "sentencepiece" else docs.collect()
    left = [x for x in rows if x[0] not in toxic]
    assert sorted(r.doc_id for r in seen["toxicity"]) == sorted(x[0] for x in left)
    groups = brute.simhash([(x[0], x[1]) for x in left])
    left = list({x[0]: x for x, (_, c) in zip(left, groups) if x[0] == c}.values())
    assert sorted(r.doc_id for r in seen["simhash"]) == sorted(x[0] for x in left)
    left = [x for x, hit in zip(left, brute.contamination([(x[0], x[1]) for x in left], items)) if not hit[1]]
    assert sorted(r.doc_id for r in seen["decontamination"]) == sorted(x[0] for x in left)
    assert len(left) < 350
    text = {r.doc_id: r.text for r in seen["pii"]}
    for i, t, *_ in left:
        want = pii.redact_text(t, brute.pii_base(t)) if t else t
        assert text[i] == want or any(k in (text[i] or "") for k in ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]"))
        assert not brute.pii_base(text[i])
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in seen["pii"])
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id: list(r.ids) for r in seen["sentencepiece"]} == {i: lib.encode(t or "", add_eos=True) for i, t in text.items()}


def test_run_equals_the_stages(spark, folder):
    d = folder[0]
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, d)
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert sorted(corpus_pipeline.run(spark, d).collect()) == sorted(docs.collect())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test data not present")
def test_each_stage_keeps_most_of_the_given_documents(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    had = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, d))
        left = docs.count()
        least = {"toxicity": 0.85, "simhash": 0.8, "decontamination": 0.9}.get(name, 1)
        assert least * had <= left <= had, name
        had = left


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    from oracle_compare import compare, duck
    r = compare(spark, duck(SF), name, queries.REGISTRY[name], queries.ORACLE[name], SF)
    assert r["status"] == "MATCH", r
