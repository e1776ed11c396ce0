"""Clustering, importance resampling and mixing against brute force, on tables with planted and awkward rows."""

from __future__ import annotations

import random
from collections import defaultdict

import brute
import numpy as np
import pytest
from test_operators import bench_items, corpus, frame, same

from tankflow.llm import clusters, mixing, ordering, resample
from tankflow.llm.common import prepare


@pytest.fixture(scope="module")
def sp(spark):
    return prepare(spark)


@pytest.fixture(scope="module")
def rows():
    return corpus(1)


@pytest.fixture(scope="module")
def docs(sp, rows):
    return frame(sp, rows).cache()


def tuples(df):
    return [tuple(r) for r in df.collect()]


# -- order ----------------------------------------------------------------------------------

def test_rank_over_ranges(sp):
    r = random.Random(1)
    values = [(r.randrange(50), i) for i in range(3000)] + [(7, 10_000 + i) for i in range(1500)]
    some = sp.createDataFrame(values, "v int, i int").repartition(6)
    from pyspark.sql import functions as F
    got = tuples(ordering.rank(some, [F.desc("v"), F.asc("i")]).select("v", "i", "rank"))
    want = [(v, i, n) for n, (v, i) in enumerate(sorted(values, key=lambda x: (-x[0], x[1])), 1)]
    same(got, want)


# -- 11 -------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, cluster string, v string"


def vectors(sp, rows):
    return sp.createDataFrame([(i, v, 0, "clash", "clash") for i, v in rows], VECTORS).repartition(4)


def some_vectors(n=300, dims=8, seed=2):
    """Values in sixteenths: float32 holds them exactly, and many distances tie."""
    r = random.Random(seed)
    rows = [(i, [r.randrange(-8, 9) / 16 for _ in range(dims)]) for i in range(n)]
    rows += [rows[3]] * 40 + [(1000 + i, rows[5][1]) for i in range(60)] + [(None, rows[7][1]), (None, rows[8][1]), (9, rows[20][1])]
    rows += [(2000, None), (2001, []), (2002, [0.5] * (dims - 1)), (2003, [0.5] * (dims + 1)), (2004, [None] + [0.0] * (dims - 1)),
             (2005, [float("nan")] * dims), (2006, [float("inf")] + [0.0] * (dims - 1)), (2007, [-float("inf")] * dims)]
    return rows


@pytest.mark.parametrize("k,rounds", [(12, 5), (3, 0), (1, 2), (500, 1)])
def test_clusters(sp, k, rounds):
    rows = some_vectors()
    got = tuples(clusters.cluster(vectors(sp, rows), k=k, rounds=rounds, dims=8))
    same(got, brute.cluster(rows, k, rounds, 8))


def test_clusters_large_components(sp):
    """Components beyond 64-bit squares, up to the largest float: exact, and null where a long can't hold the sum."""
    r = random.Random(3)
    rows = some_vectors(40)
    for i, size in enumerate([1e5, 3e9, 1e18, 2.5e30, 3e38] * 4):
        rows.append((5000 + i, [float(np.float32(r.uniform(-size, size))) for _ in range(8)]))
    got = tuples(clusters.cluster(vectors(sp, rows), k=9, rounds=3, dims=8))
    assert any(x[2] is None for x in got) and any(x[2] is not None for x in got)
    same(got, brute.cluster(rows, 9, 3, 8))


def test_clusters_ties_go_to_the_smaller_number():
    cup = clusters.Tournament(np.array([[0, 0], [4, 0], [2, 2], [0, 0]]))
    best, distance = cup.nearest(np.array([[2, 0], [0, 0], [2, 1], [4, 4]]))
    assert best.tolist() == [0, 0, 2, 2] and distance.tolist() == [4, 0, 1, 8]


def test_tournament_equals_all_distances():
    r = np.random.default_rng(0)
    c, x = r.integers(-3, 4, (30, 4)), r.integers(-4, 5, (2000, 4))
    best, distance = clusters.Tournament(c).nearest(x)
    every = ((x[:, None, :] - c[None]) ** 2).sum(2)
    assert (best == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_clusters_empty(sp):
    assert clusters.cluster(vectors(sp, [])).collect() == []
    assert clusters.cluster(vectors(sp, [(1, None), (2, [1.0])])).collect() == []


# -- 12 -------------------------------------------------------------------------------------

@pytest.mark.parametrize("ngrams,buckets", [(1, 10_000), (3, 97), (2, 100_000)])
def test_resample(sp, docs, rows, ngrams, buckets):
    items = bench_items(rows)
    bench = sp.createDataFrame(items, "item_id long, text string")
    got = tuples(resample.resample(docs, bench, ngrams=ngrams, buckets=buckets))
    same(got, brute.resample([(d, t) for d, t, *_ in rows], items, ngrams, buckets))


def test_batches_do_not_mix_documents():
    texts = [b"one two", b"", b"three", b"four five six", b" \xc3\x9f x ", b""]
    words, at, bucket = resample.featurize(texts, 3, 1 << 32, resample.Hashes())
    import zlib
    want = defaultdict(list)
    for i, t in enumerate(texts):
        w = t.split()
        want[i] = sorted(zlib.crc32(b" ".join(w[j:j + n])) for n in (1, 2, 3) for j in range(len(w) - n + 1))
    assert words.tolist() == [len(t.split()) for t in texts]
    assert {i: sorted(bucket[at == i].tolist()) for i in range(len(texts))} == want


def test_resample_prefers_the_target(sp):
    r = random.Random(6)
    a, b = [f"a{i}" for i in range(50)], [f"b{i}" for i in range(50)]
    rows = [(i, " ".join(r.choice(a if i % 4 else b) for _ in range(60))) for i in range(800)]
    items = [(i, " ".join(r.choice(b) for _ in range(40))) for i in range(30)]
    got = resample.resample(sp.createDataFrame(rows, "doc_id long, text string"), sp.createDataFrame(items, "item_id long, text string")).collect()
    drawn = sorted((x.rank, x.doc_id) for x in got if x.rank is not None)
    assert [x for x, _ in drawn] == list(range(1, 81))
    assert sum(d % 4 == 0 for _, d in drawn) > 55  # 80 drawn, 200 of 800 are like the target


def test_resample_repeated_rows(sp):
    """A third of the rows are the same: all get ranks, without gaps."""
    r = random.Random(2)
    rows = [(i, " ".join(r.choice("abcdefgh") * 3 for _ in range(30))) for i in range(400)] + [(7, "aaa bbb " * 15)] * 200
    bench = [(1, "aaa bbb ccc")]
    got = tuples(resample.resample(sp.createDataFrame(rows, "doc_id long, text string").repartition(7),
                                   sp.createDataFrame(bench, "item_id long, text string"), percent=100))
    same(got, brute.resample(rows, bench, percent=100))


def test_resample_empty(sp, docs):
    none = sp.createDataFrame([], "doc_id long, text string")
    bench = sp.createDataFrame([], "item_id long, text string")
    assert resample.resample(none, bench).collect() == []
    assert resample.resample(docs, bench).count() == docs.count()


# -- 13 -------------------------------------------------------------------------------------

def mixed(df):
    return [(*r[:4], round(r.target, 6), r.taken) for r in df.collect()]


def test_mix(docs, rows, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 7)
    same(mixed(mixing.mix(docs)), brute.mix([(d, t, s) for d, t, _, s, *_ in rows]))


@pytest.mark.parametrize("weights,percent,epochs", [((1,), 100, 3), ((100, 1), 150, 2), ((3, 1, 1), 40, 1)])
def test_mix_parameters(docs, rows, weights, percent, epochs):
    same(mixed(mixing.mix(docs, weights, percent, epochs)), brute.mix([(d, t, s) for d, t, _, s, *_ in rows], weights, epochs, percent))


def test_mix_reaches_targets(sp):
    """One source holds a third of all rows, some are so small that they stop at three times their size, one has no words."""
    r = random.Random(9)
    rows = [(i, "w " * r.randrange(0, 30), "big" if i % 3 == 0 else f"s{i % 9}") for i in range(3000)]
    rows += [(5000 + i, "w w w", "aa") for i in range(4)] + [(6000, "", "void"), (6001, None, "void"), (6002, "x y z", None)]
    rows += [(77, "the same row", "big")] * 500 + [(None, "no id", "s1")] * 300
    df = sp.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(df).collect()
    same([(*x[:4], round(x.target, 6), x.taken) for x in got], brute.mix(rows))
    by = defaultdict(lambda: [0, 0, 0])
    for x in got:
        assert 0 <= x.taken <= 3 * x.size and (not x.size or x.taken % x.size == 0)
        by[x.source][0] += x.taken
        by[x.source][1], by[x.source][2] = x.target, x.source_size
    assert all(abs(taken - target) <= 60 and target <= 3 * size for taken, target, size in by.values())
    assert by["aa"][1] == 36 and by["void"][:2] == [0, 0]
    again = mixing.mix(df.repartition(3)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_mix_empty(sp):
    none = sp.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(none).collect() == []
    got = mixing.mix(sp.createDataFrame([(1, None, "a"), (2, " ", None)], none.schema)).collect()
    assert sorted(x.taken for x in got) == [0, 0] and all(x.target == 0 for x in got)
