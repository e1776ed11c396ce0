"""Operator 1: toxicity by cumulative-link ordinal regression over sparse text features.

Severity grades 0 < 1 < 2 < 3 are predicted with one weight vector shared by all thresholds:
P(grade <= k) = sigmoid(t_k - w.x), t_1 < t_2 < t_3 (proportional odds). The output is the expected
severity, the sum over k of P(grade >= k). A document is toxic if that reaches the model's ``reject``;
its grade is then the most probable one from 1 on, and 0 for all others, so both say the same.

Features are 1 + log(count) of lower-cased words and of word beginnings (4 to 6 letters). Which
ones count is found by Spark on the labelled sample: texts with each feature are counted by label, and a
feature is kept if it stands out in toxic texts at a false discovery rate of ``FALSE_RATE`` (so what is
significant follows the size of the sample) and at least half of the texts with it are toxic (lower end
of the 95 % interval). Of near copies in the sample (five-word shingles, similarity 0.8 or more as estimated
by 32 minhashes) one of each label counts: the ordinary words of a text with many copies prove nothing.

The regression is fitted by the driver in numpy, on rows as frequent as they are, with a normal prior on
the weights. ``reject`` comes from two-fold cross-fitting (features, weights and thresholds of each half judge the
other half): the least value from ``REJECT`` on by which at most ``CLEAN_FLAGGED`` of the clean texts are
flagged, and always above the severity of a text without any feature.

Labels: a ``grade`` column is used if labels have one. With only a 0/1 ``toxic`` column, a toxic row
gets grade 1, 2 or 3 by the thirds of how often the kept words occur in toxic rows, and others 0.

The fit uses a bounded sample: labelled rows whose hashed id falls below a threshold, about
``max_rows`` of them (all, if there are fewer), and at most ``MAX_FEATURES`` features, the strongest.
Scoring covers every whole text.

Cases: a null or empty text has severity of a text without features and is never toxic; of several labels for
one id the highest counts, and of several labels for one text too; with too few labels for any feature to stand
out (also without toxic labels, or without documents for them) nothing is toxic and the severity is 0;
repeated rows count each; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankflow.llm.common import id_and_text, map_batches, materialise

MAX_ROWS = 20_000
MAX_FEATURES = 20_000
FALSE_RATE = 0.05
GRADES = 3
REJECT = 0.5
CLEAN_FLAGGED = 0.005
PRIOR_SCALE = 3.0
BEGINNINGS = (4, 5, 6)
SHINGLE, SIMILAR, MINHASHES, BAND = 5, 0.8, 32, 4
#: Words that a worker remembers; past this its memory is emptied.
REMEMBERED = 150_000
#: Features that a task counts before it sends its counts on.
COUNTED = 150_000
#: Likelihood ratio that a probability of 0.001 needs; nothing weaker is looked at.
G2_LEAST = 10.8

_WORDS = re.compile(r"[^\W\d_]+").findall


def word_features(word: str) -> list[str]:
    return [word, *[f"{word[:k]}*" for k in BEGINNINGS if len(word) > k]]


class Memory(dict):
    """Word to the numbers of its kept features; most words have none."""

    def __init__(self, number: dict[str, int]):
        super().__init__()
        self.number = number

    def __missing__(self, word: str) -> tuple[int, ...] | None:
        found = tuple(self.number[f] for f in word_features(word) if f in self.number) or None
        self[word] = found
        return found

    def counts(self, text: str) -> Counter:
        if len(self) > REMEMBERED:
            self.clear()
        c: Counter = Counter()
        for f in filter(None, map(self.__getitem__, _WORDS(text.lower()))):
            c.update(f)
        return c


@dataclass
class Model:
    features: list[str]
    weights: np.ndarray
    thresholds: np.ndarray
    reject: float = REJECT

    def severity(self, s: np.ndarray) -> np.ndarray:
        return (1 / (1 + np.exp(-(s[:, None] - self.thresholds)))).sum(1)

    def grade(self, s: np.ndarray) -> np.ndarray:
        """0 below ``reject``, else the most probable grade from 1 on."""
        over = 1 / (1 + np.exp(-(s[:, None] - self.thresholds)))
        p = over - np.concatenate([over[:, 1:], np.zeros((len(s), 1))], 1)
        return np.where(self.severity(s) >= self.reject, 1 + p.argmax(1), 0)


def fit(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int,
        steps: int = 500, rate: float = 0.1, ridge: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds that maximise the penalised likelihood of grades 0..K
    (full-batch Adam). ``rows``, ``cols`` and ``values`` hold the sparse features."""
    n, k = len(grades), int(grades.max())
    of_row = np.full(n, 1.0 / n)
    # parameters: weights, the first threshold, logs of the gaps to the next ones
    p = np.concatenate([np.zeros(n_features), [1.0], np.zeros(k - 1)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, steps + 1):
        w, t = p[:n_features], np.concatenate([[p[n_features]], p[n_features] + np.cumsum(np.exp(p[n_features + 1:]))])
        s = np.bincount(rows, values * w[cols], n)
        up, low = np.append(t, np.inf)[grades], np.insert(t, 0, -np.inf)[grades]
        fu, fl = np.where(grades < k, sig(up - s), 1.0), np.where(grades > 0, sig(low - s), 0.0)
        prob = np.maximum(fu - fl, 1e-12)
        du, dl = of_row * fu * (1 - fu) / prob, of_row * fl * (1 - fl) / prob
        ds = du - dl  # of the loss, by s
        gw = np.bincount(cols, values * ds[rows], n_features) + ridge * w
        gt = -np.bincount(grades, du, k + 1)[:k] + np.bincount(grades, dl, k + 1)[1:]
        tail = np.cumsum(gt[::-1])[::-1]
        g = np.concatenate([gw, [tail[0]], tail[1:] * np.exp(p[n_features + 1:])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return p[:n_features], np.concatenate([[p[n_features]], p[n_features] + np.cumsum(np.exp(p[n_features + 1:]))])


def sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(row, toxic, grade, text) of the distinct texts of about ``max_rows`` labelled rows, chosen by a hash of their id;
    ``row`` is a hash of the text."""
    grade = F.col("grade").cast("int") if "grade" in labels.columns else F.lit(None).cast("int")
    known = (labels.where("doc_id is not null and toxic is not null")
             .groupBy(F.col("doc_id").alias("label_id"))
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic"), F.max(grade).alias("grade")))
    n = known.count()
    below = int(min(1.0, max_rows / max(n, 1)) * (1 << 30))
    some = materialise(known.where(F.pmod(F.xxhash64("label_id", F.lit("sample")), F.lit(1 << 30)) < below))
    # some has about max_rows rows at most, whatever the table holds
    return materialise(id_and_text(docs, id_col, text_col).join(F.broadcast(some), F.col("doc_id") == F.col("label_id"))
                       .groupBy("text").agg(F.max("toxic").alias("toxic"), F.max("grade").alias("grade"))
                       .select(F.xxhash64("text").alias("row"), "toxic", "grade", "text"))


def _minhashes(text: str) -> np.ndarray:
    words = np.array([zlib.crc32(w.encode("utf-8", "replace")) for w in text.lower().split()] or [0], np.uint64)
    k = min(SHINGLE, len(words))
    h = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        h = (h ^ words[i:len(words) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    odd = np.uint64(0xBF58476D1CE4E5B9) * np.arange(1, 2 * MINHASHES, 2, dtype=np.uint64)
    return np.array([((h * o) ^ ((h * o) >> np.uint64(31))).min() for o in odd]).view(np.int64)


def near_copies(rows: DataFrame) -> dict[int, int]:
    """For each row of the sample the smallest row that it is a near copy of, directly or by others. A row is held
    against one row of each group that shares a band of its minhashes, never against all."""
    def make():
        return lambda b: [b.column(0), [_minhashes(t).tolist() for t in b.column(1).to_pylist()]]
    got = map_batches(rows.select("row", "text"), make, "row long, h array<long>").toArrow()  # about max_rows rows
    row = got.column("row").to_numpy()
    h = got.column("h").combine_chunks().flatten().to_numpy().reshape(len(row), MINHASHES)
    order = np.argsort(row)  # the order of tasks is no matter
    row, h = row[order], h[order]
    up = list(range(len(row)))

    def root(i):
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    for at in range(0, MINHASHES, BAND):
        firsts: dict[bytes, list[int]] = {}
        for i in range(len(row)):
            some = firsts.setdefault(h[i, at:at + BAND].tobytes(), [])
            j = next((j for j in some if (h[i] == h[j]).mean() >= SIMILAR), None)
            if j is None:
                some.append(i)
            else:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {int(r): int(row[root(i)]) for i, r in enumerate(row)}


def one_of_each(rows: DataFrame) -> DataFrame:
    """One row of each group of near copies and label, and the half (0 or 1) of its group for cross-fitting."""
    toxic = {r.row: r.toxic > 0 for r in rows.select("row", "toxic").collect()}  # about max_rows rows
    first: dict = {}
    for r, g in sorted(near_copies(rows).items()):
        first.setdefault((g, toxic[r]), r)
    kept = [(r, zlib.crc32(str(g).encode()) & 1) for (g, _), r in first.items()]
    chosen = rows.sparkSession.createDataFrame(kept, "kept long, half int")
    return materialise(rows.join(F.broadcast(chosen), F.col("row") == F.col("kept")).drop("kept"))


#: The parts of the sample that a model is made of: all of it, and the rows that aren't in half 0 or 1.
PARTS = {"all": (0, 1), "not0": (1,), "not1": (0,)}


def choose_features(rows: DataFrame, max_features: int = MAX_FEATURES) -> dict[str, list[str]]:
    """For each of ``PARTS`` the features that stand out in its toxic texts."""
    def count(batches):
        n: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])  # the empty feature counts rows

        def counted():
            cols = list(zip(*n.values())) if n else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), *[pa.array(c, pa.int64()) for c in cols]],
                                              ["feature", "c0", "c1", "t0", "t1"])

        for b in batches:
            for toxic, half, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                k = 2 * (toxic > 0) + half
                for f in {f for w in set(_WORDS(text.lower())) for f in word_features(w)} | {""}:
                    n[f][k] += 1
            if len(n) > COUNTED:  # Spark adds up what a task sends in parts
                yield counted()
                n.clear()
        yield counted()

    counts = materialise(rows.select("toxic", "half", "text").mapInArrow(count, "feature string, c0 long, c1 long, t0 long, t1 long")
                         .groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("c0", "c1", "t0", "t1")])
                         .where("c0 + c1 + t0 + t1 >= 3 or feature = ''"))
    total = counts.where("feature = ''").first()
    out = {}
    for part, halves in PARTS.items():
        clean, toxic = [F.expr(" + ".join(f"{x}{h}" for h in halves)) for x in "ct"]
        t, c = [0.0 if total is None else float(sum(total[f"{x}{h}"] for h in halves)) for x in "tc"]
        if not t or not c:
            out[part] = []
            continue
        some = counts.where("feature <> ''").select("feature", clean.alias("clean"), toxic.alias("toxic")).where("clean + toxic >= 3")
        tested = some.count()
        df = F.col("toxic") + F.col("clean")
        cell = lambda k, e: F.when(k > 0, k * F.log(k / e)).otherwise(F.lit(0.0))
        g2 = 2 * (cell(F.col("toxic"), df * t / (t + c)) + cell(F.col("clean"), df * c / (t + c))
                  + cell(t - F.col("toxic"), (t + c - df) * t / (t + c)) + cell(c - F.col("clean"), (t + c - df) * c / (t + c)))
        share, z = F.col("toxic") / df, 1.96
        least = (share + z * z / 2 / df - z * F.sqrt(share * (1 - share) / df + z * z / 4 / df / df)) / (1 + z * z / df)
        best = (some.where(F.col("toxic") * c > F.col("clean") * t).withColumn("g2", g2)
                .where((F.col("g2") >= G2_LEAST) & (least >= 0.5))
                .orderBy(F.desc("g2"), F.desc(F.length("feature")), "feature").limit(max_features).select("feature", "g2").collect())
        p = np.array([math.erfc(math.sqrt(r.g2 / 2)) for r in best])
        ok = np.flatnonzero(p <= FALSE_RATE * np.arange(1, len(p) + 1) / max(tested, 1))
        out[part] = [r.feature for r in best[:ok[-1] + 1 if len(ok) else 0]]
    return out


@dataclass
class Rows:
    """The sample's features: which row (``at``) has which feature (``cols``) how often (``counts``)."""
    at: np.ndarray
    cols: np.ndarray
    counts: np.ndarray
    toxic: np.ndarray
    grade: np.ndarray  # -1: none given

    def fitted(self, some: np.ndarray, features: list[str], number: dict[str, int]) -> Model | None:
        """The model of the rows ``some`` (a mask) with ``features`` only."""
        old = np.array([number[f] for f in features], np.int64)
        new = np.full(len(number), -1)
        new[old] = np.arange(len(old))
        place = np.cumsum(some) - 1
        use = some[self.at] & (new[self.cols] >= 0)
        at, cols, counts = place[self.at[use]], new[self.cols[use]], self.counts[use]
        n, toxic, grades = int(some.sum()), self.toxic[some], self.grade[some]
        if (grades < 0).all():
            if not toxic.any():
                return None
            word = np.array([not f.endswith("*") for f in features], bool)
            often = np.bincount(at, counts * word[cols], n)
            cut = np.quantile(often[toxic], np.arange(1, GRADES) / GRADES)
            grades = np.where(toxic, 1 + (often[:, None] > cut).sum(1), 0)
        levels, grades = np.unique(np.maximum(grades, 0), return_inverse=True)  # a grade that no row has gets no threshold
        if len(levels) < 2 or not features:
            return None
        w, t = fit(at, cols, 1 + np.log(counts), grades, len(features), ridge=1 / (n * PRIOR_SCALE ** 2))
        return Model(features, w, t)

    def severity(self, model: Model, some: np.ndarray, number: dict[str, int]) -> np.ndarray:
        w = np.zeros(len(number))
        w[[number[f] for f in model.features]] = model.weights
        return model.severity(np.bincount(self.at, w[self.cols] * (1 + np.log(self.counts)), len(some))[some])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id",
          text_col: str = "text") -> Model | None:
    rows = one_of_each(sample(docs, labels, max_rows, id_col, text_col))
    chosen = choose_features(rows)
    number = {f: i for i, f in enumerate(dict.fromkeys(f for part in PARTS for f in chosen[part]))}
    if not chosen["all"]:
        return None

    def make():
        memory = Memory(number)

        def f(b: pa.RecordBatch) -> list:
            found = [memory.counts(t) for t in b.column(4).to_pylist()]
            return [*b.columns[:4], [list(c) for c in found], [list(c.values()) for c in found]]
        return f

    got = map_batches(rows.select("row", "toxic", "grade", "half", "text"), make,
                      "row long, toxic int, grade int, half int, at array<int>, n array<int>").collect()  # about max_rows rows
    got.sort(key=lambda r: r.row)  # the order of tasks is no matter
    data = Rows(np.repeat(np.arange(len(got)), [len(r["at"]) for r in got]), np.array([i for r in got for i in r["at"]], np.int64),
                np.array([i for r in got for i in r["n"]], float), np.array([r.toxic > 0 for r in got], bool),
                np.array([-1 if r.grade is None else max(r.grade, 0) for r in got], np.int64))
    half = np.array([r.half for r in got])
    model = data.fitted(np.ones(len(got), bool), chosen["all"], number)
    if model is None:
        return None
    severities = [np.zeros(0)]  # of clean texts, by the model of the other half
    for h in (0, 1):
        other, clean = data.fitted(half != h, chosen[f"not{h}"], number), (half == h) & ~data.toxic
        if other is not None:
            severities.append(data.severity(other, clean, number))
    worst = np.sort(np.concatenate(severities))[::-1]
    above = [model.severity(np.zeros(1))[0]]
    if len(worst):
        above.append(worst[int(CLEAN_FLAGGED * len(worst))])
    model.reject = max(REJECT, float(np.nextafter(max(above), np.inf)))
    return model


def _score(b_texts: list[str], memory: Memory, model: Model) -> np.ndarray:
    out = np.zeros(len(b_texts))
    for i, text in enumerate(b_texts):
        c = memory.counts(text)
        if c:
            out[i] = sum(model.weights[k] * (1 + np.log(n)) for k, n in sorted(c.items()))
    return out


def _with(model: Model | None, reject: float | None) -> Model | None:
    return model if model is None or reject is None else replace(model, reject=reject)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          reject: float | None = None) -> DataFrame:
    """(doc_id, expected_severity, grade, is_toxic) of every row; ``reject`` replaces the model's."""
    model = _with(model, reject)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        memory = Memory({f: i for i, f in enumerate(m.features)}) if m else None

        def f(b: pa.RecordBatch) -> list:
            if m is None:
                return [b.column(0), [0.0] * b.num_rows, [0] * b.num_rows, [False] * b.num_rows]
            s = _score(b.column(1).to_pylist(), memory, m)
            severity = m.severity(s)
            return [b.column(0), severity.tolist(), m.grade(s).tolist(), (severity >= m.reject).tolist()]
        return f

    src = id_and_text(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    return map_batches(src, make, f"doc_id {kind}, expected_severity double, grade int, is_toxic boolean")


def drop_toxic(docs: DataFrame, model: Model | None, text_col: str = "text", reject: float | None = None) -> DataFrame:
    """The rows that aren't toxic, with all their columns. One pass, no shuffle."""
    model = _with(model, reject)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def keep(batches):
        m = shared.value
        memory = Memory({f: i for i, f in enumerate(m.features)})
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(m.severity(_score(texts, memory, m)) < m.reject))

    return docs.mapInArrow(keep, docs.schema)
