"""Operator 6: language identification by multinomial naive Bayes over hashed character n-grams.

Texts are turned into code points, lower-cased, everything but letters becomes one blank, and
n-grams of 1 to 3 of these are hashed to ``2 ** bits`` buckets. Training counts buckets by
language over all training rows: tasks add up their own counts (of at most ``TASK_LANGS`` languages at
a time) and Spark adds those by (language, bucket). The languages are counted first, and buckets are halved until
languages x buckets fit into ``MATRIX_BYTES``: only then are the sums, merged to that many buckets, collected, and the
matrix of log-probabilities broadcast. Scoring a batch adds up, for each document, the
matrix rows of its buckets in numpy, a group of about ``GROUP_CHARS`` characters at a time; a longer text is cut into
overlapping pieces whose scores add up.

``score`` is the posterior probability of the predicted language.

Cases: a null text, or one without a letter, gets ``und`` and score 0, as does any text if
nothing was learned; equal posteriors go to the language first in order; repeated rows count each;
extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tankflow.llm.common import map_batches, materialise

UNKNOWN = "und"
BITS = 16
MAX_N = 3
SMOOTHING = 0.1
MATRIX_BYTES = 64 << 20
#: Languages that a task counts at once; past this it sends its counts on.
TASK_LANGS = 64
#: Characters counted or scored at once.
GROUP_CHARS = 500_000

_BLANK = 32
_LETTER = re.compile(r"[^\W\d_]")
_fold: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """For each code point its lower case if it is a letter, else a blank."""
    if not _fold:
        t = np.full(0x110000, _BLANK, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                t[i] = ord(low) if len(low) == 1 else i
        _fold.append(t)
    return _fold[0]


def grams(texts: list[str], bits: int, before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the n-grams, whose text each is, and how many letters each text has. No n-gram spans two texts or is
    a blank only. ``before``: how many characters at the front of each text only lead up to it (see ``pieces``): n-grams
    that end in them, and their letters, don't count."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    c = fold_table()[raw]
    doc = np.repeat(np.arange(len(texts)), sizes)
    keep = c != _BLANK
    own = None
    if before is not None and before.any():
        own = np.arange(len(c)) - (np.cumsum(sizes) - sizes)[doc] >= before[doc]
    letters = np.bincount(doc[keep if own is None else keep & own], minlength=len(texts))
    keep[:1] = True
    keep[1:] |= (c[:-1] != _BLANK) | (doc[1:] != doc[:-1])  # of a run of blanks the first stays
    c, doc, own = c[keep].astype(np.uint64), doc[keep], own if own is None else own[keep]
    with np.errstate(over="ignore"):
        part = (c + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h, out, whose = np.zeros(len(c), np.uint64), [], []
        for n in range(1, MAX_N + 1):
            if len(c) < n:
                break
            h = h[:len(c) - n + 1] * np.uint64(0xD6E8FEB86659FD93) + part[n - 1:]
            ok = doc[n - 1:] == doc[:len(c) - n + 1]
            if n == 1:
                ok &= c != _BLANK
            if own is not None:
                ok &= own[n - 1:]
            m = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
            out.append((m >> np.uint64(64 - bits)).astype(np.int64)[ok])
            whose.append(doc[:len(c) - n + 1][ok])
    return (np.concatenate(out) if out else np.zeros(0, np.int64),
            np.concatenate(whose) if whose else np.zeros(0, np.int64), letters)


def groups(texts: list[str]):
    """Ranges of texts of about GROUP_CHARS characters."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t)
        if chars >= GROUP_CHARS:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def pieces(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts cut to about GROUP_CHARS characters, whose each piece is, and how many characters (0 or 2) at its front belong
    to the piece before: the longest n-gram needs two. A piece ends with a letter, so that no run of blanks is cut."""
    out, whose, before = [], [], []
    for i, t in enumerate(texts):
        start = lead = 0
        while len(t) - start > GROUP_CHARS:
            end = start + GROUP_CHARS
            while end > start + 2 and not t[end - 1].isalpha():
                end -= 1
            if not t[end - 1].isalpha():  # a run without letters counts as one blank, however long
                after = _LETTER.search(t, start + GROUP_CHARS)
                t = t[:start + 1] + t[after.start() if after else len(t):]
                continue
            out.append(t[start - lead:end])
            whose.append(i)
            before.append(lead)
            start, lead = end, MAX_N - 1
        out.append(t[start - lead:])
        whose.append(i)
        before.append(lead)
    return out, np.array(whose, np.int64), np.array(before, np.int64)


class Model:
    """Log-probabilities: one row for each bucket, one column for each language."""

    def __init__(self, langs: list[str], docs: np.ndarray, counts: np.ndarray):
        self.langs, self.bits = langs, int(np.log2(counts.shape[1]))
        p = counts + SMOOTHING
        self.table = np.ascontiguousarray(np.log(p / p.sum(1, keepdims=True)).T.astype(np.float32))
        self.prior = np.log(docs / docs.sum())

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        cut, whose, before = pieces([t or "" for t in texts])
        total, letters = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        for i, j in groups(cut):
            h, doc, n = grams(cut[i:j], self.bits, before[i:j])
            np.add.at(total, whose[i:j], np.stack([np.bincount(doc, self.table[h, k], j - i) for k in range(len(self.langs))], 1))
            np.add.at(letters, whose[i:j], n)
        total += self.prior
        total -= total.max(1, keepdims=True)
        e = np.exp(total)
        best = e.argmax(1)
        p = e[np.arange(len(texts)), best] / e.sum(1)
        lang = [self.langs[b] if n else UNKNOWN for b, n in zip(best.tolist(), letters.tolist())]
        return lang, np.where(letters > 0, p, 0.0).tolist()


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", bits: int = BITS) -> Model | None:
    """Model of all rows that have a language; None if none has."""
    src = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"),
                                                          F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def count(batches):
        totals: dict[str, list] = {}

        def counted():
            for lang, (n, counts) in totals.items():
                at = np.flatnonzero(counts)
                # bucket -1 counts documents
                bucket, number = np.append(at, -1), np.append(counts[at], n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(bucket)), pa.array(bucket), pa.array(number)],
                                                 ["lang", "bucket", "n"])
            totals.clear()

        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lang in dict.fromkeys(langs):
                if lang not in totals and len(totals) >= TASK_LANGS:
                    yield from counted()
                mine = [t for t, x in zip(texts, langs) if x == lang]
                kept = totals.setdefault(lang, [0, np.zeros(1 << bits, np.int64)])
                kept[0] += len(mine)
                cut, _, before = pieces(mine)
                for i, j in groups(cut):
                    kept[1] += np.bincount(grams(cut[i:j], bits, before[i:j])[0], minlength=1 << bits)
        yield from counted()

    rows = src.mapInArrow(count, "lang string, bucket long, n long")
    sums = materialise(rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    known = sums.where("bucket < 0").count()
    if not known:
        return None
    fewer = bits
    while known << fewer << 2 > MATRIX_BYTES and fewer > 8:
        fewer -= 1
    merged = F.when(F.col("bucket") < 0, F.col("bucket")).otherwise(F.shiftright("bucket", bits - fewer))
    found = sums.groupBy("lang", merged.alias("bucket")).agg(F.sum("n").alias("n")).toArrow()  # languages x buckets of the matrix
    names = found["lang"].to_pylist()
    langs = sorted(set(names))
    at = {x: i for i, x in enumerate(langs)}
    row = np.array([at[x] for x in names])
    bucket, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    counts, per_lang = np.zeros((len(langs), 1 << fewer)), np.zeros(len(langs))
    own = bucket < 0
    per_lang[row[own]] = n[own]
    counts[row[~own], bucket[~own]] = n[~own]
    return Model(langs, per_lang, counts)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
             extra: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, *extra, lang_pred, score) of each row, from its whole text only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    extra = extra or {}
    src = docs.select(F.col(id_col).alias("doc_id"), *[c.alias(k) for k, c in extra.items()],
                      F.col(text_col).alias("text"))

    def make():
        m = shared.value

        def f(b: pa.RecordBatch) -> list:
            texts = b.column(b.num_columns - 1).to_pylist()
            out = m.predict(texts) if m else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            return [*b.columns[:-1], *out]
        return f

    fields = [f"`{x.name}` {x.dataType.simpleString()}" for x in src.schema[:-1]]
    return map_batches(src, make, ", ".join([*fields, "lang_pred string", "score double"]))
