"""Operator 12: importance resampling towards a target distribution, over hashed word n-grams.

Words are runs of letters, digits and all beyond ASCII (A-Z lower-cased); features are all runs of 1 to ``ngrams``
consecutive words of a text, hashed by crc32 into ``buckets``. A bucket's gain is the log ratio of its smoothed
shares in the target and in the raw texts, times 1000 and floored; a document's weight is the floored mean of the
gains of its features. With Gumbel noise from a hash of the id on top, the highest scores are a draw without
replacement (Xie et al., "Data Selection for Language Models via Importance Resampling", 2023).

Batch concatenation: the texts of an Arrow batch are joined with a separator that no word holds, one regular
expression pass finds the words of all, and binary search in the documents' offsets tells whose each one is. An n-gram is
masked out where its last word belongs to another document than its first; what is left is counted by ``bincount``.

Texts are read once: the buckets of each document are written as 16-bit (or 32-bit) numbers and counted, then
weighed, from that table. Counts are added up by Spark, one row a bucket (``buckets`` is a parameter). The draw is ranked
by a range sort with prefix sums, so no task sees all documents.

Cases: a null or empty text has no feature, weight 0 and is no candidate below ``least_words``; ties of score go to the
smaller id, a null id comes last and is hashed as ``seed:``; repeated rows are drawn each; empty tables count nothing
and return nothing; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankflow.llm.common import id_and_text, map_batches, materialise
from tankflow.llm.ordering import rank

NGRAMS, BUCKETS, SEED, LEAST_WORDS, PERCENT = 1, 10_000, "2024", 20, 10
#: No word holds the separator, nor can it be part of a character of several bytes.
SEPARATOR = b"\n"
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Words that a worker remembers; past this its memory is emptied.
REMEMBERED = 200_000


class Hashes(dict):
    """Word to its crc32."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = h = zlib.crc32(word)
        return h


def featurize(texts: list[bytes], ngrams: int, buckets: int, hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, document of each feature in ascending order, bucket of each feature)."""
    joined = SEPARATOR.join(texts).lower()  # of bytes: A-Z only
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(size + len(SEPARATOR))  # where the next text starts
    words, starts = [], []
    for m in _WORD.finditer(joined):
        words.append(m.group())
        starts.append(m.start())
    of = np.searchsorted(ends, np.array(starts, np.int64), side="right")
    h = np.fromiter(map(hashes.__getitem__, words), np.int64, len(words))
    docs, found = [of], [h]
    for n in range(2, ngrams + 1):
        whole = np.flatnonzero(of[n - 1:] == of[:len(of) - n + 1]) if len(of) >= n else np.zeros(0, np.int64)
        h = np.fromiter((zlib.crc32(b" ".join(words[i:i + n])) for i in whole.tolist()), np.int64, len(whole))
        docs.append(of[whole])
        found.append(h)
    at = np.concatenate(docs)
    order = np.argsort(at, kind="stable")
    return np.bincount(of, minlength=len(texts)), at[order], (np.concatenate(found) % buckets)[order]


def features(docs: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, buckets) of every row; buckets as little-endian numbers."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    src = id_and_text(docs, id_col, text_col)

    def make():
        hashes = Hashes()

        def f(b: pa.RecordBatch) -> list:
            texts = [x or b"" for x in b.column(1).cast(pa.binary()).to_pylist()]
            n_words, at, bucket = featurize(texts, ngrams, buckets, hashes)
            bounds = np.searchsorted(at, np.arange(len(texts) + 1))
            raw, width = bucket.astype(kind).tobytes(), np.dtype(kind).itemsize
            return [b.column(0), n_words.tolist(), np.diff(bounds).tolist(),
                    [raw[i * width:j * width] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]]
        return f

    return map_batches(src, make, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, buckets binary")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows are in each bucket."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches):
        n = np.zeros(buckets, np.int64)
        for b in batches:
            n += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), kind), minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    sums = found.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in sums.collect():  # one row a bucket at most
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floor of 1000 times the log ratio of smoothed shares, by bucket."""
    s, t, k = raw.astype(float), target.astype(float), len(raw)
    return np.floor(1000 * np.log(((t + 1) * (s.sum() + k)) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def resample(docs: DataFrame, target: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS, seed: str = SEED,
             least_words: int = LEAST_WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", target_id_col: str = "item_id") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null for documents that aren't drawn."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    found = materialise(features(docs, ngrams, buckets, id_col, text_col))
    gain = gains(bucket_counts(found, buckets), bucket_counts(features(target, ngrams, buckets, target_id_col, target_text_col), buckets))
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def make():
        gain = shared.value

        def f(b: pa.RecordBatch) -> list:
            n = b.column(2).to_numpy()
            each = gain[np.frombuffer(b"".join(b.column(3).to_pylist()), kind)]
            at = np.repeat(np.arange(len(n)), n)
            total = np.zeros(len(n), np.int64)
            np.add.at(total, at, each)
            return [b.column(0), b.column(1), b.column(2), np.floor_divide(total, np.maximum(n, 1)).tolist()]
        return f

    weighed = map_batches(found, make, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0))))
    scored = materialise(weighed.withColumn("score", F.col("weight") + noise).withColumn("row", F.monotonically_increasing_id()))
    enough = F.col("n_words") >= least_words
    draws = scored.where(enough).count() * percent // 100
    # the row number only splits rows that are equal in score and id
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("row")]
    ranked = rank(scored.where(enough), order)
    columns = ["doc_id", "n_features", "weight", "score"]
    drawn = F.when(F.col("rank") <= draws, F.col("rank"))
    return ranked.select(*columns, drawn.alias("rank")).unionByName(
        scored.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank")))
