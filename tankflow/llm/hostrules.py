"""Operator 5: quality rules judged per document and per host.

Each document gets word statistics and a verdict of the base rule. Failures are then added up by
host (the ``source`` of a document). A host's failure rate is shrunk towards the rate of all hosts
with a beta prior whose two parameters come from the hosts themselves (method of moments), so a
host with few documents isn't judged on them alone. A host whose shrunk rate is above
``max_rate`` is rejected, and its verdict is joined back to its documents.

The statistics are written once; only (host, counts) is shuffled, after partial sums in each task,
so a host with a third of all rows costs one row a task. The verdicts are written too: the planner
then sees their real size, and broadcasts them under its own threshold or joins by a shuffle that
adaptive execution can split.

Cases: a null text has no words (and fails the base rule); a null host is a host of its own; no
documents give no rows; with one host, or rates that don't differ, the prior has the weight
``MOST_WEIGHT``; rates that differ more than a beta law can have the weight ``LEAST_WEIGHT``.
Repeated rows count each; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankflow.llm.common import map_batches, materialise

#: A host is rejected if its shrunk failure rate is above this.
MAX_RATE = 0.5
#: Bounds of the prior's weight, counted in documents.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1000.0
MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PCT = 20, 8, 30
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"

_HAS_WORD = re.compile(r"[^ \t-\r]")


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # a 64-bit hash of each window shows most texts to repeat nothing; equal hashes are then checked exactly
    with np.errstate(over="ignore"):
        mixed = (ids + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        h = np.zeros(n, np.uint64)
        for k in range(window):
            h = h * np.uint64(0xBF58476D1CE4E5B9) + mixed[k:k + n]
    s = np.sort(h)
    if not (s[1:] == s[:-1]).any():
        return 0
    rank = ids
    width = 1
    while width < window:  # ranks of windows of 1, 2, 4, ... words: equal rank, equal words
        step = min(width, window - width)
        pair = rank[:len(rank) - step] * (len(words) + 1) + rank[step:]
        rank = np.unique(pair, return_inverse=True)[1]
        width += step
    twice = np.bincount(rank)[rank] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover) > 0).sum())


def measure(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = text.encode().split()  # bytes split at exactly the six blanks
    lines = [x for x in text.split("\n") if _HAS_WORD.search(x)]
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               host_col: str = "source") -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def make():
        def f(b: pa.RecordBatch) -> list:
            rows = list(map(measure, b.column(2).to_pylist()))
            failed = [r[0] < MIN_WORDS or 100 * r[4] > MAX_REPEAT_PCT * r[0] for r in rows]
            return [b.column(0), b.column(1), *map(list, zip(*rows)), failed]
        return f

    kind = src.schema["doc_id"].dataType.simpleString()
    return map_batches(src, make, f"doc_id {kind}, host string, n_words long, word_chars long, n_symbols long, "
                                  "n_dup_lines long, n_repeat_words long, base_failed boolean")


def prior(hosts: DataFrame) -> tuple[float, float]:
    """Parameters (a, b) of the beta prior from the hosts' counts: their mean rate, and a weight
    from how far their rates vary beyond the mean. One row reaches the driver."""
    rate = F.col("failed") / F.col("n")
    r = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("var")).first()
    if r.mean is None:
        return 1.0, 1.0
    between = r.mean * (1 - r.mean)
    weight = MOST_WEIGHT if r["var"] <= 0 else between / r["var"] - 1
    weight = min(max(weight, LEAST_WEIGHT), MOST_WEIGHT)
    return r.mean * weight, (1 - r.mean) * weight


def judge(docs: DataFrame, max_rate: float = MAX_RATE, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source") -> DataFrame:
    """The statistics of each document with host_docs, host_rate (shrunk) and kept."""
    stats = materialise(statistics(docs, id_col, text_col, host_col))
    hosts = materialise(stats.groupBy("host").agg(F.count("*").alias("n"),
                                                  F.sum(F.col("base_failed").cast("long")).alias("failed")))
    a, b = prior(hosts)
    verdicts = materialise(hosts.select(F.col("host").alias("of_host"), F.col("n").alias("host_docs"),
                                        ((F.col("failed") + a) / (F.col("n") + a + b)).alias("host_rate")))
    return (stats.join(verdicts, F.col("host").eqNullSafe(F.col("of_host")))
            .drop("of_host")
            .withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_rate)))
