"""Operator 13: mixing sources to target weights by weighted fair queueing. DataFrame functions only.

A source's target is its weight's share of the budget, at most ``EPOCHS`` times its size; what that leaves goes to
the others by weight until none is above. Each source repeats its documents in the same shuffled order, up to
``EPOCHS`` times. A document's virtual finish time is the number of words of its source up to its end, divided by
the source's target: the moment when it is done if all sources are served at speeds in proportion to their targets. All
sources' documents are range-sorted by finish time and taken while the words taken stay within the budget.

Nothing depends on how rows are stored: rows are counted by (id, source, size), so that equal rows get numbers 1, 2,
..., and the shuffled order is by the first 60 bits of a sha256 of ``seed:id:size:number``. Running sums come from range sorts with prefix
sums by range (``ordering``), so a source with a third of all rows is many tasks. The cut is found in the one range that
the budget ends in; which repeats of a document lie before it is then plain arithmetic on the document's row.

Sources are numbered by code point, null last; their weights repeat. Sums of sizes are one row a source; the shared level
(target = level x weight) is found by a few aggregates over those rows, each a pair of numbers.

Cases: a null text or one without words has size 0 and is never taken; a null source is a source of its own; null ids
are equal ids; repeated rows count each; a source without words has target 0; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tankflow.llm.common import materialise
from tankflow.llm.ordering import range_sorted, running, with_base

WEIGHTS, SHARE_PERCENT, EPOCHS, SEED = (5, 2, 1), 100, 3, "13"
WORD = "[^\\x20\\x09-\\x0D]+"
#: Equal rows that one row stands for while they are numbered.
CHUNK = 10_000


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, number) of every row; equal rows are numbered from 1."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    some = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"))
    equal = some.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    # many equal rows are numbered by many tasks: first one row a chunk, then the rows
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chunks = equal.withColumn("first", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"), F.lit(CHUNK).cast("long")))).repartition(n, "doc_id", "source", "size", "first")
    last = F.least(F.col("n"), F.col("first") + F.lit(CHUNK - 1))
    return materialise(chunks.select("doc_id", "source", "size", F.explode(F.sequence("first", last)).alias("number")))


def targets(by_source: DataFrame, weights: tuple = WEIGHTS, percent: int = SHARE_PERCENT, epochs: int = EPOCHS) -> tuple[DataFrame, int]:
    """(source, source_size, before, target) from (source, source_size), one row a source, and the budget; ``before``: words
    of all sources before it."""
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    sized = with_base(range_sorted(materialise(by_source), [F.asc_nulls_last("source")]), _at=F.lit(1), _before=F.col("source_size"))
    turn = F.pmod(F.col("_at") + F.col("place"), F.lit(len(weights)))
    rows = materialise(sized.select(
        "source", "source_size", (F.col("_before") + F.coalesce(F.sum("source_size").over(inside), F.lit(0))).alias("before"),
        F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")).cast("long").alias("weight")))
    whole = rows.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget = (whole.size or 0) * percent // 100
    most = F.col("source_size") * epochs
    full, open_weight = 0, whole.weight or 0  # what sources at their most hold, weight of the others
    while open_weight:
        share = F.col("weight") * F.lit(budget - full) / F.lit(float(open_weight))
        got = rows.agg(F.sum(F.when(share >= most, most)).alias("full"), F.sum(F.when(share < most, F.col("weight"))).alias("open")).first()
        before, (full, open_weight) = (full, open_weight), (got.full or 0, got.open or 0)
        if before == (full, open_weight):
            break
    target = F.least(F.col("weight") * F.lit(budget - full) / F.lit(float(open_weight)), most.cast("double")) if open_weight else most.cast("double")
    return rows.withColumn("target", target), budget


#: The order in which documents finish; only the first is needed but for ties.
LINE = ("finish", "source", "shuffled", "doc_id", "size", "number")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, percent: int = SHARE_PERCENT, epochs: int = EPOCHS, seed: str = SEED,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) of every row; taken: words the mix takes of it, repeats counted."""
    rows = sizes(docs, id_col, text_col, source_col)
    by_source, budget = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, percent, epochs)
    hashed = F.sha2(F.concat_ws(":", F.lit(seed), *[F.col(c).cast("string") for c in ("doc_id", "size", "number")]), 256)
    rows = rows.withColumn("shuffled", F.conv(F.substring(hashed, 1, 15), 16, 10).cast("long"))
    # sources follow each other in this order: a source's words so far are all words so far, less those of the sources before
    upto = running(range_sorted(rows, [F.asc_nulls_last(c) for c in LINE[1:]]), "size", "upto")
    of_source = by_source.select(F.col("source").alias("_source"), "source_size", "target", "before")
    queue = materialise(upto.join(of_source, F.col("source").eqNullSafe(F.col("_source")))
                        .select(*LINE[1:], "source_size", "target", (F.col("upto") - F.col("before")).alias("upto")))
    finish = lambda epoch: (F.col("upto") + epoch * F.col("source_size")) / F.col("target")
    entries = (queue.where("size > 0 and target > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
               .select(finish(F.col("epoch")).alias("finish"), *LINE[1:]))
    line = range_sorted(entries, [F.asc_nulls_last(c) for c in LINE])
    # the range in which the budget ends, and the first entry in it that doesn't fit
    ends = with_base(line.groupBy("part").agg(F.sum("size").alias("size")), _base=F.col("size"))
    cut = ends.where(F.col("_base") + F.col("size") > budget).orderBy("part").first()
    if cut is None:
        taken_in = lambda epoch: F.lit(True)
    else:
        inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        out = (line.where(F.col("part") == cut.part).withColumn("upto", F.lit(cut["_base"]) + F.sum("size").over(inside))
               .where(F.col("upto") > budget).orderBy("place").first())
        order = lambda cells: F.struct(*[x for c in cells for x in (c.isNull(), c)])  # noqa: E731  nulls last
        first_out = order([F.lit(out[c]).cast(line.schema[c].dataType) for c in LINE])
        taken_in = lambda epoch: order([finish(epoch), *[F.col(c) for c in LINE[1:]]]) < first_out
    times = sum((F.when(taken_in(F.lit(e)), 1).otherwise(0) for e in range(epochs)), F.lit(0))
    taken = F.when((F.col("size") > 0) & (F.col("target") > 0), F.col("size") * times).otherwise(0).cast("long")
    return queue.select("doc_id", "size", "source", "source_size", "target", taken.alias("taken"))
