"""Operator 7: SimHash near-duplicates by a byte-position inverted index with count filtering.

Fingerprints: XXH64 (seed 42) of each shingle of three lower-cased words, repeats included; a bit
is 1 if it is set in over half of the hashes. Two fingerprints link if at most ``MAX_BITS`` = 2 of
64 bits differ. Then at most two of the eight byte positions differ, so two linked fingerprints
share at least ``MIN_SHARED`` = 6 positional bytes.

Index: a posting list for each single positional byte would hold a 256th of all fingerprints, so
lists are kept for combinations: at most two of the first six positions differ, so linked
fingerprints agree in at least one of the 15 choices of four of them. A list's key is the choice
and its four bytes. Pairs that meet in a list are taken at the first choice they agree in, their
shared positional bytes are tallied, pairs below six are dropped, the rest is verified by its
differing bits.

Lists longer than ``LONG_LIST`` make no pairs. Each member of such a list emits itself and its
one-bit changes outside the list's bytes (33 values); members that emit one value differ in at
most two bits, and members that differ in at most two bits emit a common value, so linking each
to the smallest that emitted the value finds the same components with work in proportion to the
list.

Only distinct fingerprints enter the index: exact copies cost one partial count a task. Components
come from rounds of contraction under a random order (each round writes its small tables under the
checkpoint folder), then every document gets the smallest doc_id of its component.

Cases: a null or empty text has the fingerprint zero, and links like any other; texts of fewer than
three words hash their whole sequence; repeated rows get equal results, each kept; null ids take
part but are never the smallest unless a component has no other; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tankflow.llm.common import id_and_text, map_batches, materialise

WORDS = 3
SEED = 42
MAX_BITS = 2
MIN_SHARED = 8 - MAX_BITS
PREFIX = 6  # positions of the index
CHOICE = PREFIX - MAX_BITS  # positions of a key
LONG_LIST = 32
CHOICES = list(combinations(range(PREFIX), CHOICE))


def fingerprint(text: str, words: int = WORDS) -> int:
    """The 64-bit fingerprint, as an unsigned number."""
    from xxhash import xxh64_intdigest

    w = text.encode().lower().split()  # bytes: lower-cases A-Z only, splits at the six blanks
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= words:
        h = [xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
        starts = np.concatenate(([0], ends[:-words] + 1))
        h = [xxh64_intdigest(joined[i:j], SEED) for i, j in zip(starts.tolist(), ends[words - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    all_bits = np.array(h, ">u8").view(np.uint8).reshape(-1, 8)
    for i in range(0, len(all_bits), 4096):
        ones += np.unpackbits(all_bits[i:i + 4096], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint as a signed long."""
    src = id_and_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")

    def make():
        def f(b: pa.RecordBatch) -> list:
            fp = np.array([fingerprint(t) for t in b.column(2).to_pylist()], np.uint64)
            return [b.column(0), b.column(1), pa.array(fp.view(np.int64))]
        return f

    return map_batches(src, make, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


def _mask(choice) -> int:
    m = sum(255 << (56 - 8 * p) for p in choice)
    return m - (1 << 64) if m >> 63 else m


MASKS = [_mask(c) for c in CHOICES]


def postings(nodes: DataFrame) -> DataFrame:
    """(slot, key, fp): the lists of the index that each fingerprint is on."""
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in MASKS])
    return nodes.select("fp", F.posexplode(keys).alias("slot", "key"))


def shared_bytes(x: Column) -> Column:
    """How many of the eight positional bytes of two fingerprints agree, from their exclusive or."""
    return sum(((F.shiftrightunsigned(x, 8 * p).bitwiseAND(F.lit(255))) == 0).cast("int") for p in range(8))


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): distinct fingerprints that link, complete up to connection within long lists.
    ``nodes`` has one row for each distinct fp and should be materialised."""
    lists = materialise(postings(nodes).groupBy("slot", "key").agg(F.count("*").alias("n")).where("n > 1"))
    members = materialise(postings(nodes).join(lists, ["slot", "key"]))

    short = members.where(F.col("n") <= LONG_LIST)
    x = F.col("a").bitwiseXOR(F.col("b"))
    first = F.coalesce(*[F.when(x.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(i)) for i, m in enumerate(MASKS)])
    pairs = (short.select("slot", "key", F.col("fp").alias("a"))
             .join(short.select("slot", "key", F.col("fp").alias("b")), ["slot", "key"])
             .where((F.col("a") < F.col("b")) & (F.col("slot") == first))
             .where(shared_bytes(x) >= MIN_SHARED)
             .where(F.bit_count(x) <= MAX_BITS)
             .select("a", "b"))

    bit = F.explode(F.array(F.lit(0).cast("long"), *[F.lit(b - (1 << 64) if b >> 63 else b).cast("long")
                                                    for b in (1 << i for i in range(64))]))
    mask = F.element_at(F.array(*[F.lit(m).cast("long") for m in MASKS]), F.col("slot") + 1)
    emitted = (members.where(F.col("n") > LONG_LIST).select("slot", "fp", mask.alias("mask"), bit.alias("bit"))
               .where(F.col("bit").bitwiseAND(F.col("mask")) == 0)
               .select("slot", "fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("value")))
    lowest = emitted.groupBy("slot", "value").agg(F.min("fp").alias("low"), F.count("*").alias("n")).where("n > 1")
    stars = emitted.join(lowest, ["slot", "value"]).where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b"))
    return pairs.unionByName(stars)


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every document; root is a fingerprint that
    names the component."""
    from tankflow.llm.components import components

    fps = materialise(fingerprints(docs, id_col, text_col))
    nodes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes)).select(F.col("node").alias("fp"), "root")
    linked = nodes.join(roots, "fp")
    smallest = linked.groupBy("root").agg(F.min("first").alias("smallest"))
    merged = linked.join(smallest, "root").select("fp", "root", "smallest")
    of = materialise(nodes.join(merged, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"),
                                                            F.coalesce("smallest", "first").alias("component_id")))
    return fps.join(of, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component with all columns of ``docs``: the one with the smallest id (null
    last), then the smallest hash of its text; of rows equal in both one."""
    found = group(docs, id_col, text_col)
    keys = materialise(found.groupBy("doc_id", "text_hash", "root", "component_id").agg(F.count("*").alias("n")))
    # a row whose id isn't the component's smallest goes; only rows with that id are held against each other
    first = keys.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    best = first.groupBy("root").agg(F.min("text_hash").alias("best"))
    judged = first.join(best, "root").select("doc_id", "text_hash", "n", (F.col("text_hash") == F.col("best")).alias("stays"))
    others = keys.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "text_hash", "n", F.lit(False).alias("stays"))
    special = materialise(judged.unionByName(others).where("not stays or n > 1")
                          .select(F.col("doc_id").alias("special_id"), F.col("text_hash").alias("special_hash"), "stays"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    of, text = F.col(f"row.`{id_col}`"), F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    same = of.eqNullSafe(F.col("special_id")) & (F.xxhash64(text) == F.col("special_hash"))
    out = rows.join(special, same, "left_anti")
    several = special.where("stays")
    if not several.isEmpty():  # of rows that are equal in id and text each task sends one on
        one = F.min_by("row", F.to_json("row")).alias("row")
        out = out.unionByName(rows.join(several, same).groupBy("special_id", "special_hash").agg(one).select("row"))
    return out.select("row.*")
