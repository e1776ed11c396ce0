"""Operator 8: removal of repeated byte strings by difference-cover blockwise suffix comparison.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else (another document or
the same one, overlaps included) is removed. A suffix array of the whole corpus would hold a row
for each byte; only the question whether the first 200 bytes of a suffix occur again has to be
answered, and it is answered blockwise with a difference cover:

1. *Cover sample.* ``D`` is a perfect difference set modulo ``V`` = 133 (12 residues). For any two
   positions i and j there is a d < V with (i + d) mod V and (j + d) mod V both in D. If 200 bytes at
   i and j are equal, so are the ``V_BLOCK`` = 68 bytes at the two sample positions i + d and j + d.
   Only sample positions (9 % of all) are ranked: is their block the only one of its kind?
2. *Ties.* A suffix without a repeated sample block in its first V positions differs from all others
   within 200 bytes, so its comparison is decided by the sample ranks alone. What remains (the
   long ties) are the suffixes near repeated blocks.
3. *Buckets.* The remaining suffixes are dealt to buckets by their 200-byte key, and each bucket is
   sorted by itself, which bounds memory; equal neighbours may be repeats.
4. *Check.* Of strings whose key another block sent too, a second hash that has nothing to do with the
   first goes the same way. Only strings of which that agrees as well are repeats.

Documents are dealt to blocks by a hash (about ``BLOCK_BYTES`` of text each). A block sends each
bucket one sorted array of its *distinct* keys (a passage that a third of all documents hold is one
entry for each block), and gets back one bit for each: whether another block has it too. Repeats
inside a block are seen there, and compared byte by byte. Keys of whole texts go the same way in step 1: all bytes of
exact copies are repeated, and only the first copy's suffixes are compared with those of other texts. Blocks are cut
from one exchange of the texts, which all steps use.

Keys are 64-bit rolling hashes (of table values for bytes, mixed), sent as 32 bits (sample) or 40 bits beside the
bucket. They only say what has to be checked: a key that two strings share costs a comparison and changes no
result. Step 4 sends all 64 bits of xxh3 of the 200 bytes, whole texts have 128 bits. A wrong
repeat needs two chances at once: of n open suffixes about n * n / 2 ** (40 + bits of the bucket) share a key
with a different string, and each of those meets one of m checked strings with a chance of m / 2 ** 64.

Cases: a null text counts as empty; texts under 200 bytes lose nothing; repeated rows (and any copies)
of 200 bytes or more lose all their bytes; no documents give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_digest, xxh3_128_digest

from tankflow.llm.common import id_and_text

LENGTH = 200
ORDER = 11
V = ORDER * ORDER + ORDER + 1
V_BLOCK = LENGTH - V + 1
#: Text in a block, and text whose keys go to one bucket.
BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 16 << 20
#: Bytes of a key that are sent beside its bucket: of a sample block and of a 200-byte string (a false repeat only
#: costs a comparison), and of the hash that decides.
SAMPLE_WIDTH, KEY_WIDTH, CHECK_WIDTH = 4, 5, 8
#: Added to the bucket of keys of whole texts; twice for the answer which of them another block speaks for.
WHOLE = 1 << 40
#: Bytes hashed at once, and strings compared at once.
PIECE = 1 << 19
COMPARED = 1 << 15


def difference_set(q: int) -> list[int]:
    """Singer's perfect difference set modulo q*q + q + 1 for a prime q: the exponents k for which
    the k-th power of a generator of GF(q^3) lies in a fixed plane."""
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                powers, x = [], (1, 0, 0)  # x^3 = a x^2 + b x + c
                for k in range(q ** 3 - 1):
                    powers.append(x)
                    x = (c * x[2] % q, (x[0] + b * x[2]) % q, (x[1] + a * x[2]) % q)
                    if x == (1, 0, 0):
                        break
                if len(powers) == q ** 3 - 1:
                    return sorted({k % v for k, p in enumerate(powers) if p[2] == 0})
    raise ValueError(f"{q} is not a prime")


D = difference_set(ORDER)
_IN_D = np.zeros(V, bool)
_IN_D[D] = True

_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers:
        n = PIECE + LENGTH
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(n + 1, base, np.uint64)
            p[0] = 1
            with np.errstate(over="ignore"):
                _powers.append(np.multiply.accumulate(p))
    return _powers[0], _powers[1]


def keys(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """64-bit keys of the ``length`` bytes at each place of ``at`` (ascending, all inside data)."""
    out = np.empty(len(at), np.uint64)
    up, down = powers()
    with np.errstate(over="ignore"):
        for start in range(0, len(data), PIECE):
            lo, hi = np.searchsorted(at, [start, start + PIECE])
            if lo == hi:
                continue
            part = data[start:start + PIECE + LENGTH]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_TABLE[part] * up[:len(part)], out=sums[1:])
            i = at[lo:hi] - start
            out[lo:hi] = (sums[i + length] - sums[i]) * down[i]
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0x94D049BB133111EB)
        out ^= out >> np.uint64(32)
    return out


class Block:
    """The documents of one block, in an order that any task finds again."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id").to_pylist()
        data = [t.encode("utf-8", "surrogatepass") for t in table.column("text").to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] if ids[i] is not None else 0, data[i]))
        self.ids, texts = [ids[i] for i in order], [data[i] for i in order]
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.raw = b"".join(texts)
        self.data = np.frombuffer(self.raw, np.uint8)
        # the distinct keys of whole texts that are long enough, which each has, and how often each occurs
        self.long = np.flatnonzero(self.sizes >= LENGTH)
        whole = np.array([xxh3_128_digest(texts[i]) for i in self.long.tolist()], "S16")
        self.whole, self.first, self.of_whole, self.often = np.unique(whole, return_index=True, return_inverse=True,
                                                                      return_counts=True)

    def copies(self, shift: int, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each document whether another one has the same text (of LENGTH bytes or more), and whether one
        of those speaks for it: the first of its block, in the first block."""
        own, at = _slices(self.whole, shift)
        shared = (self.often > 1) | _flags(len(self.whole), own + WHOLE, at, answers)
        later = _flags(len(self.whole), own + 2 * WHOLE, at, answers)
        same, spoken = np.zeros(len(self.sizes), bool), np.zeros(len(self.sizes), bool)
        same[self.long] = shared[self.of_whole]
        spoken[self.long] = later[self.of_whole] | (self.first[self.of_whole] != np.arange(len(self.long)))
        return same, spoken

    def sample(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sample positions, the distinct keys of their blocks, which key each has, how often each occurs."""
        long = self.sizes >= LENGTH
        places = [s + np.flatnonzero(np.resize(_IN_D, n - V_BLOCK + 1)) for s, n in
                  zip(self.starts[long].tolist(), self.sizes[long].tolist())]
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        return (at, *np.unique(keys(self.data, at, V_BLOCK), return_inverse=True, return_counts=True))

    def open_suffixes(self, at: np.ndarray, repeated: np.ndarray, spoken: np.ndarray) -> np.ndarray:
        """Where a suffix of at least LENGTH bytes has a repeated sample block in its first V positions,
        in documents that nothing speaks for."""
        hot = at[repeated]
        cover = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(cover, np.maximum(hot - V + 1, 0), 1)
        np.add.at(cover, hot + 1, -1)
        open_ = np.cumsum(cover[:-1]) > 0
        for s, e, no in zip(self.starts.tolist(), self.ends.tolist(), spoken.tolist()):
            open_[s if no else max(s, e - LENGTH + 1):e] = False  # the last places of a document start no whole string
        return np.flatnonzero(open_)

    def strings(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The keys of the distinct LENGTH-byte strings at places, in order (different strings of one key each have
        theirs), which string each place has, how often each occurs, and one place of each."""
        distinct, of, often = np.unique(keys(self.data, places, LENGTH), return_inverse=True, return_counts=True)
        one = np.empty(len(distinct), np.int64)
        one[of] = places
        other = self.different(places, one[of])
        if other.any():
            number: dict[tuple[int, bytes], int] = {}
            part = np.zeros(len(places), np.int64)
            for i in np.flatnonzero(np.isin(of, of[other])).tolist():
                string = (int(of[i]), self.raw[places[i]:places[i] + LENGTH])
                part[i] = number.setdefault(string, len(number))
            found, of, often = np.unique(of * (len(number) + 1) + part, return_inverse=True, return_counts=True)
            distinct = distinct[found // (len(number) + 1)]
            one = np.empty(len(distinct), np.int64)
            one[of] = places
        return distinct, of, often, one

    def different(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the LENGTH bytes at a and b differ."""
        out = np.zeros(len(a), bool)
        todo = np.flatnonzero(a != b)
        if len(todo):
            every = np.ndarray(len(self.data) - LENGTH + 1, f"V{LENGTH}", self.raw, strides=(1,))
            for i in range(0, len(todo), COMPARED):
                at = todo[i:i + COMPARED]
                x, y = (every[z[at]].view(np.uint64).reshape(-1, LENGTH // 8) for z in (a, b))
                out[at] = (x != y).any(1)
        return out

    def checks(self, one: np.ndarray) -> np.ndarray:
        """The second hash of the LENGTH bytes at each place."""
        raw = self.raw
        return np.frombuffer(b"".join([xxh3_64_digest(raw[i:i + LENGTH]) for i in one.tolist()]), ">u8").astype(np.uint64)


def _slices(distinct: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that sorted keys fall into, and where each bucket's slice begins (and the last ends)."""
    if distinct.dtype.kind == "S":
        distinct = distinct.view(">u8").reshape(-1, 2)[:, 0].astype(np.uint64)
    b = (distinct >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(distinct), np.int64)
    own, first = np.unique(b, return_index=True)
    return own, np.append(first, len(b))


def _flags(n: int, own: np.ndarray, first: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
    """The bits that came back for sorted keys."""
    out = np.zeros(n, bool)
    for b, i, j in zip(own.tolist(), first[:-1].tolist(), first[1:].tolist()):
        if b in answers:
            out[i:j] = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=j - i)
    return out


def _pack(keys_: np.ndarray, bits: int, width: int) -> bytes:
    """Sorted keys of one bucket: the ``width`` bytes after the bucket's bits, first bytes of all, second
    bytes of all and so on. The first ones hardly change from key to key, and shuffles compress them away.
    Keys of whole texts are sent as they are."""
    if keys_.dtype.kind == "S":
        return keys_.tobytes()
    low = (keys_ << np.uint64(bits)) >> np.uint64(64 - 8 * width)
    return low.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width:].T.tobytes()


def _unpack(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, 8 - width:] = planes.T
    return out.view(">u8").ravel().astype(np.uint64)


def _shared(rows: DataFrame, width: int) -> DataFrame:
    """(t, bucket, bits): for each block's array in a bucket which of its keys another block sent too."""
    def compare(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        blocks = table.column("t").to_pylist()
        order = sorted(range(len(blocks)), key=blocks.__getitem__)
        sent = [table.column("keys")[i].as_py() for i in order]
        sent = [_unpack(x, width) if bucket < WHOLE else np.frombuffer(x, "S16") for x in sent]
        every = np.sort(np.concatenate(sent))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        del every
        out = []
        met = np.zeros(len(twice), bool)
        for block, k in zip([blocks[i] for i in order], sent if len(twice) else []):
            at = np.searchsorted(twice, k)
            at[at == len(twice)] = 0
            hit = twice[at] == k
            if hit.any():
                out.append((block, bucket, np.packbits(hit).tobytes()))
                if bucket >= WHOLE:  # and which of them a block before this one has
                    out.append((block, bucket + WHOLE, np.packbits(hit & met[at]).tobytes()))
                    met[at[hit]] = True
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _BITS)], schema=_BITS) if out else _BITS.empty_table()

    return rows.groupBy("bucket").applyInArrow(compare, "t long, bucket long, bits binary")


def _answers(table: pa.Table, step: int) -> dict[int, bytes]:
    return {b: x for s, b, x in zip(*(table.column(c).to_pylist() for c in ("step", "bucket", "bits"))) if s == step}


_BITS = pa.schema([("t", pa.int64()), ("bucket", pa.int64()), ("bits", pa.binary())])
_SENT = pa.schema([("t", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary())])


def _sent(t: int, distinct: np.ndarray, shift: int, width: int, add: int = 0) -> pa.Table:
    own, first = _slices(distinct, shift)
    parts = [_pack(distinct[i:j], 64 - shift, width) for i, j in zip(first[:-1], first[1:])]
    return pa.table([pa.array([t] * len(own), pa.int64()), pa.array(own + add), pa.array(parts, pa.binary())], schema=_SENT)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
            bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_bytes, spans, kept_sha256) of every document: the removed runs as an array of (start,
    end) in bytes, end exclusive, and the digest of what is left."""
    src = id_and_text(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType
    total = src.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    bits = max(0, int(-(-total // bucket_bytes) - 1).bit_length())
    shift = 64 - bits
    dealt = src.withColumn("t", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    def ranks(table: pa.Table) -> pa.Table:
        block, t = Block(table), table.column("t")[0].as_py()
        return pa.concat_tables([_sent(t, block.sample()[1], shift, SAMPLE_WIDTH), _sent(t, block.whole, shift, 8, WHOLE)])

    def state(table: pa.Table, answers: pa.Table):
        block = Block(table)
        at, distinct, of, often = block.sample()
        told = _answers(answers, 1)
        flagged = (often > 1) | _flags(len(distinct), *_slices(distinct, shift), told)
        same, spoken = block.copies(shift, told)
        places = block.open_suffixes(at, flagged[of], spoken)
        return (block, same, places, *block.strings(places))

    def suspects(block: Block, distinct: np.ndarray, one: np.ndarray, answers: pa.Table):
        """The strings whose key another block sent too, their second hashes in order, which hash each has."""
        met = np.flatnonzero(_flags(len(distinct), *_slices(distinct, shift), _answers(answers, 2)))
        return (met, *np.unique(block.checks(one[met]), return_inverse=True))

    def suffixes(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _SENT.empty_table()
        return _sent(table.column("t")[0].as_py(), state(table, answers)[3], shift, KEY_WIDTH)

    def seconds(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or 2 not in answers.column("step").unique().to_pylist():
            return _SENT.empty_table()
        block, _, _, distinct, _, _, one = state(table, answers)
        return _sent(table.column("t")[0].as_py(), suspects(block, distinct, one, answers)[1], shift, CHECK_WIDTH)

    def spans(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return out_schema.empty_table()
        block, same, places, distinct, of, often, one = state(table, answers)
        flagged = often > 1
        if 3 in answers.column("step").unique().to_pylist():
            met, checks, which = suspects(block, distinct, one, answers)
            flagged[met] |= _flags(len(checks), *_slices(checks, shift), _answers(answers, 3))[which]
        hot = places[flagged[of]]
        cover = np.zeros(len(block.data) + 1, np.int32)
        cover[hot] += 1
        cover[hot + LENGTH] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        found, kept = [], []
        for s, e, all_gone in zip(block.starts.tolist(), block.ends.tolist(), same.tolist()):
            gone[s:e] |= all_gone
            g = gone[s:e]
            edge = np.flatnonzero(np.diff(np.concatenate(([False], g, [False]))))
            found.append([{"start": i, "end": j} for i, j in edge.reshape(-1, 2).tolist()])
            kept.append(hashlib.sha256(block.data[s:e][~g].tobytes()).hexdigest())
        return pa.table([pa.array(block.ids, out_schema.field(0).type), pa.array(block.sizes),
                         pa.array(found, out_schema.field(2).type), pa.array(kept)], schema=out_schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    spark = docs.sparkSession
    schema = spark.createDataFrame([], "n_bytes long, spans array<struct<start:long,`end`:long>>, kept_sha256 string").schema
    out_type = src.schema.__class__([src.schema["doc_id"], *schema])
    out_schema = to_arrow_schema(out_type)

    by_block = dealt.groupBy("t")
    first = _shared(by_block.applyInArrow(ranks, "t long, bucket long, keys binary"), SAMPLE_WIDTH).withColumn("step", F.lit(1))
    second = _shared(by_block.cogroup(first.groupBy("t")).applyInArrow(suffixes, "t long, bucket long, keys binary"),
                     KEY_WIDTH).withColumn("step", F.lit(2))
    both = first.unionByName(second)
    third = _shared(by_block.cogroup(both.groupBy("t")).applyInArrow(seconds, "t long, bucket long, keys binary"),
                    CHECK_WIDTH).withColumn("step", F.lit(3))
    return by_block.cogroup(both.unionByName(third).groupBy("t")).applyInArrow(spans, out_type)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return repeats(docs, id_col, text_col).select("doc_id", "n_bytes", length.alias("n_removed"),
                                                  F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
