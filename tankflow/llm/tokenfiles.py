"""Operator 4: token ids as flat binary files with 64-bit document offsets.

Format, in one folder of the shared checkpoint folder (or one the caller names):

* ``ids-NNNNN.bin``      ids of shard N, flat little-endian unsigned integers, 2 bytes each if the
                         vocabulary has at most 65,536 ids, else 4
* ``offsets-NNNNN.bin``  little-endian int64: where each document of the shard begins in its ids,
                         and one more for the end (documents + 1 numbers)
* ``index.json``         width, type of the document ids, and per shard the counts and bases of documents and tokens

Documents are dealt out by ranges of doc_id and sorted inside a shard, so shard after shard
holds them in ascending order (null first; of equal ids, inside a shard, by text). Ranges also split rows
with one id, and even equal rows, so no id is one task's. A shard is written by one task
to a name of its attempt and then renamed, so a repeated or speculative task leaves the same
files. The tasks return one row each, and the bases are prefix sums over those rows. A reader
maps the files into memory and adds the bases: ``start`` is the shard's base plus the offset.

Tokenising: with the normaliser and pattern that ``KNOWN`` names no token spans white space, so a text is cut
at spaces and line ends, and each distinct piece goes to the tokenizers library once for as long
as a worker remembers it. With any other tokenizer file the library gets each text whole.

Cases: a null text counts as empty (only the end id); no documents give no shard; repeated rows
are kept each; extra columns are ignored. Folders on stores other than a mounted file system are
reached through ``pyarrow.fs``; those are read by ranges instead of being mapped.
"""

from __future__ import annotations

import gc
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tankflow.llm.common import id_and_text
from tankflow.session import checkpoint_dir

#: Pieces of text that a worker remembers at once; past this it starts anew.
REMEMBERED = 350_000
#: Texts are encoded in groups of about this many characters.
GROUP_CHARS = 2_000_000

#: New words that the library gets in one text.
JOINED = 5_000

_LETTERS = "a-zA-ZÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[{_LETTERS}]+").fullmatch
# letters and signs apart where neither side can join the other: signs without the apostrophe (contractions) and
# those that have composed forms; a piece with anything else stays whole
_PARTS = re.compile(f"[{_LETTERS}]+(?=[.,!?$%&*#;:]|\\Z)|[.,!?$%&*#;:]+(?=[{_LETTERS}]|\\Z)|.+", re.S).findall

_encoders: dict[tuple[int, int], "Encoder | WholeTexts"] = {}


class _Memory:
    """Bytes of the ids of pieces met lately, in two generations."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def turn(self) -> None:
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young

    def recall(self, missing: set[str]) -> list[str]:
        """Of pieces that aren't in ``young`` those that are new; the others are put there."""
        out, old, young = [], self.old, self.young
        for w in missing:
            b = old.get(w)
            if b is None:
                out.append(w)
            else:
                young[w] = b
        return out

    def new(self, seen: set[str]) -> list[str]:
        """The pieces of ``seen`` that are not known; the others are in ``young`` from here on."""
        self.turn()
        return self.recall(seen.difference(self.young))


#: The parts of a tokenizer file on which cutting at white space and between letters and signs rests.
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed",
         "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None, "truncation": None, "padding": None}


class WholeTexts:
    """Ids of texts as bytes of ``width`` each, by any tokenizer: the library encodes whole texts."""

    def __init__(self, tokenizer: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_str(tokenizer)
        self.kind = np.dtype(f"<u{width}")

    def encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]


class Encoder:
    """Ids of texts as bytes of ``width`` each.

    A text is cut at spaces and line ends into pieces. A new piece is cut further between letters and
    signs, where the tokenizer's own pattern cuts too. Words of plain letters (ASCII and precomposed
    Latin, which normalisation leaves alone but for the case) are one unit of that pattern, so new ones
    are encoded by the library in one joined text and parted at the ids that end a word; all else goes to the
    library piece by piece.
    """

    def __init__(self, tokenizer: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_str(tokenizer)
        self.kind = np.dtype(f"<u{width}")
        vocabulary = self.lib.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.pieces, self.words = _Memory(), _Memory()

    def _bytes(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_words(self, new: list[str]) -> None:
        plain = [w for w in new if _PLAIN(w)]
        known = self.words.young
        for i in range(0, len(plain), JOINED):
            some = plain[i:i + JOINED]
            ids = np.array(self.lib.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) != len(some):  # a vocabulary without word ends
                known.update(zip(some, self._bytes(some)))
                continue
            raw, at = ids.tobytes(), 0
            for w, end in zip(some, (cut * self.kind.itemsize).tolist()):
                known[w] = raw[at:end]
                at = end
        other = [w for w in new if not _PLAIN(w)]
        known.update(zip(other, self._bytes(other)))

    def _learn_pieces(self, new: list[str]) -> None:
        parts = [_PARTS(w.lower() if w.isascii() and "<" not in w else w) for w in new]
        met: set[str] = set()
        for p in parts:
            met.update(p)
        self._learn_words(self.words.new(met))
        get = self.words.young.__getitem__
        self.pieces.young.update(zip(new, [b"".join(map(get, p)) for p in parts]))

    def encode(self, texts: list[str]) -> list[bytes]:
        self.pieces.turn()
        known = self.pieces.young
        cut = [t.replace("\n", " ").split(" ") for t in texts]
        got = [list(map(known.get, c)) for c in cut]  # one look-up for each piece; None for what is new
        missing: set[str] = set()
        for c, g in zip(cut, got):
            if None in g:
                missing.update([w for w, b in zip(c, g) if b is None])
        if missing:
            self._learn_pieces(self.pieces.recall(missing))
            got = [[b if b is not None else known[w] for w, b in zip(c, g)] if None in g else g for c, g in zip(cut, got)]
        return [b"".join(g) for g in got]


def encoder(tokenizer: str, width: int) -> Encoder | WholeTexts:
    key = (zlib.crc32(tokenizer.encode()), width)
    if key not in _encoders:
        spec = json.loads(tokenizer)
        known = all(spec.get(k) == v for k, v in KNOWN.items()) and all(t["special"] for t in spec["added_tokens"])
        _encoders[key] = (Encoder if known else WholeTexts)(tokenizer, width)
    return _encoders[key]


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder named as Hadoop or as a plain path names it."""
    uri = re.sub(r"^file:/+", "/", uri)
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def write(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode every whole text, append ``end_id`` to each, write the files; returns the folder."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    width = 2 if max(Tokenizer.from_str(spec).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    shared = spark.sparkContext.broadcast(spec)
    fs, path = open_store(folder)
    fs.create_dir(path, recursive=True)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, task = encoder(shared.value, width), TaskContext.get()
        end = np.array([end_id], e.kind).tobytes()
        store, at = open_store(folder)
        name, attempt = f"{task.partitionId():05d}.bin", f"_{task.taskAttemptId()}"
        offsets, total, docs_here = [np.zeros(1, "<i8")], 0, 0
        out = None
        gc.disable()
        try:
            for b in batches:
                texts = b.column(0).to_pylist()
                start = 0
                while start < len(texts):
                    stop, chars = start, 0
                    while stop < len(texts) and chars < GROUP_CHARS:
                        chars += len(texts[stop])
                        stop += 1
                    parts = e.encode(texts[start:stop])
                    out = out or store.open_output_stream(f"{at}/{attempt}-ids-{name}")
                    out.write(end.join(parts) + end)
                    ends = total + np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // width + 1)
                    offsets.append(ends.astype("<i8"))
                    total, docs_here, start = int(ends[-1]), docs_here + len(parts), stop
        finally:
            gc.enable()
        if out is None:
            return
        out.close()
        with store.open_output_stream(f"{at}/{attempt}-offsets-{name}") as f:
            f.write(np.concatenate(offsets).tobytes())
        for kind in ("ids", "offsets"):
            store.move(f"{at}/{attempt}-{kind}-{name}", f"{at}/{kind}-{name}")
        yield pa.RecordBatch.from_pydict({"shard": pa.array([task.partitionId()], pa.int32()),
                                          "n_docs": pa.array([docs_here], pa.int64()),
                                          "n_tokens": pa.array([total], pa.int64())})

    src = id_and_text(docs, id_col, text_col)
    # nth tells rows of one id apart; ranges are found without reading a text
    ordered = (src.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange("doc_id", "nth")
               .sortWithinPartitions("doc_id", "text").select("text", "doc_id"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    rows = ordered.mapInArrow(_with_ids(shard, folder), "shard int, n_docs long, n_tokens long").collect()
    shards, base_docs, base_tokens = [], 0, 0
    for r in sorted(rows):
        shards.append({"shard": r.shard, "n_docs": r.n_docs, "n_tokens": r.n_tokens,
                       "base_docs": base_docs, "base_tokens": base_tokens})
        base_docs, base_tokens = base_docs + r.n_docs, base_tokens + r.n_tokens
    with fs.open_output_stream(f"{path}/index.json") as f:
        f.write(json.dumps({"width": width, "id_type": id_type, "shards": shards}).encode())
    return folder


def _with_ids(shard, folder: str):
    """Also keeps the documents' ids, in an Arrow file beside each shard: they can be of any type."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, at = open_store(folder)
        name, attempt = f"docs-{task.partitionId():05d}.arrow", f"_{task.taskAttemptId()}"

        def seen():
            stream = sink = None
            for b in batches:
                if b.num_rows:
                    ids = pa.RecordBatch.from_arrays([b.column(1)], ["doc_id"])
                    if sink is None:
                        stream = store.open_output_stream(f"{at}/{attempt}-{name}")
                        sink = pa.ipc.new_file(stream, ids.schema)
                    sink.write_batch(ids)
                    yield b
            if sink is not None:
                sink.close()
                stream.close()
                store.move(f"{at}/{attempt}-{name}", f"{at}/{name}")

        yield from shard(seen())
    return run


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers). One task or more for each shard's documents."""
    fs, path = open_store(folder)
    with fs.open_input_stream(f"{path}/index.json") as f:
        index = json.loads(f.read())
    width = index["width"]
    rows = [(s["shard"], s["base_tokens"]) for s in index["shards"]]
    shards = spark.createDataFrame(rows, "shard int, base long").repartition(max(1, len(rows)))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = open_store(folder)
        for b in batches:
            for n, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = _array(store, f"{at}/ids-{n:05d}.bin", f"<u{width}")
                offsets = np.asarray(_array(store, f"{at}/offsets-{n:05d}.bin", "<i8"))
                begun = 0
                with pa.ipc.open_file(store.open_input_file(f"{at}/docs-{n:05d}.arrow")) as f:
                    for k in range(f.num_record_batches):
                        doc = f.get_batch(k).column(0)
                        o = offsets[begun:begun + len(doc) + 1]
                        crc = [zlib.crc32(ids[i:j].astype("<u4").tobytes()) for i, j in zip(o[:-1], o[1:])]
                        begun += len(doc)
                        yield pa.RecordBatch.from_arrays(
                            [doc, pa.array(o[:-1] + base), pa.array(np.diff(o)), pa.array(crc, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.mapInArrow(load, f"doc_id {index['id_type']}, start long, n_tokens long, ids_crc32 long")


class _Ranges:
    """Reads slices of a file that can't be mapped into memory."""

    def __init__(self, store: pafs.FileSystem, path: str, kind: str):
        self.file, self.kind = store.open_input_file(path), np.dtype(kind)

    def __getitem__(self, s: slice) -> np.ndarray:
        w = self.kind.itemsize
        return np.frombuffer(self.file.read_at((int(s.stop) - int(s.start)) * w, int(s.start) * w), self.kind)

    def __array__(self, dtype=None, copy=None) -> np.ndarray:
        return np.frombuffer(self.file.read_at(self.file.size(), 0), self.kind)


def _array(store: pafs.FileSystem, path: str, kind: str):
    return np.memmap(path, kind, "r") if isinstance(store, pafs.LocalFileSystem) else _Ranges(store, path, kind)
