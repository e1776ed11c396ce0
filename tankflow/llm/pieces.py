"""Operator 10: SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalised as the model says (identity: a space becomes U+2581, one more is put in
front), cut into chunks at word marks and signs, and each distinct chunk is encoded by a
score-ordered agenda of adjacent symbol pairs: the pair whose joined piece has the highest
score is merged first, the leftmost among equals, until no adjacent pair is a piece. Characters
without a piece become byte pieces. No piece of a supported model has a word mark after another
character, and the signs to cut at are found from the vocabulary, so no merge crosses a chunk
border and chunks are independent.

Short chunks are merged in batches: one numpy round merges the best pair of every chunk. Long
ones (no word mark for a long way) use a heap, O(n log n). Every chunk that a worker has not seen
lately is also encoded by the sentencepiece library, in one call for each Arrow batch, and a
difference raises.

Cases: null text counts as empty (only the end id); repeated rows give repeated results; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tankflow.llm.common import id_and_text, map_batches

MARK = "▁"
NO_RANK = np.int32(2**31 - 1)
#: Code points, for symbols that are characters without a piece: symbol -(code point + 1).
POINTS = 0x110000
#: Chunks of more characters than this take the heap.
BATCH_CHARS = 32
#: Chunks that a worker remembers at once; past this it starts anew and keeps those it meets again.
REMEMBERED = 150_000

_codecs: dict[str, "Codec"] = {}


class Codec:
    """Encoder and decoder of one model file (given as bytes, so that executors need no file)."""

    def __init__(self, model: bytes, check: bool = True):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if (train.model_type != train.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.add_dummy_prefix or not norm.escape_whitespaces or not train.byte_fallback
                or train.treat_whitespace_as_suffix):
            raise ValueError("only BPE models with identity normalisation, word marks in front and byte pieces")
        kinds = pb.ModelProto.SentencePiece
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model) if check else None
        self.end = train.eos_id
        self.text = [train.unk_surface if p.type == kinds.UNKNOWN else "" if p.type == kinds.CONTROL else p.piece
                     for p in proto.pieces]
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        piece = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces) or any(
                re.search(f"[^{MARK}]{MARK}", p) for p in piece):
            raise ValueError("user-defined or unused pieces, or word marks inside pieces, are not supported")

        self.symbol = -np.arange(1, POINTS + 1, dtype=np.int32)
        for p, i in piece.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        known = lambda s: piece.get(s, -ord(s) - 1 if len(s) == 1 else None)
        levels = {s: r for r, s in enumerate(sorted({proto.pieces[i].score for i in piece.values()}, reverse=True))}
        pairs = []
        for p, i in piece.items():
            rank = levels[proto.pieces[i].score]
            for cut in range(1, len(p)):
                left, right = known(p[:cut]), known(p[cut:])
                if left is not None and right is not None:
                    pairs.append((self._key(left, right), rank, i))
        pairs.sort()
        self.keys = np.array([k for k, _, _ in pairs], np.int64)
        self.rank = np.array([r for _, r, _ in pairs], np.int32)
        self.merged = np.array([i for _, _, i in pairs], np.int32)
        self.pair = {k: (r, i) for k, r, i in pairs}
        self.name = list(map(str, range(len(self.text))))
        self.cut = re.compile(self._chunk_pattern(piece)).findall
        self.memory: dict[str, tuple[str, int, str]] = {}
        self.older: dict[str, tuple[str, int, str]] = {}

    @staticmethod
    def _chunk_pattern(pieces) -> str:
        """Where a text is cut: before a run of word marks, and between a run of letters and a
        run of signs if no piece joins any letter with the sign at the border (found from the
        vocabulary). So no merge crosses a cut. Where a border may be joined, the chunk goes on
        to the next word mark."""
        signs = {chr(i) for i in range(128) if not chr(i).isalnum()}
        after, before = set(signs), set(signs)  # signs to cut at after a letter, and before one
        for p in pieces:
            for a, b in zip(p, p[1:]):
                if a not in signs and a != MARK:
                    after.discard(b)
                if b not in signs and b != MARK:
                    before.discard(a)
        of = lambda some: re.escape("".join(sorted(some)))
        letter = f"[^{MARK}{of(signs)}]"
        return (f"{MARK}*{letter}++(?=[{of(after)}{MARK}]|\\Z)"
                f"|{MARK}*[{of(signs)}]++(?:(?<=[{of(before)}])(?={letter})|(?={MARK}|\\Z))"
                f"|{MARK}*[^{MARK}]+|{MARK}+")

    @staticmethod
    def _key(left, right):
        return (left + POINTS) * (2 * POINTS) + right + POINTS

    # -- agenda -----------------------------------------------------------------------------

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        k = self._key(left.astype(np.int64), right)
        at = np.searchsorted(self.keys, k)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == k, self.rank[at], NO_RANK)

    def _merge_batch(self, chunks: list[str], width: int) -> list[list[int]]:
        """Symbols of each chunk of at most ``width`` characters; each round merges in each chunk
        the pair of the lowest rank, the leftmost first."""
        n = len(chunks)
        size = np.fromiter(map(len, chunks), np.int32, n)
        sym = self.symbol[np.array(chunks, f"U{width}").view(np.uint32).reshape(n, width)]
        cols = np.arange(width - 1)
        ranks = self._ranks(sym[:, :-1], sym[:, 1:])
        ranks[cols[None, :] >= size[:, None] - 1] = NO_RANK
        out: list = [None] * n
        row = np.arange(n)
        while len(row):
            at = ranks.argmin(1)
            here = np.arange(len(row))
            going = ranks[here, at] != NO_RANK
            for r, s, k in zip(row[~going].tolist(), sym[~going].tolist(), size[~going].tolist()):
                out[r] = s[:k]
            if not going.all():
                row, sym, ranks, size, at = row[going], sym[going], ranks[going], size[going], at[going]
                here = here[:len(row)]
                if not len(row):
                    break
            key = self._key(sym[here, at].astype(np.int64), sym[here, at + 1])
            sym[here, at] = self.merged[np.searchsorted(self.keys, key)]
            # the symbols after the merged pair, and their ranks, move one to the left
            shift = np.minimum(np.arange(width)[None, :] + (np.arange(width)[None, :] > at[:, None]), width - 1)
            sym = np.take_along_axis(sym, shift, 1)
            ranks = np.take_along_axis(ranks, np.minimum(cols[None, :] + (cols[None, :] >= at[:, None]), width - 2), 1)
            size -= 1
            ranks[cols[None, :] >= size[:, None] - 1] = NO_RANK
            for side in (-1, 0):
                col = at + side
                ok = (col >= 0) & (col < size - 1)
                i, c = here[ok], col[ok]
                ranks[i, c] = self._ranks(sym[i, c], sym[i, c + 1])
        return out

    def _merge_heap(self, chunk: str) -> list[int]:
        """The same by a heap of (rank, position, left, right), for chunks of any length."""
        sym: list[int | None] = [int(self.symbol[ord(c)]) for c in chunk]
        before, after = list(range(-1, len(sym) - 1)), [*range(1, len(sym)), -1]
        agenda: list[tuple[int, int, int, int]] = []

        def add(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (hit := self.pair.get(self._key(sym[i], sym[j]))):
                heapq.heappush(agenda, (hit[0], i, sym[i], sym[j]))

        for i in range(len(sym) - 1):
            add(i, i + 1)
        while agenda:
            _, i, left, right = heapq.heappop(agenda)
            j = after[i]
            if sym[i] != left or j < 0 or sym[j] != right:
                continue  # one of the two was merged meanwhile
            sym[i], sym[j] = self.pair[self._key(left, right)][1], None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            add(before[i], i)
            add(i, after[i])
        return [s for s in sym if s is not None]

    def _bytes(self, symbols: list[int]) -> list[int]:
        """Byte pieces for characters without a piece."""
        return [i for s in symbols for i in ([s] if s >= 0 else [self.byte_id[b] for b in chr(-s - 1).encode()])]

    # -- texts ------------------------------------------------------------------------------

    def chunks(self, text: str) -> list[str]:
        return self.cut(MARK + text.replace(" ", MARK)) if text else []

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk."""
        out: list = [None] * len(chunks)
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        low = 0
        for width in (4, 6, 8, 10, 12, 16, 24, BATCH_CHARS):
            some = np.flatnonzero((size > low) & (size <= width)).tolist()
            low = width
            if some:
                for i, s in zip(some, self._merge_batch([chunks[i] for i in some], width)):
                    out[i] = s if min(s) >= 0 else self._bytes(s)
        for i in np.flatnonzero(size > low).tolist():
            out[i] = self._bytes(self._merge_heap(chunks[i]))
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, runs of byte pieces read as UTF-8 (U+FFFD for what is
        not), word marks as spaces, without the space that encoding put in front; the unknown
        id gives its surface, control ids nothing."""
        text = self._surface(ids)
        first = next((self.text[i] for i in ids if self.text[i]), "")
        return text[1:] if first[:1] == MARK else text

    def _surface(self, ids: list[int]) -> str:
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.text[i] for i in ids]).replace(MARK, " ")
        parts: list[bytes] = [bytes([self.byte_of[i]]) if i in self.byte_of else self.text[i].replace(MARK, " ").encode()
                              for i in ids]
        return b"".join(parts).decode("utf-8", "replace")

    def _learn(self, new: list[str]) -> None:
        ids, name = self.encode_chunks(new), self.name
        if self.library is not None:
            # the library puts a mark in front itself; a mark alone is what it makes of no text
            marked = [c if c[0] == MARK else MARK + "\n" + c for c in new]
            theirs = self.library.encode([c[1:] for c in marked], num_threads=1)
            for c, mine, lib in zip(new, ids, theirs):
                if mine != lib and c != MARK and (c[0] == MARK or mine != lib[2:]):
                    raise RuntimeError(f"agenda and library differ on {c!r}: {mine} and {lib}")
            for c, mine, lib in zip(new, ids, self.library.decode(ids, num_threads=1)):
                if self.decode(mine) != lib:
                    raise RuntimeError(f"decoded texts differ on {c!r}: {self.decode(mine)!r} and {lib!r}")
        for c, x in zip(new, ids):
            self.memory[c] = (" ".join([name[i] for i in x]), len(x), self._surface(x))

    def recall(self, texts: list[str]) -> list[list[tuple[str, int, str]]]:
        """For each text its chunks as (ids joined by a space, how many, surface)."""
        cut = [self.chunks(t) for t in texts]
        seen: set[str] = set()
        for c in cut:
            seen.update(c)
        if len(self.memory) > REMEMBERED:
            self.memory, self.older = {}, self.memory
        new = []
        for c in seen.difference(self.memory):
            if c in self.older:
                self.memory[c] = self.older[c]
            else:
                new.append(c)
        if new:
            self._learn(new)
        get = self.memory.__getitem__
        return [list(map(get, c)) for c in cut]

    def encode(self, texts: list[str], end: bool = True) -> list[list[int]]:
        tail = [self.end] if end else []
        return [[int(i) for x in row for i in x[0].split(" ")] + tail for row in self.recall(texts)]


def codec(model: bytes, check: bool = True) -> Codec:
    """One codec for each Python worker and model."""
    key = hashlib.sha256(model).hexdigest() + str(check)
    if key not in _codecs:
        _codecs[key] = Codec(model, check)
    return _codecs[key]


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _groups(texts: list[str], chars: int = 2_000_000):
    """Texts in groups of about ``chars`` characters, to bound what a group's chunks take."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every whole text, with the end id."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def make():
        c = codec(shared.value)
        return lambda b: [b.column(0), [ids for g in _groups(b.column(1).to_pylist()) for ids in c.encode(g)]]

    src = id_and_text(docs, id_col, text_col)
    return map_batches(src, make, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) of a frame that has doc_id and ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_model(model_path))

    def make():
        c = codec(shared.value)
        return lambda b: [b.column(0), [c.decode(ids or []) for ids in b.column(1).to_pylist()]]

    src = encoded.select("doc_id", "ids")
    return map_batches(src, make, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids of every whole text, end
    id included, and of the text that they decode to. One pass; ids stay inside the task."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def digests(c: Codec, text_rows):
        end = str(c.end)
        for row in text_rows:
            line = " ".join([x[0] for x in row] + [end])
            text = "".join([x[2] for x in row])[1:]  # without the mark in front
            yield (sum([x[1] for x in row]) + 1, hashlib.sha256(line.encode()).hexdigest(),
                   hashlib.sha256(text.encode()).hexdigest())

    def make():
        c = codec(shared.value)

        def f(b: pa.RecordBatch) -> list:
            rows = [r for g in _groups(b.column(1).to_pylist()) for r in digests(c, c.recall(g))]
            return [b.column(0), *map(list, zip(*rows))]
        return f

    src = id_and_text(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    return map_batches(src, make, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
