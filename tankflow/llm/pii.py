"""Operator 3: personal data by base patterns and a character-level BiLSTM with CRF transitions.

Base patterns (email, ip, card, phone) are found in every whole text. The tagger
(``tagger.Tagger``, numpy) is trained from labelled spans: windows of a bounded sample of documents
(``SAMPLE_DOCS``, by a hash of the id) with their base spans, together with copies in which a span
is rewritten the way people hide one (no country code, blanks around the @ sign, "at" and dots in brackets or
as words, other separators). It then finds spans that the patterns miss.

Windows: a span of any kind has a digit, an @ sign or a disguised one, so only the surroundings of those and of
disguised dots (``MARGIN`` to each side and on to the end of the address or word that this cuts, merged where they
touch) are cut into windows of ``WINDOW`` characters, each ``STEP`` after the one before. Every character takes its tag from the window in which it lies farthest from
an edge; spans are then read from the tags of the whole text. Nothing is lost by leaving out the
rest: a span that has no sign is not accepted wherever it is. An address of which the tagger marks a part is
taken whole. A span of the tagger is added if its text is valid for its kind (an address with a domain, four parts of at most 255, a Luhn
sum, 9 to 15 digits), whatever brackets, words or separators stand for its signs, and if it touches no base span. Base spans always stay.

Training uses regions of ``SAMPLE_DOCS`` documents up to ``TRAIN_CHARS`` characters each, cut at no span, and
``SAMPLE_WINDOWS`` of them; search covers every whole text.

Cases: a null or empty text has no spans; without any labelled span in the sample there is no
tagger and base spans stand alone; repeated rows get equal results; extra columns are ignored (or
kept, by ``redact``).
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankflow.llm.common import id_and_text, map_batches
from tankflow.llm.tagger import Tagger, symbols

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 3_000
SAMPLE_WINDOWS = 1_200
WINDOW, STEP, MARGIN = 96, 48, 32
#: Disguised copies of a span of each kind: there are more ways to hide an e-mail address.
COPIES = (3, 1, 1, 1)

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits does, so later places in the run needn't be tried
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]+")
_LOCAL_SET = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# disguised signs: the sign or its word in brackets of any kind, the words alone only where they can't be anything else
_OPEN, _CLOSE = r"[\[({<|*~]{1,3} {0,2}", r" {0,2}[\])}>|*~]{1,3}"
_AT = rf"{_OPEN}(?:@|[aA][tT]){_CLOSE}"
_DOT = rf"{_OPEN}(?:\.|[dD][oO][tT]){_CLOSE}"
_HIDDEN = re.compile(rf"{_AT}|{_DOT}| [dD][oO][tT] | [aA][tT] (?=[A-Za-z0-9-]+(?:\.| [dD][oO][tT] )[A-Za-z]{{2}})")
_JOINT = rf" *+(?:@|{_AT}|{_DOT}) *+| ++[dD][oO][tT] ++"
_PLAIN = re.compile(r"[A-Za-z0-9._%+-]*+")
_AFTER = re.compile(rf" *+(?:[A-Za-z0-9._%+-]++|{_JOINT})*+")
#: Characters that the longest joint takes, the blanks around it aside.
_JOINT_CHARS = 13
_JOINT_BEFORE = re.compile(rf"(?:@|{_AT}|{_DOT}|(?<= )[dD][oO][tT])\Z")
_REST = re.compile(rf"[A-Za-z0-9-]*+(?:(?:\.| *+{_DOT} *+| ++[dD][oO][tT] ++)[A-Za-z0-9-]++)*+")
#: Characters of a region that training uses; the cut moves on to the end of a span that it would part.
TRAIN_CHARS = 4 * WINDOW

Span = tuple[int, int, int]  # start, kind's number, end: in the order in which spans are listed


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _ip_ok(parts) -> bool:
    return all(len(p := x.lstrip("0")) <= 3 and int(p or "0") <= 255 for x in parts)


def _card_ok(text: str) -> bool:
    d = re.sub("[^0-9]", "", text) if len(text) <= 60 else ""
    return 12 <= len(d) <= 19 and luhn(d)


def _phone_ok(text: str) -> bool:
    return 9 <= sum(map(text.count, "0123456789")) <= 15


def base_spans(text: str) -> list[Span]:
    """Matches of the base patterns, leftmost and non-overlapping within a kind, in order."""
    found: list[Span] = []
    after, at = 0, text.find("@")
    while at >= 0:  # the local part is the run of its characters in front of the sign
        start = at
        while start > after and text[start - 1] in _LOCAL_SET:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
            after = m.end()
        at = text.find("@", max(at + 1, after))
    if _SIGN.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _ip_ok(m.groups())]
        found += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if _card_ok(m.group())]
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if _phone_ok(m.group())]
    return sorted(found)


def listed(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[k]}:{i}:{j}" for i, k, j in spans])


# -- windows ------------------------------------------------------------------------------------

def _signs(text: str) -> list[tuple[int, int, bool]]:
    """Digits, @ signs and disguised signs: start, end, whether it may join the parts of an address."""
    out = [(m.start(), m.end(), "@" in m.group()) for m in _SIGN.finditer(text)]
    hidden = [(*m.span(), True) for m in _HIDDEN.finditer(text)]
    return sorted(out + hidden) if hidden else out


def _joint_before(text: str, least: int, end: int) -> int | None:
    """Where the joint that ends at ``end`` begins; the word alone is one only between blanks."""
    m = _JOINT_BEFORE.search(text, least, end)
    return m.start() if m else None


def _address_start(text: str, i: int, least: int) -> int:
    """Where the address whose sign is at i begins, or ``least``."""
    def blanks(i):
        while i > least and text[i - 1] == " ":
            i -= 1
        return i

    i = blanks(i)
    while i > least:
        before = i
        while i > least and text[i - 1] in _LOCAL_SET:
            i -= 1
        end = blanks(i)
        m = _joint_before(text, max(least, end - _JOINT_CHARS), end)
        i = i if m is None else blanks(m)
        if i == before:
            break
    return i


def regions(text: str) -> list[tuple[int, int]]:
    """Surroundings of digits, @ signs and disguised signs, merged where they touch; none ends inside an
    address or a word."""
    out: list[tuple[int, int]] = []
    address = 0  # where the last address ends
    for a, b, joins in _signs(text):
        least = out[-1][1] if out else 0
        i, j = max(0, a - MARGIN), min(len(text), b + MARGIN)
        if joins and b > address:
            i = min(i, _address_start(text, a, min(a, least)))
            address = _AFTER.match(text, b).end()
            j = max(j, address)
        while i > least and text[i - 1] in _LOCAL_SET and text[i] in _LOCAL_SET:
            i -= 1
        if j > least:
            j = _PLAIN.match(text, j).end() if text[j - 1] in _LOCAL_SET else j
        if out and i <= least:
            out[-1] = (out[-1][0], max(j, least))
        else:
            out.append((i, j))
    return out


def windows(i: int, j: int) -> list[tuple[int, int]]:
    out = [(i, min(i + WINDOW, j))]
    while out[-1][1] < j:
        i += STEP
        out.append((i, min(i + WINDOW, j)))
    return out


def tags_of(spans: list[Span], i: int, j: int) -> np.ndarray:
    """Tags of the characters i..j: 0 outside, 1 + 2 kind at a span's first character, 2 + 2 kind inside."""
    y = np.zeros(j - i, np.int8)
    for a, k, b in reversed(spans):
        if a < j and b > i:
            y[max(a, i) - i:b - i] = 2 + 2 * k
            if a >= i:
                y[a - i] = 1 + 2 * k
    return y


def _undisguised(k: int, text: str) -> str:
    """``text`` with everything that may stand for a sign of its kind as that sign."""
    dots = rf" *{_DOT} *| +[dD][oO][tT] +"
    if k == 0:
        t = re.sub(dots, ".", re.sub(rf" *(?:{_AT}|@) *", "@", text))
        return t if "@" in t else re.sub(r"(?<=[0-9._%+-])([A-Za-z0-9]*) +[aA][tT] +", r"\1@", t, count=1)
    if k == 1:
        return re.sub(rf"{dots}| *[.·•] *", ".", text)
    if k == 2:
        return re.sub(r"[^A-Za-z0-9]{1,4}", " ", text)
    return re.sub(r"[ ()./_·–-]{1,4}", " ", text.lstrip("(+ "))


def acceptable(k: int, text: str) -> bool:
    """Whether a span of the tagger holds valid data of its kind, however its signs are written: an address with a
    domain that ends in a word, four parts of at most 255, a Luhn sum, 9 to 15 digits in groups."""
    t = _undisguised(k, text)
    if k == 0:
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", t))
    if k == 1:
        m = re.fullmatch(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)", t)
        return bool(m) and _ip_ok(m.groups())
    if k == 2:
        return bool(re.fullmatch(r"[0-9]( ?[0-9])+", t)) and _card_ok(t)
    return bool(re.fullmatch(r"[0-9]+( [0-9]+)+", t)) and _phone_ok(t)


def _disguise(k: int, text: str, r: np.random.Generator) -> str:
    if k == 0:
        if r.integers(3) == 0:
            return text.replace("@", (" @ ", " @", "@ ")[r.integers(3)])
        name, _, domain = text.partition("@")
        left, right = ("[]", "()", "{}", "<>", "[]", "()")[r.integers(6)]
        at = ("@", " @ ", f" {left}at{right} ", f"{left}at{right}")[(0, 1, 2, 3, 2, 3, 2, 2)[r.integers(8)]]
        dot = (".", " dot ", f"{left}dot{right}", f"{left}.{right}", ".")[r.integers(5)]
        return (name.replace(".", dot) if r.integers(2) else name) + at + domain.replace(".", dot)
    if k == 1:
        return text.replace(".", ("[.]", " . ", "(.)")[r.integers(3)])
    if k == 2:
        d, sep = re.sub("[^0-9]", "", text), (".", "/", "  ", "_")[r.integers(4)]
        return sep.join(d[i:i + 4] for i in range(0, len(d), 4))
    return re.sub(r"^\+[0-9]+[ -]?", "", text) if r.integers(2) else "+" + re.sub(r"^\+", "", text)


# -- training -----------------------------------------------------------------------------------

def examples(rows: list[tuple[str, list[Span]]], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags of windows of (text, spans), and of copies with one span disguised."""
    r = np.random.default_rng(seed)
    texts = list(rows)
    for text, spans in rows:
        whole = [s for s in spans if not any(o != s and o[0] < s[2] and s[0] < o[2] for o in spans)]
        for a, k, b in [s for s in whole for _ in range(COPIES[s[1]])]:
            new = _disguise(k, text[a:b], r)
            if new != text[a:b] and acceptable(k, new):
                moved = len(new) - (b - a)
                texts.append((text[:a] + new + text[b:],
                              [(i + moved * (i >= b), q, j + moved * (i >= b)) for i, q, j in spans if i >= b or j <= a]
                              + [(a, k, a + len(new))]))
    x, y = [], []
    for text, spans in texts:
        for i, j in windows(0, len(text)):
            x.append(symbols(text[i:j], WINDOW))
            tag = np.zeros(WINDOW, np.int8)
            tag[:j - i] = tags_of(sorted(spans), i, j)
            y.append(tag)
    return np.array(x), np.array(y)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS,
          id_col: str = "doc_id", text_col: str = "text", epochs: int = 10) -> Tagger | None:
    """Tagger from the base spans of about ``sample_docs`` documents, of whose regions at most
    ``sample_windows`` (those with the smallest hash) reach the driver. None without any span."""
    src = id_and_text(docs, id_col, text_col)
    below = int(min(1.0, sample_docs / max(docs.count(), 1)) * (1 << 30))
    some = src.where(F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(1 << 30)) < below)

    def cut(batches):
        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                spans = base_spans(text)
                for i, j in regions(text):
                    j = min(j, i + TRAIN_CHARS)
                    for a, _, e in spans:
                        if a < j < e:
                            j = e
                    own = [(a - i, k, e - i) for a, k, e in spans if a >= i and e <= j]
                    digest = hashlib.sha256(text[i:j].encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((f"{int(not own)}{digest}", text[i:j], [list(s) for s in own]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.string(), pa.string(), pa.list_(pa.list_(pa.int32()))))], ["place", "text", "spans"])

    found = some.mapInArrow(cut, "place string, text string, spans array<array<int>>").distinct()
    with_spans = found.where(F.col("place").startswith("0")).orderBy("place").limit(sample_windows // 2)
    without = found.where(F.col("place").startswith("1")).orderBy("place").limit(sample_windows // 2)
    rows = [(r.text, [tuple(s) for s in r.spans]) for r in with_spans.unionByName(without).collect()]
    if not any(spans for _, spans in rows):
        return None
    rows.sort()
    x, y = examples(rows)
    tagger = Tagger(1 + 2 * len(KINDS))
    tagger.fit(x, y, epochs)
    return tagger


# -- search -------------------------------------------------------------------------------------

def added_spans(texts: list[str], base: list[list[Span]], tagger: Tagger) -> list[list[Span]]:
    """Spans of the tagger beside the base spans of each text, in order."""
    cut = [(n, w, r) for n, t in enumerate(texts) for r in regions(t) for w in windows(*r)]
    out: list[list[Span]] = [[] for _ in texts]
    region_tags: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for at in range(0, len(cut), 4096):
        some = cut[at:at + 4096]
        tags = tagger.decode(np.array([symbols(texts[n][i:j], WINDOW) for n, (i, j), _ in some]))
        for (n, (i, j), (a, b)), t in zip(some, tags):
            if (n, a) not in region_tags:
                region_tags[n, a] = (np.zeros(b - a, np.int8), np.full(b - a, -1, np.int16))
            tag, depth = region_tags[n, a]
            here = np.arange(j - i)
            # how far from an edge that isn't the region's own
            d = np.minimum(here if i > a else here * 0 + WINDOW, (j - i - 1 - here) if j < b else here * 0 + WINDOW)
            deeper = d > depth[i - a:j - a]
            tag[i - a:j - a][deeper] = t[:j - i][deeper]
            depth[i - a:j - a][deeper] = d[deeper]
    for (n, a), (tag, _) in region_tags.items():
        k, start = None, 0
        for i, t in enumerate([*tag.tolist(), 0]):
            if k is not None and t != 2 + 2 * k:
                s, e = a + start, a + i
                text = texts[n][s:e]
                s, e = s + len(text) - len(text.lstrip()), e - (len(text) - len(text.rstrip()))
                # no kind accepts a text without a sign
                for s, e in ([_joined(texts[n], s, e), _whole(texts[n], s, e)] if s < e and k == 0 else []) + [(s, e)]:
                    if s < e and acceptable(k, texts[n][s:e]) and not any(
                            x < e and y > s for x, _, y in [*base[n], *out[n][-1:]]):
                        out[n].append((s, k, e))
                        break
                k = None
            if t % 2:
                k, start = (t - 1) // 2, i
        out[n].sort()
    return out


def _joined(text: str, s: int, e: int) -> tuple[int, int]:
    """s..e with all that joints and characters of addresses tie to it."""
    s, e = _address_start(text, s, 0), _AFTER.match(text, e).end()
    while e > s and text[e - 1] in " .,":
        e -= 1
    return s, e


def _whole(text: str, s: int, e: int) -> tuple[int, int]:
    """The whole address that s..e is a part of."""
    while s > 0 and text[s - 1] in _LOCAL_SET:
        s -= 1
    return s, _REST.match(text, e).end()


def _found(texts: list[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    base = [base_spans(t) for t in texts]
    return list(zip(base, added_spans(texts, base, tagger) if tagger else [[] for _ in texts]))


def find(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, added): spans of every whole text as arrays of (kind, start, end), in code points."""
    span = "array<struct<kind:string,start:int,`end`:int>>"
    named = lambda spans: [{"kind": KINDS[k], "start": i, "end": j} for i, k, j in spans]
    return _mapped(docs, tagger, id_col, text_col, f"base {span}, added {span}",
                   lambda base, added: (named(base), named(added)))


def report(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every document."""
    def row(base, added):
        kinds = [k for _, k, _ in base]
        return (*map(kinds.count, range(len(KINDS))), hashlib.sha256(listed(base).encode()).hexdigest(),
                listed(sorted(base + added)), len(added))
    return _mapped(docs, tagger, id_col, text_col, "n_email long, n_ip long, n_card long, n_phone long, "
                                                   "base_sha256 string, spans string, n_added long", row)


def _mapped(docs, tagger, id_col, text_col, fields, row):
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def make():
        t = shared.value
        return lambda b: [b.column(0), *map(list, zip(*[row(*x) for x in _found(b.column(1).to_pylist(), t)]))]

    src = id_and_text(docs, id_col, text_col)
    return map_batches(src, make, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {fields}")


def redact_text(text: str, spans: list[Span]) -> str:
    """Each span replaced by its kind in brackets; spans that overlap become one, named after the first."""
    out, after = [], 0
    for i, k, j in sorted(spans):
        if i >= after:
            out += [text[after:i], f"[{KINDS[k].upper()}]"]
        after = max(after, j)
    return "".join([*out, text[after:]])


def redact(docs: DataFrame, tagger: Tagger | None, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """All rows and columns, personal data in the text replaced, and ``size_col`` (if there is one) its new length."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    at = docs.columns.index(text_col)
    size_at = docs.columns.index(size_col) if size_col in docs.columns else None

    def run(batches):
        t = shared.value
        for b in batches:
            texts = b.column(at).to_pylist()
            spans = _found([x or "" for x in texts], t)
            new = [x if x is None or not (p or q) else redact_text(x, p + q) for x, (p, q) in zip(texts, spans)]
            cols = list(b.columns)
            cols[at] = pa.array(new, b.schema.field(at).type)
            if size_at is not None:
                sizes = b.column(size_at).to_pylist()
                cols[size_at] = pa.array([s if x is y else len(y) for s, x, y in zip(sizes, texts, new)],
                                         b.schema.field(size_at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
