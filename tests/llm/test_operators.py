"""Each operator against its brute-force version, on tables with planted and awkward rows."""

from __future__ import annotations

import hashlib
import os
import random

import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tankflow.llm import (hostrules, language, pieces, pii, queries, simhash, suffixes, tokenfiles, toxicity, urlrules,
                          winnowing)
from tankflow.llm.common import prepare

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
CLASH = ["w", "h", "m", "t", "fp", "key", "at", "row", "root", "n", "codes", "items", "host", "words", "tokens", "toxic",
         "grade", "special_id", "stays", "copies", "text_hash", "bucket", "step"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def prose(r, n, vocabulary=400):
    return " ".join("".join(r.choice(["an", "er", "th", "ou", "st", "re", "le", "on"]) for _ in range(1 + r.randrange(vocabulary) % 4))
                    for _ in range(n))


def corpus(seed=0):
    """(doc_id, text, lang, source): prose, copies, near copies, shared passages, junk, nulls, empty and long texts."""
    r = random.Random(seed)
    base = [prose(r, r.randrange(3, 300)) for _ in range(60)]
    passage = prose(r, 70)
    texts = list(base)
    texts += base[:8] + [base[0]] * 20
    for i in range(40):  # near copies of one text
        w = base[5].split(" ")
        w[r.randrange(len(w))] = "changed" + str(i)
        texts.append(" ".join(w))
    texts += [b[:200] + " " + passage + "\n" + b[200:] for b in base[10:25]]
    texts += ["", " ", "\n\n", "a", "a b", "a b c", "A b C", None, None, "x" * 500, "ab" * 400, "the same line\n" * 60,
              "Ünïcode ßtraße 中文字 😀 é é     end", "mail bob.smith@example.com or +1 (564) 555-4526, 10.0.0.255",
              "4111 1111 1111 1111 and 1.2.3.4.5.6.7.8 then 999.1.1.1 and a@b@c.de.fg", "###$$$ " * 30, prose(r, 20000)]
    langs = [None if i % 11 == 3 else ("en", "de")[i % 2] for i in range(len(texts))]
    rows = [(i * 3, t, x, None if i % 13 == 5 else f"src{i % 4}") for i, (t, x) in enumerate(zip(texts, langs))]
    rows += [rows[0], rows[0], (None, base[3], "en", None), (None, None, None, None), (None, "no id here", "en", "src1")]
    r.shuffle(rows)
    return rows


def frame(spark, rows):
    full = [(*x, len(x[1]) if x[1] is not None else None, *["clash"] * len(CLASH)) for x in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def key(x):
    return tuple((v is not None, v) for v in x)


def same(got, want):
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.fixture(scope="module")
def sp(spark):
    return prepare(spark)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(sp, rows):
    return frame(sp, rows).cache()


@pytest.fixture(scope="module")
def empty(sp):
    return sp.createDataFrame([], SCHEMA)


# -- 7 --------------------------------------------------------------------------------------

@pytest.mark.parametrize("long_list", [32, 2])
def test_simhash(docs, rows, monkeypatch, long_list):
    monkeypatch.setattr(simhash, "LONG_LIST", long_list)
    got = [(r.doc_id, simhash_hex(r.fp), r.component_id) for r in simhash.group(docs).collect()]
    want = [(d, *x) for (d, *_), x in zip(rows, brute.simhash([(d, t) for d, t, *_ in rows]))]
    same(got, want)


def simhash_hex(fp):
    return f"{fp & (1 << 64) - 1:016x}"


def test_simhash_chain_of_links(sp):
    """A chain of fingerprints two bits apart is one component; lists of every length give the same."""
    r = random.Random(5)
    fps, x = [], r.getrandbits(64)
    for _ in range(60):
        fps.append(x)
        for b in r.sample(range(64), 2):
            x ^= 1 << b
    fps += [r.getrandbits(64) for _ in range(200)]
    nodes = sp.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in set(fps)], "fp long")
    from tankflow.llm.components import components
    root = {r.node: r.root for r in components(simhash.links(nodes)).collect()}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps[:60]]
    assert len({root[f] for f in signed}) == 1


def test_keep_one(docs, rows):
    want = {}
    for (d, t, *_), (_, c) in zip(rows, brute.simhash([(d, t) for d, t, *_ in rows])):
        if d is not None and d == c:
            want[d] = 1
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert len([i for i in ids if i is None]) == 1  # "no id here" is alone in its component


def test_keep_one_of_many_copies(sp):
    """A third of the rows is one component of copies, near copies and equal rows; each other text stays."""
    r = random.Random(17)
    one = prose(r, 200)
    rows = [(i, prose(r, 60)) for i in range(400)] + [(1000 + i, one) for i in range(100)] + [(2000 + i, one + f" end{i}") for i in range(50)]
    rows += [(1000, one)] * 30 + [(5, rows[5][1])] * 20 + [(None, one)] * 10
    docs = sp.createDataFrame([(*x, i % 4) for i, x in enumerate(rows)], "doc_id long, text string, part int").repartition(7)
    want = {}
    for (d, t), (_, c) in zip(rows, brute.simhash(rows)):
        if d is not None and d == c:
            want[d] = t
    same([(x.doc_id, x.text) for x in simhash.keep_one(docs).collect()], list(want.items()))


def test_simhash_empty(empty):
    assert simhash.group(empty).count() == 0 and simhash.keep_one(empty).count() == 0


# -- 8 --------------------------------------------------------------------------------------

@pytest.mark.parametrize("block,bucket", [(1 << 20, 16 << 20), (5000, 3000), (700, 500)])
def test_repeats(docs, rows, block, bucket):
    got = [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), r.kept_sha256)
           for r in suffixes.repeats(docs, block_bytes=block, bucket_bytes=bucket).collect()]
    want = [(d, *x) for (d, *_), x in zip(rows, brute.repeats([(d, t) for d, t, *_ in rows]))]
    same(got, want)


def test_repeats_exact_boundaries(sp):
    r = random.Random(2)
    s = prose(r, 100)
    x, y = s[:200], s[:199]
    rows = [(1, "aa" + x + "bb"), (2, "c" + x + "dddd"), (3, "e" + y + "?f"), (4, x), (5, y), (6, x[1:] + "zz")]
    got = [(q.doc_id, q.n_bytes, q.n_removed, q.n_spans, q.kept_sha256)
           for q in suffixes.deduplicate(sp.createDataFrame(rows, "doc_id long, text string")).collect()]
    same(got, [(d, *b) for (d, _), b in zip(rows, brute.repeats(rows))])


@pytest.mark.parametrize("block", [1 << 20, 5000, 700])
def test_repeats_with_weak_keys(docs, rows, monkeypatch, block):
    """Keys that many different strings share change no result: equal keys are only taken for a repeat once checked."""
    strong = suffixes.keys
    monkeypatch.setattr(suffixes, "keys", lambda data, at, length: strong(data, at, length) & suffixes.np.uint64(0xF0000000000000F0))
    got = [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), r.kept_sha256)
           for r in suffixes.repeats(docs, block_bytes=block, bucket_bytes=3000).collect()]
    same(got, [(d, *x) for (d, *_), x in zip(rows, brute.repeats([(d, t) for d, t, *_ in rows]))])


def test_difference_cover():
    d = suffixes.D
    assert {(a - b) % suffixes.V for a in d for b in d} == set(range(suffixes.V))


def test_repeats_empty(empty):
    assert suffixes.deduplicate(empty).count() == 0


# -- 9 --------------------------------------------------------------------------------------

def bench_items(rows):
    long = [t for _, t, *_ in rows if t and len(t.split()) > 60]
    items = [(i, " ".join(long[i].split()[i:i + 10 + 3 * i])) for i in range(8)]
    items += [(100, " ".join(long[9].split()[4:13])), (101, " ".join(long[10].split()[:5])), (102, "changed7"), (103, "a b c"),
              (104, ""), (105, None), (106, items[2][1]), (107, items[3][1].upper()), (108, "never seen here at all in any text of this")]
    return items


@pytest.mark.parametrize("limit", [100_000, 0])
def test_decontamination(sp, docs, rows, limit):
    items = bench_items(rows)
    bench = sp.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest())
           for r in winnowing.decontaminate(docs, bench, broadcast_windows=limit).collect()]
    want = [(d, *x) for (d, *_), x in zip(rows, brute.contamination([(d, t) for d, t, *_ in rows], items))]
    same(got, want)
    clean = [r.doc_id for r in winnowing.drop_contaminated(docs, bench).select("doc_id").collect()]
    same([(x,) for x in clean], [(w[0],) for w in want if not w[2]])


def test_decontamination_repeating_words(sp):
    """Windows whose smallest hash stays the same over more than seven places."""
    rows = [(1, "x " * 40 + "tail"), (2, "a b " * 30), (3, "a b c " * 20 + "end")]
    items = [(1, "x " * 12), (2, "b a " * 7), (3, "c a b " * 4)]
    got = [(r.doc_id, r.n_words, r.n_hit, len(r["items"])) for r in winnowing.decontaminate(
        sp.createDataFrame(rows, "doc_id long, text string"), sp.createDataFrame(items, "item_id long, text string")).collect()]
    same(got, [(d, *x[:3]) for (d, _), x in zip(rows, brute.contamination(rows, items))])


def test_decontamination_one_window_in_many_items(sp):
    """A template sentence of 10,000 items, met by a third of the documents: the items' ids never travel with the hits."""
    r = random.Random(2)
    template = prose(r, 12)
    items = [(i, f"item{i} {template}") for i in range(10_000)]
    rows = [(i, prose(r, 30) + (f" {template} tail" if i % 3 == 0 else "")) for i in range(90)]
    docs, bench = sp.createDataFrame(rows, "doc_id long, text string"), sp.createDataFrame(items, "item_id long, text string")
    got = [(x.doc_id, x.n_words, x.n_hit, len(x["items"]), hashlib.sha256(",".join(x["items"]).encode()).hexdigest())
           for x in winnowing.decontaminate(docs, bench).collect()]
    every = hashlib.sha256(",".join(sorted(str(i) for i, _ in items)).encode()).hexdigest()
    none = hashlib.sha256(b"").hexdigest()
    same(got, [(i, len(t.split()), 12, 10_000, every) if i % 3 == 0 else (i, len(t.split()), 0, 0, none) for i, t in rows])
    index, holders = winnowing.windows(bench)
    assert index.columns == ["wid", "n", "win", "fp"] and index.count() == 10_000 + 3 and holders.count() == 40_000


def test_decontamination_empty(sp, docs, empty):
    none = sp.createDataFrame([], "item_id long, text string")
    assert winnowing.decontaminate(empty, none).count() == 0
    assert winnowing.decontaminate(docs, none).where("n_hit > 0").count() == 0


# -- 10 -------------------------------------------------------------------------------------

def test_sentencepiece(docs, rows):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = []
    for d, t, *_ in rows:
        ids = lib.encode(t or "", add_eos=True)
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    same([tuple(r) for r in pieces.round_trip(docs, PIECES).collect()], want)
    back = pieces.decode(pieces.encode(docs, PIECES), PIECES)
    same([tuple(r) for r in back.collect()], [(d, lib.decode(lib.encode(t or ""))) for d, t, *_ in rows])


def test_sentencepiece_odd_texts():
    import sentencepiece
    model = pieces.read_model(PIECES)
    lib, mine = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.Codec(model)
    r = random.Random(1)
    texts = ["", " ", "  ", " a", "a ", "\n", "▁a", "a▁b", "a\x00b", "a\x00", "😀", "</s> x <0x41>", "x" * 300, " " * 70,
             "1234567.89 " * 9, "你好世界" * 40, "don't. (well) [e.g.] \"no\"...!?"]
    texts += ["".join(r.choices("abcdefgh .,'$(\n▁éß你😀́\x00", k=r.randrange(80))) for _ in range(4000)]
    assert mine.encode(texts) == lib.encode(texts, add_eos=True)
    ids = [[r.randrange(3, 32000) for _ in range(r.randrange(12))] for _ in range(2000)]
    assert [mine.decode(i) for i in ids] == lib.decode(ids)


def test_sentencepiece_checks_decoding(monkeypatch):
    """Each new chunk's decoded text is held against the library's."""
    c = pieces.Codec(pieces.read_model(PIECES))
    c.encode(["fine so far"])
    monkeypatch.setattr(c, "decode", lambda ids: "something else")
    with pytest.raises(RuntimeError, match="decoded"):
        c.encode(["another one"])


def test_sentencepiece_empty(empty):
    assert pieces.round_trip(empty, PIECES).count() == 0


# -- 4 --------------------------------------------------------------------------------------

def test_token_files(sp, docs, rows):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(WORDS)
    got = [tuple(r) for r in tokenfiles.read(sp, tokenfiles.write(docs, WORDS, 1)).collect()]
    want, start = [], 0
    for d, t, *_ in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((d, start, len(ids), brute.crc(ids)))
        start += len(ids)
    same(got, want)


def test_token_pieces_as_library():
    """Cutting at spaces and line ends changes no id."""
    from tokenizers import Tokenizer
    with open(WORDS, encoding="utf-8") as f:
        spec = f.read()
    lib, mine = Tokenizer.from_str(spec), tokenfiles.Encoder(spec, 2)
    r = random.Random(3)
    texts = ["".join(r.choices("abAB  \n\t.,'sé́ßΣİ你😀  1-", k=r.randrange(60))) for _ in range(5000)]
    texts += ["a<|endoftext|>b c", "it's we'll", "Σας ΣΑΣ"]
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    import numpy as np
    assert [np.frombuffer(b, "<u2").tolist() for b in mine.encode(texts)] == want


def test_token_files_string_ids_and_one_hot_id(sp):
    """Ids of any type come back as they are; a third of the rows has no id, and they are dealt out to several shards."""
    r = random.Random(3)
    rows = [(f"d{i:04d}" if i % 3 else None, prose(r, r.randrange(1, 30))) for i in range(900)]
    docs = sp.createDataFrame(rows, "doc_id string, text string").repartition(6)
    sp.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    folder = tokenfiles.write(docs, WORDS, 1)
    prepare(sp)
    got = tokenfiles.read(sp, folder).collect()
    assert sorted((x.doc_id is not None, x.doc_id or "") for x in got) == sorted((i is not None, i or "") for i, _ in rows)
    line = sorted(got, key=lambda x: x.start)
    assert [x.doc_id is not None for x in line] == [False] * 300 + [True] * 600
    assert [x.doc_id for x in line[300:]] == sorted(i for i, _ in rows if i)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(line, line[1:]))
    import json
    shards = json.load(open(folder.removeprefix("file:") + "/index.json"))["shards"]
    assert max(x["n_docs"] for x in shards) < 300


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_files_other_tokenizers(sp, name):
    """A tokenizer that isn't the known kind encodes whole texts: white space and case are tokens of their own there."""
    from tokenizers import Tokenizer
    path = public_tokenizers.path(name)
    texts = ["Two  Words\n\tand a TAB", "", "  lead", "don't stop, it's 3.14 §§ ünï", "a" * 300]
    docs = sp.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lib = Tokenizer.from_file(path)
    got = {x.doc_id: (x.n_tokens, x.ids_crc32) for x in tokenfiles.read(sp, tokenfiles.write(docs, path, 1)).collect()}
    import zlib
    for i, t in enumerate(texts):
        ids = [*lib.encode(t, add_special_tokens=False).ids, 1]
        assert got[i] == (len(ids), zlib.crc32(tokenfiles.np.array(ids, "<u4").tobytes()))


def test_token_files_empty(sp, empty):
    assert tokenfiles.read(sp, tokenfiles.write(empty, WORDS, 1)).count() == 0


# -- 5 --------------------------------------------------------------------------------------

def test_host_rules(docs, rows):
    got = hostrules.judge(docs, max_rate=0.4).collect()
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    same([(r.doc_id, *(r[c] for c in cols)) for r in got], [(d, *brute.quality(t)) for d, t, *_ in rows])
    failed, hosts = {}, {}
    for _, t, _, host in rows:
        hosts[host] = hosts.get(host, 0) + 1
        failed[host] = failed.get(host, 0) + brute.quality(t)[-1]
    rate = [failed[h] / n for h, n in hosts.items()]
    mean = sum(rate) / len(rate)
    var = sum((x - mean) ** 2 for x in rate) / len(rate)
    weight = min(max(mean * (1 - mean) / var - 1, hostrules.LEAST_WEIGHT), hostrules.MOST_WEIGHT)
    shrunk = {h: (failed[h] + mean * weight) / (n + weight) for h, n in hosts.items()}
    by = {r.doc_id: r for r in got}
    for d, t, _, host in rows:
        if d is not None:
            assert abs(by[d].host_rate - shrunk[host]) < 1e-9
            assert by[d].kept == (not by[d].base_failed and shrunk[host] <= 0.4)


def test_bad_host_is_rejected(sp):
    r = random.Random(4)
    rows = [(i, "bad" if i % 3 == 0 else f"h{i % 7}", "junk " * 50 if i % 3 == 0 and i % 2 else prose(r, 60)) for i in range(600)]
    got = hostrules.judge(sp.createDataFrame(rows, "doc_id long, source string, text string"), max_rate=0.3)
    assert {r.host for r in got.where("host_rate > 0.3").select("host").distinct().collect()} == {"bad"}
    assert got.where("host = 'bad' and kept").count() == 0 and got.where("host <> 'bad' and not kept").count() == 0


def test_host_rules_empty(empty):
    assert hostrules.judge(empty).count() == 0


# -- 6 --------------------------------------------------------------------------------------

def test_language(sp):
    r = random.Random(6)
    syllables = {"aa": "an er th ou st".split(), "bb": "sch ung ein zu ä".split(), "cc": "ción os ra que ñ".split()}
    rows = []
    for i in range(900):
        lang = list(syllables)[i % 3]
        text = " ".join("".join(r.choices(syllables[lang], k=3)) for _ in range(r.randrange(1, 40)))
        rows.append((i, text, None if i % 10 == 0 else lang))
    df = sp.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df.where("doc_id % 4 <> 2"))
    got = {r.doc_id: r for r in language.identify(df, model).collect()}
    held = [i for i in range(900) if i % 4 == 2]
    assert sum(got[i].lang_pred == list(syllables)[i % 3] for i in held) / len(held) > 0.97
    assert all(0 <= x.score <= 1 for x in got.values())


def test_language_brute(sp):
    """Log-probabilities of a small model by plain counting of the same buckets."""
    import numpy as np
    rows = [("aa", "abc abd"), ("bb", "xyz  XyÄ"), ("aa", "1 2 ab"), ("bb", "")]
    model = language.train(sp.createDataFrame(rows, "lang string, text string"), bits=10)
    counts = np.zeros((2, 1 << 10))
    for lang, text in rows:
        folded = "".join(c.lower() if c.isalpha() else " " for c in text)
        while "  " in folded:
            folded = folded.replace("  ", " ")
        for n in (1, 2, 3):
            for i in range(len(folded) - n + 1):
                g = folded[i:i + n]
                if g != " ":
                    # the operator's own bucket of the n-gram, found from a text of its own
                    counts[("aa", "bb").index(lang), language.grams([g], 10)[0][-1]] += 1
    p = counts + language.SMOOTHING
    assert np.allclose(model.table, np.log(p / p.sum(1, keepdims=True)).T, atol=1e-5)


def test_language_many_languages(sp, monkeypatch):
    """With more languages than the matrix has room for, buckets are merged before they are collected; tasks count a few
    languages at a time. The same as counting at once with that many buckets."""
    r = random.Random(12)
    rows = [(i, prose(r, 12) + f" zq{i % 150:03d}xy".translate(str.maketrans("0123456789", "abcdefghij")) * 5, f"l{i % 150:03d}") for i in range(900)]
    docs = sp.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    monkeypatch.setattr(language, "MATRIX_BYTES", 150 << 2 << 10)
    monkeypatch.setattr(language, "TASK_LANGS", 7)
    model = language.train(docs)
    assert model.bits == 10 and len(model.langs) == 150
    counts = language.np.zeros((150, 1 << 10))
    for _, t, x in rows:
        counts[int(x[1:])] += language.np.bincount(language.grams([t], language.BITS)[0] >> language.BITS - 10, minlength=1 << 10)
    want = language.Model(model.langs, language.np.full(150, 6.0), counts)
    assert (model.table == want.table).all() and (model.prior == want.prior).all()
    got = language.identify(docs, model).join(docs, "doc_id").where("lang = lang_pred").count()
    assert got > 700


def test_language_long_texts_in_pieces(sp, monkeypatch):
    """A text cut into pieces has the n-grams of the whole text."""
    r = random.Random(1)
    texts = [prose(r, 400), "x" * 500 + " y", "a b " * 200, "", "é" * 99 + "." + "ab " * 50, " . " * 200 + "end" + " " * 300]
    whole = [sorted(language.grams([t], 12)[0].tolist()) for t in texts]
    monkeypatch.setattr(language, "GROUP_CHARS", 100)
    cut, whose, before = language.pieces(texts)
    assert len(cut) > 20 and max(map(len, cut)) <= 502
    h, doc, letters = language.grams(cut, 12, before)
    for i in range(len(texts)):
        assert sorted(h[whose[doc] == i].tolist()) == whole[i]
        assert letters[whose == i].sum() == sum(c.isalpha() for c in texts[i])


def test_language_awkward(docs, empty):
    model = language.train(docs)
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    blank = [r.doc_id for r in docs.where("text is null or text rlike '^[ \\n#$]*$'").collect()]
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in blank if i is not None)
    assert language.train(empty) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(empty, model).count() == 0


# -- 1 --------------------------------------------------------------------------------------

def toxic_tables(sp, n=1200):
    r = random.Random(8)
    slurs = ["zlurk", "vorgle", "quixnat"]
    rows, labels, truth = [], [], {}
    for i in range(n):
        w = prose(r, r.randrange(20, 200)).split(" ")
        bad = i % 9 == 0
        for _ in range(r.randrange(1, 9) if bad else 0):
            w.insert(r.randrange(len(w)), r.choice(slurs) + r.choice(["", "ed", "ing"]))
        rows.append((i, " ".join(w)))
        truth[i] = bad
        if i % 2:
            labels.append((i, int(bad), 1))
    return sp.createDataFrame(rows, "doc_id long, text string"), sp.createDataFrame(labels, "doc_id long, toxic int, quality int"), truth


def test_toxicity(sp):
    docs, labels, truth = toxic_tables(sp)
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i].is_toxic == bad for i, bad in truth.items())
    assert list(model.thresholds) == sorted(model.thresholds)
    few = [got[i].expected_severity for i, bad in truth.items() if bad]
    assert max(few) > 2 and min(few) >= toxicity.REJECT
    assert sorted(r.doc_id for r in toxicity.drop_toxic(docs, model).collect()) == [i for i, bad in truth.items() if not bad]


@pytest.mark.parametrize("change", [False, True])
def test_toxicity_copies_do_not_hide_slurs(sp, change):
    """A long toxic text whose copies (or near copies) are most of the toxic rows leaves room for slurs of other texts."""
    r = random.Random(21)
    word = lambda: "".join(r.choice("bcdfghklmnprstvw") + r.choice("aeiou") for _ in range(5))
    common, long = [word() for _ in range(400)], [word() for _ in range(900)]
    slurs = ["zlurkish", "vorglean"]
    rows, labels = [], []
    for i in range(1500):
        w = [r.choice(common) for _ in range(60)]
        kind = "copy" if i % 10 < 3 else "slur" if i % 50 == 3 else "clean"
        if kind == "copy":
            w = [*long, "quixnated"]
            if change:
                w[r.randrange(900)] = f"changed{word()}"
        elif kind == "slur":
            w.insert(r.randrange(60), slurs[i // 50 % 2])
        rows.append((i, " ".join(w)))
        labels.append((i, int(kind != "clean"), 1))
    docs = sp.createDataFrame(rows, "doc_id long, text string").repartition(4)
    model = toxicity.train(docs, sp.createDataFrame(labels, "doc_id long, toxic int, quality int"))
    new = [(i, " ".join([*(r.choice(common) for _ in range(30)), s, *(r.choice(common) for _ in range(30))]))
           for i, s in enumerate([*slurs, "plain"] * 5)]
    got = {x.doc_id: x.is_toxic for x in toxicity.score(sp.createDataFrame(new, "doc_id long, text string"), model).collect()}
    assert got == {i: any(s in t for s in slurs) for i, t in new}


def test_toxicity_toxic_rows_without_slur(sp):
    """A third of the toxic labels are on ordinary texts: these and clean texts stay, those with a slur are found."""
    r = random.Random(4)
    rows, labels, slur = [], [], set()
    for i in range(900):
        w = prose(r, r.randrange(30, 120)).split(" ")
        if i % 10 == 0 and i % 30:
            slur.add(i)
            w[r.randrange(len(w))] = r.choice(["zlurkish", "vorglean"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 10 == 0), 1))
    docs = sp.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = toxicity.train(docs, sp.createDataFrame(labels, "doc_id long, toxic int, quality int"))
    assert model.severity(toxicity.np.zeros(1))[0] < model.reject
    got = toxicity.score(docs, model).collect()
    assert all(x.is_toxic == (x.grade > 0) for x in got)
    found = {x.doc_id for x in got if x.is_toxic}
    assert slur <= found and len(found - slur) <= 0.005 * len(rows)


@pytest.mark.parametrize("toxic", [1, 3, 8])
def test_toxicity_few_labels(sp, toxic):
    """With one toxic label nothing stands out and nothing is toxic; with a few, no text without a learned word is."""
    r = random.Random(5)
    rows = [(i, prose(r, 60) + (" zlurkish" if i < toxic else "")) for i in range(60)]
    docs = sp.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, sp.createDataFrame([(i, int(i < toxic), 1) for i in range(60)], "doc_id long, toxic int, quality int"))
    found = {x.doc_id for x in toxicity.score(docs, model).where("is_toxic").collect()}
    assert found == (set(range(8)) if toxic == 8 else set())


def test_toxicity_scores_brute(sp, docs):
    """Scores of the operator are those of the formula, word by word."""
    import math
    import re
    model = toxicity.Model(["an", "ther*", "change*", "lost"], toxicity.np.array([1.5, 0.25, 3.0, 9.0]), toxicity.np.array([1.0, 2.0, 4.0]), 1.25)
    want = []
    for x in docs.select("doc_id", "text").collect():
        count = [0] * 4
        for w in re.findall(r"[^\W\d_]+", (x.text or "").lower()):
            for k, f in enumerate(model.features):
                count[k] += w == f or (f.endswith("*") and len(w) > len(f) - 1 and w.startswith(f[:-1]))
        s = sum(v * (1 + math.log(n)) for v, n in zip(model.weights, count) if n)
        over = [1 / (1 + math.exp(-(s - t))) for t in model.thresholds]
        p = [over[0] - over[1], over[1] - over[2], over[2]]
        bad = sum(over) >= 1.25
        want.append((x.doc_id, round(sum(over), 9), 1 + p.index(max(p)) if bad else 0, bad))
    same([(x.doc_id, round(x.expected_severity, 9), x.grade, x.is_toxic) for x in toxicity.score(docs, model).collect()], want)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test data not present")
@pytest.mark.parametrize("size,caught", [("sf0.001", 7), ("sf0.01", 32)])
def test_toxicity_given_tables(sp, size, caught):
    from tankflow.llm.common import table
    docs, labels = (table(sp, f"/root/testdata/{size}", t) for t in ("documents", "labels"))
    got = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").groupBy("toxic").agg(
        F.sum(F.col("is_toxic").cast("int")).alias("n"), F.count("*").alias("of")).collect()
    n = {x.toxic: x for x in got}
    assert n[0].n <= 0.005 * n[0]["of"] and n[1].n >= caught


def test_toxicity_gradient():
    """The fit's solution has a vanishing numerical gradient of the penalised likelihood."""
    import numpy as np
    r = np.random.default_rng(0)
    n = 400
    x = r.random((n, 3))
    s = x @ np.array([2.0, -1.0, 0.5]) + r.logistic(size=n)
    y = (s > 0.5).astype(int) + (s > 1.5) + (s > 3)
    rows, cols = np.nonzero(x)
    ridge = 1e-3
    w, t = toxicity.fit(rows, cols, x[rows, cols], y, 3, steps=6000, rate=0.02, ridge=ridge)

    def loss(p):
        cum = 1 / (1 + np.exp(-(np.concatenate([[-50], p[3:], [50]])[None, :] - (x @ p[:3])[:, None])))
        return -np.log(np.diff(cum)[np.arange(n), y]).mean() + ridge * (p[:3] ** 2).sum() / 2

    p = np.concatenate([w, t])
    g = [(loss(p + e) - loss(p - e)) / 2e-4 for e in np.eye(len(p)) * 1e-4]
    assert np.abs(g).max() < 2e-3


def test_toxicity_awkward(sp, docs, empty):
    labels = sp.createDataFrame([(0, 1, 1), (0, 0, 1), (None, 1, 0), (3, None, None)], "doc_id long, toxic int, quality int")
    for some in (labels, labels.limit(0)):
        model = toxicity.train(docs, some)
        assert toxicity.score(docs, model).count() == docs.count()
        assert toxicity.drop_toxic(docs, model).columns == docs.columns
    assert toxicity.score(empty, toxicity.train(empty, labels)).count() == 0


# -- 3 --------------------------------------------------------------------------------------

def test_pii_base_spans(rows):
    r = random.Random(9)
    texts = [t or "" for _, t, *_ in rows]
    texts += ["".join(r.choices("ab1234567890 .-+()@%", k=r.randrange(90))) for _ in range(5000)]
    texts += ["".join(r.choices("a1.@+ -", k=r.randrange(60))) for _ in range(5000)]
    texts += ["9" * 6000, "1" * 5000 + ".2.3.4", "a" * 3000 + "@b.c", "1.2.3.00004", "0000000001.2.3.4"]
    import sys
    sys.set_int_max_str_digits(0)
    for t in texts:
        assert pii.base_spans(t) == brute.pii_base(t), t[:200]


def pii_docs(sp, n=400):
    r = random.Random(10)
    rows = []
    for i in range(n):
        w = prose(r, r.randrange(10, 80)).split(" ")
        d = lambda k: "".join(r.choices("0123456789", k=k))  # noqa: E731,B023
        some = [f"user{r.randrange(999)}@mail{r.randrange(9)}.example.com", f"+1 ({d(3)}) {d(3)}-{d(4)}",
                ".".join(str(r.randrange(256)) for _ in range(4)), r.choice(["4111111111111111", "5500005555555559"]),
                f"v{r.randrange(9)}.{r.randrange(9)}", f"{r.randrange(1900, 2030)}", d(7)]
        for x in r.sample(some, 3):
            w.insert(r.randrange(len(w)), x)
        rows.append((i, " ".join(w)))
    return rows, sp.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(scope="module")
def tagger(sp):
    return pii.train(pii_docs(sp)[1])


def test_pii_report(sp, docs, rows, tagger):
    for r in pii.report(docs, tagger).collect():
        base = None if r.doc_id is None else brute.pii_base(next(t for d, t, *_ in rows if d == r.doc_id) or "")
        if base is not None:
            kinds = [k for _, k, _ in base]
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(map(kinds.count, range(4)))
            text = ",".join(f"{pii.KINDS[k]}:{i}:{j}" for i, k, j in base)
            assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
            assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_pii_tagger_finds_disguised(sp, tagger):
    base, _ = pii_docs(sp, 300)
    found = total = wrong = 0
    for _, text in base[200:]:
        spans = pii.base_spans(text)
        for a, k, b in spans:
            if k == 3:
                new = text[:a] + text[a:b][3:] + text[b:]  # the country code is gone
                added = pii.added_spans([new], [pii.base_spans(new)], tagger)[0]
                total += 1
                found += any(kind == 3 and i <= a + 1 and j >= b - 4 for i, kind, j in added)
        wrong += len(pii.added_spans([text], [spans], tagger)[0])
    assert total > 20 and found / total > 0.8
    assert wrong <= 2


@pytest.mark.parametrize("at,dot", [(" [at] ", "."), (" (at) ", " dot "), ("[at]", "[dot]"), ("(at)", "."), (" @ ", " dot "),
                                    (" {at} ", "."), ("<at>", "{dot}"), (" [AT] ", " [DOT] "), ("|at|", " dot "), ("((at))", "*dot*")])
def test_pii_address_without_digit(sp, at, dot):
    r = random.Random(13)
    name = lambda: f"{prose(r, 1, 3)}.{prose(r, 1, 3)}@{prose(r, 1, 3)}.{r.choice(['com', 'org', 'net'])}"
    def text(address):
        w = prose(r, 40).split(" ")
        return " ".join([*w[:20], address, *w[20:]])
    if "tagger" not in ADDRESS:
        ADDRESS["tagger"] = pii.train(sp.createDataFrame([(i, text(name())) for i in range(400)], "doc_id long, text string"))
    found = 0
    for _ in range(40):
        address = name().replace("@", at)
        local, domain = address.split(at)
        address = local + at + domain.replace(".", dot)
        new = text(address)
        a = new.index(address)
        found += (a, 0, a + len(address)) in pii.added_spans([new], [pii.base_spans(new)], ADDRESS["tagger"])[0]
    assert found >= 32


ADDRESS = {}


def test_pii_regions_end_with_the_address():
    label = "a" * 50
    for at in ("@", " @ ", " [at] ", "(at)"):
        for dot in (".", " dot ", "[dot]", "[.]", " (.) "):
            address = f"{label}.{label}{dot}{label}{at}{label}{dot}{label}{dot}org"
            text = f"{'word ' * 30}{address}{' word' * 30}"
            a = text.index(address)
            assert any(i <= a and j >= a + len(address) for i, j in pii.regions(text)), (at, dot)
    assert pii.regions("word " * 50) == []
    for text in ("a@" * 100_000, "1a" * 100_000, "a dot " * 50_000, " " * 100_000 + "@" + " " * 100_000):
        assert all(i < j for i, j in pii.regions(text))


@pytest.mark.parametrize("kind,text", [
    (0, "bob.smith <at> example {dot} com"), (0, "bob_smith at mail.example.org"), (1, "10·0·0·7"), (1, "10 dot 0 dot 0 dot 255"),
    (1, "10{.}0{.}0{.}7"), (2, "4111 - 1111 - 1111 - 1111"), (2, "4111*1111*1111*1111"), (3, "(564) 555/45.26"), (3, "0049_30_1234567")])
def test_pii_data_is_checked_not_its_disguise(kind, text):
    assert pii.acceptable(kind, text)


@pytest.mark.parametrize("kind,text", [
    (0, "look at example.com"), (0, "bob.smith <at> example"), (0, "bob.smith at 3.14"), (1, "10·0·0·777"), (1, "10 0 0 7"), (1, "1.2.3"),
    (2, "4111 - 1111 - 1111 - 1112"), (2, "4111"), (3, "5645554526"), (3, "(564) 555"), (3, "12:30:45 01:02:03")])
def test_pii_invalid_data_is_not_accepted(kind, text):
    assert not pii.acceptable(kind, text)


def test_pii_long_joint(sp):
    """The address in front of a sign is found over any number of blanks."""
    text = "word " * 30 + "first" + " " * 40 + "[dot]" + " " * 25 + "last" + " " * 60 + "[at] example.org" + " word" * 20
    a, b = text.index("first"), text.index("example.org") + len("example.org")
    assert any(i <= a and j >= b for i, j in pii.regions(text))


def test_pii_training_cuts_no_span(sp, monkeypatch):
    """A long region is cut behind a span, not in it: what training gets has whole spans with all their characters."""
    seen = []

    def stop(rows):
        seen.extend(rows)
        raise StopIteration
    monkeypatch.setattr(pii, "examples", stop)
    text = " ".join(f"user{i}@mail{i}.example.com" for i in range(60))
    with pytest.raises(StopIteration):
        pii.train(sp.createDataFrame([(1, text)], "doc_id long, text string"))
    for part, spans in seen:
        assert part in text and len(part) >= pii.TRAIN_CHARS
        assert spans == pii.base_spans(part) and part[spans[-1][0]:spans[-1][2]] in text.split(" ")


def test_pii_windows_cover():
    r = random.Random(11)
    for _ in range(200):
        text = "".join(r.choices("abcdef 1@", weights=[9] * 7 + [1, 1], k=r.randrange(400)))
        for i, j in pii.regions(text):
            w = pii.windows(i, j)
            assert w[0][0] == i and w[-1][1] == j and all(x[0] <= p[1] for p, x in zip(w, w[1:]))


def test_pii_gradient():
    """The tagger's gradient against differences of its loss."""
    import numpy as np
    from tankflow.llm.tagger import Tagger, symbols
    t = Tagger(3, embed=3, hidden=2)
    for k in t.p:
        t.p[k] = t.p[k].astype(np.float64) + 0.05
    x = np.array([symbols("ab1@c", 7), symbols("zz 9", 7)]).T
    y = np.zeros((7, 2), np.int8)
    y[1, 0], y[2, 0], y[3, 1] = 1, 2, 1
    _, g = t._loss(x, y)
    r = np.random.default_rng(0)
    for k, p in t.p.items():
        for _ in range(4):
            at = tuple(r.integers(n) for n in p.shape)
            keep = p[at]
            p[at] = keep + 1e-4
            up = t._loss(x, y)[0]
            p[at] = keep - 1e-4
            down = t._loss(x, y)[0]
            p[at] = keep
            assert abs((up - down) / 2e-4 - g[k][at]) < 2e-3, (k, at)


def test_pii_redact(docs, empty, tagger):
    out = pii.redact(docs, tagger)
    assert out.columns == docs.columns and out.count() == docs.count()
    for r in out.where("text like '%[EMAIL]%'").collect():
        assert "bob.smith" not in r.text and r.n_chars == len(r.text)
    assert pii.train(empty) is None and pii.report(empty, None).count() == 0


# -- 2 --------------------------------------------------------------------------------------

def test_url_rules(sp):
    r = random.Random(12)
    rows, labels = [], []
    for i in range(2000):
        host = r.choice(["good.example.org", "calm.example.org", "fine.example.org", "shop.example.net", "evil.example.org",
                         "News.Example.com"])
        seg = r.choice(["a", "b", "spam"])
        rows.append((i, f"https://{host}/{seg}/{r.randrange(99)}?x=1"))
        bad = host == "evil.example.org" and seg == "spam"
        if i % 2:
            labels.append((i, int(not bad), 0))
    rows += [(None, None), (5, rows[5][1]), (-1, "no scheme"), (-2, "http://"), (-3, "://x.com/"), (-4, "ftp://A.COM?q#f"),
             (-5, "http://www.example.com/en/1"), (-6, "http://m.example.com/en/1"), (-7, "http://a.net/fr/"), (-8, "http://net/es/"),
             (-9, "http://evilcom/en/"), (-10, "http://example.com/en")]
    pages = sp.createDataFrame([(*x, "clash", "clash") for x in rows], "page_id long, url string, tokens string, host string")
    got = urlrules.judge(pages, sp.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    by = {x.page_id: x for x in got}
    want = {-1: ("", "", None, "allow"), -2: ("", "", None, "allow"), -3: ("x.com", "/", "com/", "allow"), -4: ("a.com", "", None, "allow"),
            -5: ("www.example.com", "/en/1", "www.example.com/en/", "allow"), -6: ("m.example.com", "/en/1", "example.com/en/", "block"),
            -7: ("a.net", "/fr/", "net/fr/", "block"), -8: ("net", "/es/", "net/es/", "block"), -9: ("evilcom", "/en/", None, "allow"),
            -10: ("example.com", "/en", "com/", "allow"), None: ("", "", None, "allow")}
    for k, v in want.items():
        assert (by[k].host, by[k].path, by[k].rule, by[k].verdict) == v
    for i, url in rows[:2000]:
        evil = "evil.example.org/spam" in url
        assert by[i].verdict == ("block" if evil else "allow"), (url, by[i])


def test_url_rules_of_any_size(sp):
    """A bad pattern that only four tokens together tell, among pages that have any three of them."""
    r = random.Random(6)
    four = ["h:one", "p:two", "p:three", "q:four"]
    rows, labels = [], []
    for i in range(900):
        have = four if i % 9 == 0 else [x for x in four if x != four[i % 4]]
        host = ("one" if "h:one" in have else "other") + ".example.org"
        path = "/".join(x[2:] for x in have if x.startswith("p:"))
        rows.append((i, f"http://{host}/{path}/{r.randrange(99)}" + ("?four=1" if "q:four" in have else "")))
        labels.append((i, int(i % 9 != 0), 0))
    got = urlrules.judge(sp.createDataFrame(rows, "page_id long, url string"), sp.createDataFrame(labels, "doc_id long, quality int, toxic int"),
                         fixed=()).collect()
    for x in got:
        assert x.verdict == ("block" if x.page_id % 9 == 0 else "allow")
        assert x.page_id % 9 or set(four) <= set(x.matched.split(" "))


def test_url_rules_of_a_long_template(sp):
    """Forty arguments that always come together are one item: mining ends at once, and one of them is enough to match."""
    import time
    args = "&".join(f"arg{i}=1" for i in range(40))
    rows = [(i, f"http://bad.example.org/list?{args}") for i in range(60)] + [(100 + i, f"http://good.example.org/page/{i}") for i in range(200)]
    rows += [(900, "http://new.example.org/x?arg7=5"), (901, "http://new.example.org/x?other=5")]
    labels = [(i, int(i >= 100), 0) for i, _ in rows if i < 900]
    start = time.time()
    got = {x.page_id: x for x in urlrules.judge(sp.createDataFrame(rows, "page_id long, url string"),
                                                sp.createDataFrame(labels, "doc_id long, quality int, toxic int"), fixed=()).collect()}
    assert time.time() - start < 30
    assert {i for i, x in got.items() if x.verdict == "block"} == {*range(60), 900}
    assert "q:arg7" in got[900].matched.split(" ") and len(got[0].matched.split(" ")) >= 41


def test_url_rules_awkward(sp):
    pages = sp.createDataFrame([(1, "http://a.b/c"), (None, None)], "page_id long, url string")
    none = sp.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = sp.createDataFrame([(1, None, None), (None, 0, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        assert [r.verdict for r in urlrules.judge(pages, labels).collect()] == ["allow", "allow"]
    assert urlrules.judge(pages.limit(0), odd).count() == 0


# -- registered queries ---------------------------------------------------------------------

def test_every_query_is_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.REGISTRY)
    assert numbers == list(range(1, 11))
