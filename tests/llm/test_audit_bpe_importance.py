"""Filter audit, BPE, importance resampling: brute force, the vocabulary's own library, edge cases."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from frameloom.llm import bpe, filter_audit, importance

DATA = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, source string, {} string"


def texts(seed, n):
    draw = random.Random(seed)
    words = ["the", "The", "river", "RIVER", "é", "it's", "12", "$9", "a|b", "日本", "\x1c", "\x85", "x\x00y"]
    some = ["", None, " \t\n", "word " * 60, "Z" * 400, "$"]
    return [draw.choice(some) if draw.random() < 0.3 else draw.choice([" ", "\n", " \v"]).join(draw.choice(words) for _ in range(draw.randint(0, 120))) for _ in range(n)]


# --- filter audit


def brute_flags(rows):
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    for i, text, part in rows:
        body = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", body)
        low = first.get(body)
        yield i, part or "", [
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", body)) > 5 * len(body), bool(re.search(r"[#$%&*|]", body)),
            low is not None and (i is None or i > low),
        ]


def brute_audit(rows, labels):
    counts, taken = Counter(), Counter()
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    for i, part, fails in brute_flags(rows):
        for order in permutations("ABCDE"):
            at = ["ABCDE".index(c) for c in order]
            gone = next((k for k, f in enumerate(at) if fails[f]), 9)
            for k, f in enumerate(at):
                cell = (part, "".join(order), k + 1)
                counts[cell, "kept"] += gone > k
                counts[cell, "removed"] += gone == k
                counts[cell, "redundant"] += fails[f] and gone < k
                counts[cell, "unique"] += fails[f] and sum(fails) == 1
                counts[cell, "good"] += gone == k and i in good
                counts[cell, "toxic"] += gone == k and i in toxic
                taken[part, order[k]] += gone == k
    cells = {c for c, _ in counts}
    return {(*c, *(counts[c, x] for x in ("kept", "removed", "redundant", "unique", "good", "toxic")), taken[c[0], c[1][c[2] - 1]]) for c in cells}


def test_audit_against_brute_force(spark):
    draw = random.Random(4)
    rows = [(draw.choice([None, *range(40)]), t, draw.choice([None, "", "a", "b", "hot", "hot"])) for t in texts(1, 160)]
    rows += rows[:3] + [(99, "one $ text", "hot")] * 3 + [(None, "one $ text", "b")]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in [None, *range(0, 40, 2), 4, 4]]
    df = spark.createDataFrame([(*r, "x") for r in rows], ODD.format("digest")).repartition(5)
    own = spark.createDataFrame([(*x, "y") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.audit(df, own).collect()
    assert {tuple(r) for r in got} == brute_audit(rows, labels)
    assert len(got) == 4 * 600


def test_audit_of_nothing_and_of_other_filters(spark):
    empty, labels = spark.createDataFrame([], ODD.format("first")), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, labels).collect() == []
    flags = spark.createDataFrame([("p", 0b01, True, False), ("p", 0b11, False, True), ("p", 0, False, False)], "part string, fails int, good boolean, toxic boolean")
    got = {tuple(r) for r in filter_audit.replay(flags, "XY").collect()}
    assert got == {("p", "XY", 1, 1, 2, 0, 1, 1, 1, 3), ("p", "XY", 2, 1, 0, 1, 0, 0, 0, 1), ("p", "YX", 1, 2, 1, 0, 0, 0, 1, 1), ("p", "YX", 2, 1, 1, 1, 1, 1, 0, 3)}
    for bad in ("", "XX", "ABCDEFG"):
        with pytest.raises(ValueError):
            filter_audit.replay(flags, bad)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
def test_audit_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.sql(filter_audit.OP11_SQL)
    got = filter_audit.op11_filter_audit(spark, DATA)
    assert sorted(got.columns) == sorted(want.columns)
    assert {tuple(r) for r in got.select(*want.columns).collect()} == set(want.fetchall())


# --- byte-level BPE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_file())


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.vocabulary_file())


def ids_of(library, these):
    return [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(these, add_special_tokens=False)]


def test_bpe_cuts_every_character_as_the_library_does(library, vocabulary):
    encode = bpe.encoder(vocabulary)
    characters = [chr(c) for c in (*range(0x3400), *range(0xA000, 0xD800, 7), *range(0xE000, 0x20000), *range(0x20000, 0x110000, 997))]
    these = [f"a{c}b {c}{c} 1{c}2 !{c}?  {c} x" for c in characters]
    assert encode(these) == ids_of(library, these)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abst'éllld1 ٣日\n\t <|endoftext|>#́"), max_size=200), max_size=8))
def test_bpe_equals_the_library(library, vocabulary, these):
    encode = bpe.encoder(vocabulary)
    assert encode(these) == encode(these) == ids_of(library, these)


@pytest.mark.parametrize("limit", [7, 1000])
def test_bpe_bounds_change_nothing(library, vocabulary, monkeypatch, limit):
    for name in ("BLOCK_PIECES", "INDEX_BYTES", "KNOWN_PIECES", "KNOWN_LENGTH"):
        monkeypatch.setattr(bpe, name, limit)
    these = [t or "" for t in texts(3, 120)] + ["a" * 30_000, "ab" * 9_000, " " * 5_000, "x <|endoftext|>" * 40, "q<|endoftext|><|endoftext|>"]
    assert bpe.encoder(vocabulary)(these) == ids_of(library, these)


def test_bpe_query_encodes_and_decodes(spark, library):
    rows = list(enumerate(texts(5, 200))) + [(7, "same id"), (7, "same id"), (None, "no id"), (300, "<|endoftext|> and é"), (301, "long " * 100_000)]
    df = spark.createDataFrame([(i, t, "s", "y") for i, t in rows], ODD.format("ids")).repartition(3)
    got = bpe.decode_ids(bpe.encode_texts(df, bpe.vocabulary_file()), bpe.vocabulary_file(), text_col="decoded").collect()
    want = [(i, len(b) // 4, b, library.decode(np.frombuffer(b, "<u4").tolist(), skip_special_tokens=False)) for (i, t), b in zip(rows, ids_of(library, [t or "" for _, t in rows]), strict=True)]
    assert sorted(((r[0], r[1], bytes(r[2]), r[3]) for r in got), key=str) == sorted(want, key=str)
    assert sorted((r["decoded"] for r in got)) == sorted(t or "" for _, t in rows)
    assert bpe.encode_texts(spark.createDataFrame([], ODD.format("n_tokens")), bpe.vocabulary_file()).collect() == []


def test_bpe_decodes_what_is_not_utf8(spark, library):
    cut = [np.array(x, "<u4").tobytes() for x in ([161, 220], [220, 161, 247, 162], [])]
    df = spark.createDataFrame([(bytearray(c), "x") for c in cut] + [(None, "x")], "ids binary, text string")
    got = [r["text"] for r in bpe.decode_ids(df, bpe.vocabulary_file()).collect()]
    assert got == [library.decode(np.frombuffer(c, "<u4").tolist(), skip_special_tokens=False) for c in cut] + [None]


def test_bpe_refuses_other_vocabularies(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError, match="not a plain byte-level"):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


# --- importance resampling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest=2, buckets=10_000):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), Counter(zlib.crc32(" ".join(words[i : i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(words) - k + 1))


def brute_resample(rows, target, longest=2, buckets=10_000, least=20, percent=25):
    own, s, t = [features(x, longest, buckets) for _, x in rows], Counter(), Counter()
    for _, c in own:
        s.update(c)
    for x in target:
        t.update(features(x, longest, buckets)[1])
    size_s, size_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (size_s + buckets) / ((s[b] + 1) * (size_t + buckets)))) for b in range(buckets)]
    out = []
    for (i, _), (n, c) in zip(rows, own, strict=True):
        k = sum(c.values())
        weight = sum(gain[b] * m for b, m in c.items()) // k if k else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, k, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least])
    able = sorted((o for o in out if o[4]), key=lambda o: (-o[3], o[0] is None, o[0]))
    for rank, o in enumerate(able[: percent * len(able) // 100], 1):
        o[4] = rank
    return [tuple([*o[:4], None if isinstance(o[4], bool) else o[4]]) for o in out]


@pytest.mark.parametrize(("longest", "buckets", "percent"), [(2, 10_000, 25), (3, 50, 80), (1, 7, 100)])
def test_resampling_against_brute_force(spark, longest, buckets, percent):
    rows = list(enumerate(texts(8, 250))) + [(900, "river " * 50_000), (7, "the river " * 40), (7, "the river " * 40), (None, "RIVER " * 30), (None, None)]
    target = ["the river 12", None, "", "É é Ünï " * 9]
    df = spark.createDataFrame([(i, t, "s", "y") for i, t in rows], ODD.format("bucket")).repartition(5)
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, n int")
    got = [tuple(r) for r in importance.resample(df, aim, longest=longest, buckets=buckets, percent=percent).collect()]
    assert sorted(got, key=str) == sorted(brute_resample(rows, target, longest, buckets, percent=percent), key=str)


def test_resampling_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(importance, "BLOCK_CHARS", 200)
    rows = list(enumerate(texts(9, 60)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r["id"]: (r["n_words"], dict(zip(r["buckets"], r["times"], strict=True))) for r in importance.bucket_counts(df).collect()}
    assert got == {i: (n, dict(c)) for i, (n, c) in ((i, features(t)) for i, t in rows)}


def test_resampling_of_nothing(spark):
    empty, aim = spark.createDataFrame([], ODD.format("place")), spark.createDataFrame([], "text string")
    assert importance.resample(empty, aim).collect() == []
    one = importance.resample(spark.createDataFrame([(1, "a b", "s", "y")], ODD.format("range")), aim).collect()
    assert [tuple(r)[:2] + (r["rank"],) for r in one] == [(1, 3, None)]


def test_resampling_draws_what_looks_like_the_target(spark):
    draw = random.Random(2)
    say = lambda words: " ".join(draw.choice(words) for _ in range(60))
    near, far = ["moon", "orbit", "crater", "comet"], ["butter", "flour", "oven", "sugar"]
    rows = [(i, say(near if i % 4 == 0 else far)) for i in range(400)]
    got = importance.resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(say(near),)], "text string")).where("rank is not null").collect()
    assert len(got) == 100 and sum(r["doc_id"] % 4 == 0 for r in got) >= 75  # three times their share: the draw is random, near ones weigh about 20 times as much
    assert sorted(r["rank"] for r in got) == list(range(1, 101))
