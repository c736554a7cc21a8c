"""Repeats, WARC, embeddings, shards, components, the pipeline: brute force, round trips and edge cases."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from frameloom.llm import components, embedding_dedup, repeats, sharding, warc
from frameloom.llm.run_length_index import RunLengthIndex


def brute_repeats(docs):
    seen, out = set(), {}
    for key, text in sorted(docs):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(raw[i : i + 100])
        kept = bytes(c for c, x in zip(raw, gone, strict=True) if not x)
        out[key] = (len(raw), sum(gone), sum(1 for i, x in enumerate(gone) if x and (not i or not gone[i - 1])), hashlib.sha256(kept).hexdigest())
    return out


def passages(seed):
    draw = random.Random(seed)
    base = "".join(draw.choice("abcdefgh ") for _ in range(3000))
    docs = []
    for i in range(50):
        parts = []
        for _ in range(draw.randint(0, 6)):
            k = draw.random()
            if k < 0.4:
                at = draw.randint(0, 2800)
                parts.append(base[at : at + draw.randint(50, 400)])
            elif k < 0.6:
                parts.append("ab" * draw.randint(1, 200))
            elif k < 0.7:
                parts.append("é" * draw.randint(1, 200))
            else:
                parts.append("".join(draw.choice("xyz ") for _ in range(draw.randint(1, 200))))
        docs.append((i, "".join(parts) if parts else None))
    return [*docs, (60, "q" * 600_000 + base), (61, "")]


@pytest.mark.parametrize("hot", [20_000, 3])
def test_repeats_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    docs = passages(hot)
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id long, text string, doc string, place string").repartition(4)
    got = {r["doc_id"]: r for r in repeats.remove_repeats(df).collect()}
    want = brute_repeats(docs)
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == want
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in got.values())


def test_repeats_hold_no_anchor():
    read = []

    def batches():
        for k in range(50):
            read.append(k)
            n = np.arange(100) + 100 * k
            yield repeats._rows(0, np.full(100, 7), n // 3, n, np.full(100, 5 << 7 | 1))  # one anchor, each content three times

    out = repeats._grouped(batches())
    rows = next(out).to_pylist() + next(out).to_pylist()
    assert rows and read == [0]
    rows += [r for b in out for r in b.to_pylist()]
    assert sorted(r["doc"] for r in rows if r["kind"] == 2) == list(range(0, 5000, 3))
    assert sorted(r["doc"] for r in rows if r["kind"] == 1) == [k for k in range(5000) if k % 3]


def test_repeats_edges(spark):
    text = "".join(random.Random(1).choices("abcdef", k=300))
    df = spark.createDataFrame([(None, text), (5, text), (5, text), (7, None), (8, text[:99])], "doc_id long, text string")
    got = [(r["doc_id"], r["n_removed"]) for r in repeats.remove_repeats(df).collect()]
    assert Counter(got) == Counter([(None, 300), (5, 0), (5, 300), (7, 0), (8, 0)])
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_repeats_tell_rows_of_one_id_apart(spark):
    """Two texts of a null id that share 24 bits of a CRC: the one that occurs once keeps its bytes."""
    draw, seen = random.Random(2), {}
    while True:
        text = "".join(draw.choices("abcdefgh", k=120))
        low = zlib.crc32(text.encode()) & 0xFFFFFF
        if low in seen:
            break
        seen[low] = text
    many = [(None, "".join(draw.choices("abcdefgh", k=130))) for _ in range(300)]
    df = spark.createDataFrame([(1, text), (None, text), (None, seen[low]), *many], "doc_id long, text string")
    got = Counter((r["doc_id"], r["kept"], r["n_removed"]) for r in repeats.remove_repeats(df).collect())
    assert got == Counter([(1, text.encode(), 0), (None, b"", 120), (None, seen[low].encode(), 0), *((None, t.encode(), 0) for _, t in many)])


def test_run_length_index():
    draw = random.Random(4)
    base = "".join(draw.choice("ab") for _ in range(60))
    texts = [("".join(draw.choice("abc") for _ in range(draw.randint(0, 20))) + base[draw.randint(0, 30) :]).encode() for _ in range(30)]
    index = RunLengthIndex(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts]))
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    for length in (1, 5, 20):
        classes, by_string = index.classes(length), {}
        for t, s in zip(texts, starts, strict=False):
            for i in range(len(t) - length + 1):
                by_string.setdefault(t[i : i + length], set()).add(int(classes[s + i]))
        assert all(len(c) == 1 for c in by_string.values())
        assert len({min(c) for c in by_string.values()}) == len(by_string)
    assert len(index.run) < sum(index.run)
    assert len(RunLengthIndex(np.empty(0, np.uint8), np.empty(0, np.int64)).classes(3)) == 0


def test_warc_round_trip(spark):
    big = "<p>" + "".join(random.Random(2).choices("abcdefgh\né", k=200_000))
    small, long = "x" * 50, "y" * 150
    pages = [(1, None), (2, ""), (3, big), (4, big), (5, small), (6, small), (7, long), (8, long), (9, long), (None, long), (11, "z" * 100 + "\r\n\r\nWARC/1.1\r\n")]
    df = spark.createDataFrame([(i, f"http://a/{i}\r\nX: y" if i == 3 else None, h, "q") for i, h in pages], "page_id long, url string, html string, digest string")
    got = warc.archive_pages(df.repartition(3)).collect()
    assert len(got) == len(pages)
    for r in got:
        body = (dict(pages)[r["page_id"]] or "").encode()
        assert r["payload_digest"] == hashlib.sha256(body).hexdigest()
        assert r["payload"] == body if r["record_type"] == "response" else r["payload"] == b""
    assert {r["page_id"]: r["refers_to"] for r in got if r["record_type"] == "revisit"} == {4: 3, 8: 7, 9: 7, None: 7}
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_warc_repeated_and_nameless_pages(spark):
    draw = random.Random(3)
    a, b, c = ("".join(draw.choices("abcdefgh\n", k=200_000)) for _ in range(3))
    pages = [(1, "http://a/", a), (1, "http://a/", a), (None, None, b), (None, None, c), (2, "http://b/", b + "x"), (2, "http://b/", c + "x"), (3, None, a)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for parts in (1, 3):
        got = Counter((r["page_id"], r["record_type"], r["refers_to"], bytes(r["payload"])) for r in warc.archive_pages(df.repartition(parts)).collect())
        assert got == Counter([*((i, "response", None, t.encode()) for i, _, t in pages[:-1]), (3, "revisit", 1, b"")])


def test_warc_other_records_and_rejects(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    rows = [
        warc.record("warcinfo", "<urn:1>", {}, b"software: x\r\n"), warc.record("request", "<urn:2>", {}, b"GET / HTTP/1.1\r\n\r\n"),
        warc.record("response", "<urn:3>", {"WARC-Page-ID": 3}, http + warc.chunked(b"sound")), warc.record("response", "<urn:4>", {"WARC-Page-ID": 4}, http + b"9\r\nshort\r\n"),
        warc.record("response", "<urn:5>", {"WARC-Page-ID": 5, "WARC-Segment-Number": 1}, http), warc.record("continuation", "<urn:6>", {"WARC-Segment-Origin-ID": "<urn:5>", "WARC-Segment-Number": 3, "WARC-Segment-Total-Length": 9}, b"x"),
        warc.record("resource", "<urn:7>", {"WARC-Segment-Number": 1}, b"x"), warc.record("continuation", "<urn:8>", {"WARC-Segment-Origin-ID": "<urn:7>", "WARC-Segment-Number": 2, "WARC-Segment-Total-Length": 2}, b"y"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(rows))
    (tmp_path / "b.warc.gz").write_bytes(warc.record("response", "<urn:9>", {"WARC-Page-ID": 9}, http + warc.chunked(b"too")) + rows[2][:-20])
    (tmp_path / "c.warc.gz").write_bytes(b"")
    assert sorted((r["page_id"], bytes(r["payload"])) for r in warc.read_archives(spark, f"file://{tmp_path}").collect()) in ([(3, b"sound")], [(3, b"sound"), (9, b"too")])
    bad = {r["page_id"]: r["error"] for r in warc.read_records(spark, f"file://{tmp_path}").where("error is not null").collect()}
    assert set(bad) == {4, 5, None} and "segment" in bad[5] and bad[None].startswith("archive")


def test_warc_segments_and_chunks():
    body = bytes(range(256)) * 300
    assert warc.dechunked(warc.chunked(body, 1000)) == body and warc.dechunked(warc.chunked(b"")) == b""
    assert warc.dechunked(b"4;ext=1\r\nabcd\r\n0\r\nTrailer: x\r\n\r\n") == b"abcd"
    for bad in (b"4\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"5\r\nabcde"):
        with pytest.raises(ValueError):
            warc.dechunked(bad)
    assert warc.assembled([(2, 5, b"de"), (1, None, b"abc"), (2, 5, b"de")]) == b"abcde"
    for bad in ([(1, None, b"a"), (3, 2, b"b")], [(1, None, b"a"), (2, 3, b"b")], [(2, 1, b"a")]):
        with pytest.raises(ValueError):
            warc.assembled(bad)
    parts = warc.page_records(9, "http://x/", body, hashlib.sha256(body).hexdigest(), None)
    assert len(parts) == 2 and [r[0] for p in parts for r in warc.parse_archive(p)] == ["response", "continuation"]


def test_embeddings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    draw = np.random.default_rng(0)
    base = draw.standard_normal((40, 24))
    vectors = [(i, int(k % 3), (base[k] + 0.05 * draw.standard_normal(24)).tolist()) for i, k in enumerate(draw.integers(0, 40, 400))]
    vectors += [(1000 + i, 0, vectors[0][2]) for i in range(50)] + [(1100, 0, (2 * np.array(vectors[0][2])).tolist())]
    odd = [(2000, 0, None), (2001, 0, [0.0] * 24), (2002, 0, [float("nan")] * 24), (2003, None, vectors[0][2]), (2004, 0, [None, *vectors[0][2][1:]]), (2005, 0, []), (2006, 0, [1.0]), (2007, 1, [1.0, 2.0])]
    df = spark.createDataFrame([(*v, "a", "b") for v in vectors + odd], "vec_id long, label int, embedding array<double>, node string, copies string")
    got = {r["vec_id"]: r for r in embedding_dedup.embedding_links(df).collect()}
    x = np.array([v for _, _, v in vectors])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([k for _, k, _ in vectors])
    linked = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    want = {v[0]: int(n) for v, n in zip(vectors, linked.sum(axis=1), strict=True)}
    assert all(got[i]["n_links"] <= n for i, n in want.items())
    assert sum(got[i]["n_links"] for i in want) >= 0.9 * sum(want.values())
    for i, _, _ in odd:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert {got[1000 + i]["component_id"] for i in range(50)} == {got[0]["component_id"]} == {got[1100]["component_id"]}
    assert embedding_dedup.embedding_links(df.limit(0)).count() == 0


@pytest.mark.parametrize("cosine", [0.93, 0.95])
@pytest.mark.parametrize("dims", [16, 64, 256])
def test_embedding_recall_of_planted_pairs(spark, dims, cosine):
    """At least nine of ten pairs are found that lie right at the threshold, or a little above it."""
    draw, n = np.random.default_rng(dims), 600
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x, off = unit(draw.standard_normal((n, dims))), draw.standard_normal((n, dims))
    off = unit(off - (off * x).sum(axis=1, keepdims=True) * x)
    near = cosine + 1e-6
    y = near * x + np.sqrt(1 - near**2) * off
    rows = [(k * n + i, 0, v.tolist()) for k, part in enumerate((x, y)) for i, v in enumerate(part)]
    got = {r["vec_id"]: r["component_id"] for r in embedding_dedup.embedding_links(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()}
    found = sum(got[i] == got[n + i] for i in range(n)) / n
    print(f"recall of pairs at {cosine} in {dims} dimensions: {found:.3f}")
    assert found >= 0.9


def test_embedding_blocks_settle_each_pair_once():
    """Blocks of one list and of two parts, some with an empty side, against all their pairs."""
    draw, rows = np.random.default_rng(3), []
    for block in range(400):
        a, b = sorted(draw.choice(20, 2, replace=False).tolist())
        other, split = [x for x in range(20) if x not in (a, b)], block % 3 == 0
        for _ in range(draw.integers(1, 7)):
            vector = (draw.standard_normal(4) + [3, 0, 0, 0]).tolist()
            rows.append((str(block), 4, a, b, 0, int(split), int(draw.integers(0, 2)) if split else 0, len(rows), [a, b, *draw.choice(other, 6, replace=False).tolist()], int(draw.integers(1, 3)), vector))
    df = pd.DataFrame(rows, columns=["label", "dims", "a", "b", "i", "j", "side", "node", "pivots", "copies", "embedding"])
    want, met = Counter(), set()
    for x in rows:
        for y in rows[: x[7]]:
            shared = sorted(set(x[8]) & set(y[8]))
            if x[:6] == y[:6] and (x[4] == x[5] or x[6] != y[6]) and len(shared) >= embedding_dedup.SHARED and shared[:2] == [x[2], x[3]]:
                met |= {x[7], y[7]}
                if np.dot(x[10], y[10]) >= 0.9 * np.linalg.norm(x[10]) * np.linalg.norm(y[10]):
                    want[x[7]] += y[9]
                    want[y[7]] += x[9]
    got = embedding_dedup._verified(0.9)(df)
    own = got[got["u"] == got["v"]]
    assert dict(zip(own["u"], own["links"], strict=True)) == dict(want) and len(want) > 50
    assert set(embedding_dedup._met(df)["node"]) == met


def test_embedding_repeated_and_null_ids(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, "a", v), (1, "a", v), (None, "a", v), (2, "b", v), (None, "b", [3.0, -1.0, 0.0]), (3, "x1", v)]
    got = Counter(tuple(r) for r in embedding_dedup.embedding_links(spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")).collect())
    assert got == Counter([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (2, 0, 2, True), (None, 0, None, True), (3, 0, 3, True)])


@pytest.mark.parametrize("name", ["op4_sharding", "op8_warc", "op9_exact_dedup"])
def test_queries_against_their_sql(spark, name):
    import duckdb

    from frameloom.llm import registry

    path = "/root/testdata/sf0.001"
    got = Counter(tuple(str(x) for x in r) for r in registry.queries()[name](spark, path).collect())
    db = duckdb.connect()
    for t in ("documents", "pages"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet'")
    columns = registry.queries()[name](spark, path).columns
    assert got == Counter(tuple(str(x) for x in r) for r in db.execute(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall())


@pytest.mark.parametrize("at_once", [500_000, 20])  # with 20, rounds of joins do it
def test_components(spark, monkeypatch, at_once):
    monkeypatch.setattr(components, "EDGES_AT_ONCE", at_once)
    draw = random.Random(8)
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(draw.randint(5000, 5400), draw.randint(5000, 5400)) for _ in range(150)] + [(7, 7), (-5, -3)]
    want = dict(components.forest(pairs))
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert {n: c for n, c in got.items() if n != c} == want
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, "t" * (i % 50) if i % 9 else None, "c") for i in range(500)], "doc_id long, text string, __arrival string")
    store = sharding.ShardStore(spark, f"file://{tmp_path}", df.schema, fan_in=3)
    for i in range(7):
        assert store.append(df.where(df.doc_id % 7 == i)) == 1
    assert (store.append(df.limit(0)), store.append(df.limit(0), F.lit(1))) == (0, 0) and store.version() == 7
    before, version = len(store.manifest()), store.version()
    assert store.compact() > 0 and len(store.manifest()) < before
    assert sorted(map(str, store.read().collect())) == sorted(map(str, df.collect())) == sorted(map(str, store.read(version).collect()))
    assert store.vacuum() > 0 and store.read().count() == 500
    assert max(Counter(r["tier"] for r in store.manifest()).values()) < 3


def test_shards_keep_clashing_columns_and_clean_up(spark, tmp_path):
    names = ["doc_id", "arrival", "ARRIVAL_0", "arrival_1", "__arrival"]
    long = "é" * 300_000
    rows = [(i % 40, "x", None, long if i == 7 else "", str(i)) for i in range(100)] + [(None, None, None, None, None)] * 2
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` {'long' if n == 'doc_id' else 'string'}" for n in names))
    store = sharding.ShardStore(spark, f"file://{tmp_path}", df.schema)
    assert store.append(df, F.pmod("doc_id", F.lit(6))) == 7  # a null arrival is one too
    assert store.compact() == 1 and len(store.manifest()) == 4  # fan_in runs at a time
    assert Counter(map(tuple, store.read().collect())) == Counter(rows)
    (tmp_path / "runs" / "lost").mkdir()
    assert store.vacuum(grace_seconds=3600) == 0 and store.read(1).count() == 102
    assert store.vacuum(orphans_after=0) == 5 and store.read().count() == 102 and store.vacuum() == 0
    assert not (tmp_path / "runs" / "lost").exists()


def test_shards_two_writers(spark, tmp_path):
    df = spark.range(10).withColumnRenamed("id", "doc_id")
    a = sharding.ShardStore(spark, f"file://{tmp_path}", df.schema)
    b = sharding.ShardStore(spark, f"file://{tmp_path}", df.schema)
    real, first = a.manifest, []

    def late(version=None):
        out = real(version)
        if not first:
            first.append(b.append(df))  # commits between a's reading and its commit
        return out

    a.manifest = late
    a.append(df)
    assert a.read().count() == 20 and a.version() == 2


def test_empty_store(spark, tmp_path):
    store = sharding.ShardStore(spark, f"file://{tmp_path}", spark.range(1).schema)
    assert store.read().count() == 0 and store.compact() == 0 and store.vacuum() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    draw = random.Random(3)
    words = [f"word{i}" for i in range(300)]
    texts = [" ".join(draw.choice(words) for _ in range(120)) for _ in range(60)]
    rows = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate([*texts, *texts[:20], None, "", "123", texts[3] + " extra"])]
    path = str(tmp_path / "sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        out.write.parquet(where := str(tmp_path / f"stage{len(counts)}"))
        docs = spark.read.parquet(where)
        counts.append(docs.count())
    assert counts[:3] == [84, 81, 61] and counts[3] in (60, 61)
    pieces = corpus_pipeline.run(spark, path)
    assert pieces.count() > 0 and pieces.agg({"offset": "max"}).first()[0] < 2048


def test_append_leaves_the_session_fit_for_training(spark, tmp_path):
    from frameloom.operators import clusters

    df = spark.createDataFrame([(i, [float(i % 3), 1.0], int(i % 3 == 0)) for i in range(60)], "i int, f array<double>, y int")
    store = sharding.ShardStore(spark, f"file://{tmp_path}/store", df.schema)
    assert store.append(df) == 1 and store.append(df.limit(0)) == 0 and store.append(df.limit(0), F.col("i")) == 0 and store.append(df, F.col("i") % 2) == 2
    assert store.read().count() == 120
    model, accuracy = clusters.train_keep_best(df, df, "f", "y", str(tmp_path / "model"), rounds=2)
    assert accuracy > 0.9 and not (tmp_path / "model-draft").exists()


def test_kept_rows_have_the_callers_columns(spark):
    from frameloom.llm import exact_dedup

    rows = [("mine1", 1, "same", True), ("mine2", 2, "same", False), (None, 3, None, None)]
    df = spark.createDataFrame(rows, "keep_id string, doc_id long, text string, kept boolean")
    out = exact_dedup.keep_one(df)
    assert out.columns == df.columns and sorted(map(tuple, out.collect()), key=str) == sorted(rows[1:], key=str)


def drawn(kind, n, dims, draw):
    x = draw.standard_normal((n, dims))
    if kind == "clusters":
        return 0.5 * x + 1.5 * draw.standard_normal((50, dims))[draw.integers(0, 50, n)]
    return x + 0.7 if kind == "offset" else x


def turned(v, cosine, draw):
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    g = draw.standard_normal(v.shape)
    g -= (g * u).sum(axis=1, keepdims=True) * u
    return cosine * u + np.sqrt(1 - cosine**2) * g / np.linalg.norm(g, axis=1, keepdims=True)


@pytest.mark.parametrize("kind", ["plain", "clusters", "offset"])
@pytest.mark.parametrize("dims", [16, 64, 256])
@pytest.mark.parametrize("count", [256, 1024, 2048, 8192])
def test_as_many_pivots_describe_a_vector_as_recall_asks_for(kind, dims, count):
    if count * dims > embedding_dedup.MOST_NUMBERS:
        pytest.skip("no table has so many pivots of so many dimensions")
    draw = np.random.default_rng(count + dims)
    every = drawn(kind, count + 1500, dims, draw)
    near, told = embedding_dedup.nearest_for(every[:count].tolist(), count, 0.93)
    points, v = embedding_dedup.pivots_of(every[:count].tolist(), dims, count), every[count:]
    orders = [np.argsort(-(embedding_dedup.unit(x) @ points.T), axis=1)[:, :near] for x in (v, turned(v, 0.93, draw))]
    found = ((orders[0][:, :, None] == orders[1][:, None, :]).any(axis=2).sum(axis=1) >= embedding_dedup.SHARED).mean()
    assert found >= 0.93 and (told >= embedding_dedup.LEAST_RECALL or near == max(embedding_dedup.NEAREST))


def test_embedding_recall_of_vectors_with_a_common_mean_and_many_pivots(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LEAST_PIVOTS", 1024)
    draw = np.random.default_rng(3)
    v = drawn("offset", 2500, 32, draw)
    w = turned(v[:300], 0.935, draw)
    rows = [(i, 1, x.tolist()) for i, x in enumerate([*v, *w])]
    got = {r["vec_id"]: r["component_id"] for r in embedding_dedup.embedding_links(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()}
    assert sum(got[2500 + i] == got[i] for i in range(300)) >= 285


def test_archives_are_read_record_by_record():
    import gzip

    members = [warc.page_records(i, f"u{i}", bytes([65 + i]) * (10 + 200_000 * (i == 1)), "d", None, None, str(i)) for i in range(4)]
    whole = b"".join(x for m in members for x in m)
    rows = list(warc.parse_archive(whole))
    assert rows == list(warc.parse_archive(gzip.decompress(whole))) and len(rows) == sum(map(len, members)) and all(r[-1] is None for r in rows)
    cut = list(warc.parse_archive(whole[: len(whole) - 30]))
    assert cut[:-1] == rows[:-1] and cut[-1][-1].startswith("archive: ")  # what comes before the fault is read
    assert [r[-1] is None for r in warc.parse_archive(gzip.decompress(members[0][0]) + b"WARC/1.1\r\nContent-Length: 5")] == [True, False]
    assert list(warc.parse_archive(b"")) == [] and list(warc.parse_archive(b"nothing\r\n"))[0][-1].startswith("archive: ")
