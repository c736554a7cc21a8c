"""The whole pipeline, as a caller of the registered query gets it, against a version in plain Python."""

import hashlib
import random
import re
import struct
import subprocess
import sys
from collections import Counter

import numpy as np
from xxhash import xxh64_intdigest

from frameloom.llm import language, mixing, near_dedup, packing, util

SOURCES = 4


def corpus():
    draw = random.Random(8)
    words = [f"word{i}" for i in range(400)]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randint(60, 200))) for _ in range(60)]
    near = [t + " extra" for t in texts[:6]] + [t.replace(t.split()[30], "other", 1) for t in texts[6:10]]
    far = [" ".join(t.split()[: len(t.split()) // 2]) for t in texts[10:14]]
    return [(i, t, "en", f"s{i % SOURCES}", len(t or "")) for i, t in enumerate([*texts, *texts[20:35], None, "", "123", *near, *far])]


def shingles(text):
    found = text.lower().split()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} if len(found) > 4 else {tuple(found)}


def near_kept(docs):
    group = {i: i for i in docs}
    sets = {i: shingles(t) for i, (t, _) in docs.items()}
    for a in docs:
        for b in docs:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {k: new if g == old else g for k, g in group.items()}
    return {i: docs[i] for i in docs if group[i] == i}


def targets(sizes):
    """Words by source: by weight, none over MOST times its size, the rest to the others."""
    weight = {s: mixing.WEIGHTS[k % len(mixing.WEIGHTS)] for k, s in enumerate(sorted(sizes))}
    rest, free, out = sum(sizes.values()) * mixing.SHARE, set(sizes), {}
    while free:
        level = rest / sum(weight[s] for s in free)
        full = {s for s in free if mixing.MOST * sizes[s] <= level * weight[s]}
        for s in full or free:
            out[s] = mixing.MOST * sizes[s] if full else level * weight[s]
            rest -= out[s] if full else 0
        free = free - full if full else set()
    return out


def mixed(docs):
    """(id, text) of each document and pass."""
    out, streams = [], {}
    for i, (text, source) in docs.items():
        key = hashlib.sha256("".join(f"{len(x)}:{x}" for x in (str(i), source, text)).encode()).hexdigest()
        h = xxh64_intdigest(struct.pack("<i", 11), xxh64_intdigest(key.encode(), 42))
        h = h - (1 << 64) if h >> 63 else h
        streams.setdefault(source, []).append((h % 16, h, i, text.split()))
    sizes = {s: sum(len(w) for *_, w in rows) for s, rows in streams.items()}
    for s, source in enumerate(sorted(streams)):
        stream = [(i, k) for _, _, i, words in sorted(streams[source]) for k in range(len(words))]
        length = max(1, min(mixing.BLOCK, len(stream) // mixing.BLOCKS))
        blocks = -(-len(stream) // length)
        taken = {}
        for slot in range(min(blocks * mixing.MOST, round(targets(sizes)[source] / length))):
            block = int(mixing.permuted(np.array([slot % blocks]), blocks, 11 * 1_000_003 + s)[0])
            for i, k in stream[block * length : (block + 1) * length]:
                taken.setdefault((slot // blocks, i), []).append(k)
        for (_, i), at in taken.items():
            words = docs[i][0].split()
            out.append((i, docs[i][0] if len(at) == len(words) else " ".join(words[k] for k in sorted(at))))
    return out


def test_registered_pipeline_against_plain_python(spark, tmp_path):
    import tokenizers

    import __spark_entry__

    rows, path = corpus(), str(tmp_path / "sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    got = __spark_entry__.queries()["pipeline"](spark, path).toPandas()

    told = {i: (t, s) for i, t, _, s, _ in rows if t and re.search("[a-z]", t)}  # one language, which any letter tells
    last = {t: i for i, (t, _) in sorted(told.items())}
    kept = near_kept({i: told[i] for i in sorted(last.values())})
    assert 60 < len(kept) < len(last) < len(told) < len(rows)
    encoder = tokenizers.Tokenizer.from_file(packing.tokenizer_file())
    want = Counter()
    for i, text in mixed(kept):
        ids = [*encoder.encode(text, add_special_tokens=False).ids, 1]
        want.update((i, len(ids), at, token) for at, token in enumerate(ids))
    found = Counter()
    for r in got.itertuples():
        found.update((r.doc_id, r.doc_tokens, r.start + k, token) for k, token in enumerate(np.frombuffer(r.ids, "<u4").tolist()))
        assert len(r.ids) == 4 * r.length
    assert found == want
    for _, pieces in got.sort_values("offset").groupby("sequence_id"):
        assert pieces["offset"].tolist() == [0, *pieces["length"].cumsum().tolist()[:-1]] and pieces["length"].sum() <= 2048


def test_workers_give_back_memory_when_a_task_is_through(monkeypatch):
    seen = []

    class Pool:
        def release_unused(self):
            seen.append("released")

    monkeypatch.setattr(util.pa, "default_memory_pool", Pool)
    assert list(util.tidy(lambda batches: (seen.append(b) or b for b in batches))(iter([1, 2]))) == [1, 2]
    assert seen == [1, 2, "released"]


def test_stages_of_python_give_back_memory(spark, monkeypatch):
    """Packing and language ID leave workers that stay with no more of Arrow's memory than they use."""
    wrapped = []
    for module in (packing, language):
        monkeypatch.setattr(module, "tidy", lambda run: wrapped.append(run.__name__) or util.tidy(run))
    docs = spark.createDataFrame([(k, f"word {k}", "en") for k in range(3000)], "doc_id long, text string, lang string").coalesce(1)
    few = packing.pack(docs, packing.tokenizer_file(), cached_words=7).select("doc_id", "ids")  # what is remembered changes no result
    assert sorted(few.collect()) == sorted(packing.pack(docs, packing.tokenizer_file()).select("doc_id", "ids").collect())
    assert packing.pack(docs, packing.tokenizer_file()).selectExpr("count(distinct doc_id)").first()[0] == 3000
    assert language.keep_identified(docs).count() == 3000
    assert {"packed", "_counts", "scored"} <= set(wrapped)


def test_workers_give_back_what_the_c_library_holds():
    code = """
import re
from frameloom.llm.util import tidy

def anon():
    return sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

kept = []

def run(batches):
    many = [bytes(5000) for _ in range(20_000)]
    kept.append(bytes(5000))  # above them: without help the C library gives nothing back
    yield from batches

list(tidy(run)(iter([])))
before = anon()
list(tidy(run)(iter([])))
del kept[:]
list(run([]))
print(before, anon())
"""
    before, held = map(float, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=util.__file__.rsplit("/", 3)[0]).stdout.split())
    assert held - before > 70  # what a run leaves unless it is tidied


def test_texts_go_to_python_a_thousand_at_a_time(spark, monkeypatch):
    import corpus_pipeline

    limit = util.TEXT_ROWS

    def watched(run):
        def small(batches):
            for batch in batches:
                assert len(batch) <= limit
                yield batch

        return util.tidy(lambda batches: run(small(batches)))

    for module in (packing, language):
        monkeypatch.setattr(module, "tidy", watched)
    docs = spark.createDataFrame([(k, f"word {k}", "en", "a") for k in range(3000)], "doc_id long, text string, lang string, source string").coalesce(1)
    assert corpus_pipeline.pack_sequences(spark, docs, "").select("doc_id").distinct().count() == 3000
    assert corpus_pipeline.identify_language(spark, docs, "").count() == 3000


def test_near_dedup_has_one_python_worker_in_a_task(spark, monkeypatch):
    """Edges are read from tables where they are contracted, so no worker stands before the one that contracts them."""
    plans, contract = [], near_dedup.connected_components
    monkeypatch.setattr(near_dedup, "connected_components", lambda edges: plans.append(edges._jdf.queryExecution().optimizedPlan().toString()) or contract(edges))
    docs = spark.createDataFrame([(i, t) for i, t, *_ in corpus()], "doc_id long, text string")
    assert near_dedup.near_dedup(docs).count() < docs.count()
    assert len(plans) == 3 and not [p for p in plans if "MapIn" in p]
