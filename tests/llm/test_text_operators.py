"""Language, SimHash, mixing, toxicity, exact dedup, packing: edge cases and brute force on small tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from frameloom.llm import exact_dedup, language, mixing, near_dedup, packing, simhash, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named as the operators name their own.
CLASH = "doc_id long, text string, lang string, source string, kept string, keep_id string, fingerprint string, score string, size string, id string, content string"


def documents(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)


def clashing(spark, rows):
    return spark.createDataFrame([(*r, *(["x"] * 7)) for r in rows], CLASH)


EDGES = [(1, None, None, None), (2, "", "en", "a"), (3, "   \n\t", "en", None), (None, "one two three", "en", "b"), (5, "one two three", "de", "b"), (5, "one two three", "de", "b"), (7, "word " * 30_000, "en", "c"), (8, "1 2 3 !?", "fr", "a")]


def test_exact_dedup_edges(spark):
    for df in (documents(spark, EDGES), clashing(spark, EDGES)):
        got = exact_dedup.exact_dedup(df)
        rows = got.select("doc_id", "text", "keep_id", "group_size", "kept").collect()
        assert len(rows) == len(EDGES)
        by_text = defaultdict(list)
        for r in rows:
            by_text[r["text"] or ""].append(r)
        for group in by_text.values():
            assert {r["group_size"] for r in group} == {len(group)}
            assert sum(r["kept"] for r in group) == 1
            best = max((r["doc_id"] for r in group if r["doc_id"] is not None), default=None)
            assert {r["keep_id"] for r in group} == {best}
            assert next(r for r in group if r["kept"])["doc_id"] == best
        assert {r["text"] for r in rows} == {t for _, t, _, _ in EDGES}
        assert set(df.columns) <= set(got.columns)


def test_exact_dedup_hot_text_and_smallest(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 5)
    rows = [(i, "hot" if i % 3 else f"t{i % 50}", None, None) for i in range(600)]
    for keep, pick in (("largest", max), ("smallest", min)):
        got = exact_dedup.exact_dedup(documents(spark, rows), keep=keep).collect()
        groups = defaultdict(list)
        for i, t, _, _ in rows:
            groups[t].append(i)
        for r in got:
            assert (r["keep_id"], r["group_size"], r["kept"]) == (pick(groups[r["text"]]), len(groups[r["text"]]), r["doc_id"] == pick(groups[r["text"]]))


@pytest.mark.parametrize("call", [exact_dedup.exact_dedup, simhash.simhash_components, near_dedup.near_dedup, mixing.mix, mixing.mixed_documents, language.keep_identified, lambda d: packing.pack(d, packing.tokenizer_file())])
def test_empty_tables(spark, call):
    assert call(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_print(text, words):
    found = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(prints, radius):
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("block", [7, 1])  # with blocks of 1, buckets of over 15 are covered again
def test_simhash_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(1, None), (2, ""), (3, "É Ab"), (4, "é aB"), (5, "a\x1cb c\x85d"), (6, "X " * 20_000)]
    for k in range(8):
        base = [draw.choice(vocabulary) for _ in range(300)]
        for _ in range(15 if k else 90):
            own = list(base)
            own[draw.randrange(300)] = "Changed"
            rows.append((100 + len(rows), " ".join(own)))
    got = {r["doc_id"]: r for r in simhash.simhash_components(documents(spark, [(i, t, None, None) for i, t in rows])).collect()}
    prints = {i: brute_print(t, 3) for i, t in rows}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == prints
    assert {i: r["component_id"] for i, r in got.items()} == brute_components(prints, 3)
    assert len({r["component_id"] for r in got.values()}) < len(rows) // 2


def test_covering_masks_cover():
    for radius in (1, 3, 5):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        draw = random.Random(1)
        for _ in range(500):
            bits = sum(1 << b for b in draw.sample(range(64), radius))
            assert any(not m & bits for m in masks)


def test_stars_connect_as_all_pairs_do():
    draw = np.random.default_rng(2)
    base = draw.integers(0, 1 << 62, 3)
    x = np.unique(np.concatenate([b ^ (1 << draw.integers(0, 62, 60)) for b in base]))
    u, v = simhash.stars(simhash.near(x[:, None, None], x[None, :, None], 3), x, x)
    prints = {int(p): int(p) for p in x}
    want = brute_components(prints, 3)
    parent = dict(want)
    assert all(want[int(a)] == want[int(b)] for a, b in zip(u, v, strict=True))
    seen = {int(p): int(p) for p in x}

    def root(p):
        while seen[p] != p:
            p = seen[p]
        return p

    for a, b in zip(u.tolist(), v.tolist(), strict=True):
        a, b = root(a), root(b)
        seen[max(a, b)] = min(a, b)
    assert {p: root(p) for p in parent} == want and len(u) <= 4 * len(x) * 2


def test_near_dedup_finds_light_edits(spark):
    draw = random.Random(11)
    words = [f"w{i}" for i in range(2000)]
    rows = []
    for k in range(60):
        base = [draw.choice(words) for _ in range(200)]
        for edit in range(3):
            own = list(base)
            for at in draw.sample(range(200), edit):
                own[at] = "edited"
            rows.append((3 * k + edit, " ".join(own), None, None))
    kept = {r["doc_id"] for r in near_dedup.near_dedup(documents(spark, rows)).collect()}
    assert {3 * k for k in range(60)} <= kept and len(kept) <= 66


def test_near_dedup_links_as_exact_similarity_does(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 20)  # some components are compared in several blocks
    draw = random.Random(5)
    words, common = [f"w{i}" for i in range(3000)], " ".join(f"c{i}" for i in range(12))
    texts = []
    for k in range(150):
        base = [draw.choice(words) for _ in range(draw.choice([8, 40, 300]))]
        texts.append(" ".join(base) + (" " + common if k % 3 == 0 else ""))
        for _ in range(30 if k == 0 else 2):  # similarities from about 0.7 to 0.9
            own = list(base)
            for at in draw.sample(range(len(own)), max(1, len(own) * draw.choice([1, 2, 3]) // 80)):
                own[at] = draw.choice(words)
            texts.append(" ".join(own) + (" " + common if k % 3 == 0 else ""))
    sets = [frozenset(zip(*(t.split()[i:] for i in range(5)), strict=False)) for t in texts]
    group, near, bands = list(range(len(texts))), 0, Counter()
    for b in range(len(texts)):
        for a in range(b):
            both = len(sets[a] & sets[b])
            bands[int(100 * both / (len(sets[a]) + len(sets[b]) - both)) // 5] += both > 0
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                near += 1
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    assert bands[15] > 20 and bands[16] > 20 and near > 60
    rows = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    got = {r["id"]: r["component_id"] for r in near_dedup.similar_components(rows).collect()}
    assert got == dict(enumerate(group))
    assert {r["doc_id"] for r in near_dedup.near_dedup(rows).collect()} == set(group)


@pytest.mark.parametrize("similarity", [0.8, 0.85, 0.9, 0.95])
def test_near_dedup_finds_planted_copies(spark, similarity):
    """All of the copies planted at a similarity are found, and no text without a copy is dropped."""
    draw, words = random.Random(21), [f"w{i}" for i in range(5000)]
    rows, want = [], set()
    for k in range(60):
        base = [draw.choice(words) for _ in range(400)]
        own, at, sets = list(base), draw.sample(range(400), 400), []
        for i in at:  # as many edits as leave the similarity
            trial = [*own[:i], "edit", *own[i + 1 :]]
            a, b = (set(zip(*(x[j:] for j in range(5)), strict=False)) for x in (base, trial))
            if len(a & b) < similarity * len(a | b):
                break
            own = trial
        rows += [(2 * k, " ".join(base), None, None), (2 * k + 1, " ".join(own), None, None)]
        want.add(2 * k)
        rows.append((1000 + k, " ".join(draw.choice(words) for _ in range(400)), None, None))
    kept = {r["doc_id"] for r in near_dedup.near_dedup(documents(spark, rows)).collect()}
    assert kept == want | {1000 + k for k in range(60)}


def test_near_dedup_keeps_columns_and_edges(spark):
    df = clashing(spark, EDGES)
    got = near_dedup.near_dedup(df)
    assert got.columns == df.columns
    kept = Counter(r["doc_id"] for r in got.collect())
    assert kept[1] == 1 and kept[2] == 0 and kept[3] == 0 and kept[None] == 1 and kept[5] == 2 and kept[7] == 1


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    cap, free, total = {s: 2.0 * sizes[s] for s in names}, set(names), 1.5 * sum(sizes.values())
    while free:
        left, by = total - sum(cap[s] for s in names if s not in free), sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / by > cap[s]}
        if not over:
            break
        free -= over
    return {s: left * weight[s] / by if s in free else cap[s] for s in names}


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 8)
    draw = random.Random(9)
    rows = list(EDGES) + [(100 + i, " ".join(["w"] * draw.randint(1, 90)), None, draw.choice(["a", "b", "é", "z", None, ""])) for i in range(150)]
    df = documents(spark, rows)
    got = mixing.mix(df, block=4).collect()
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, size(t)) for i, t, _, _ in rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += size(t)
    want, taken, source_of = brute_targets(sizes), Counter(), {i: s for i, _, _, s in rows}
    for r in got:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 8 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(3), block=4).collect()))
    mixed = mixing.mixed_documents(df, block=4)
    assert mixed.columns == df.columns
    rows_out, by_doc = mixed.collect(), Counter()
    for r in rows_out:
        by_doc[r["doc_id"]] += size(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert by_doc == Counter({k: v for k, v in _sum((r["doc_id"], r["taken"]) for r in got).items() if v})


def test_mixed_documents_with_clashing_columns(spark):
    names = ["key", "passes", "s", "block", "whole", "parts", "size", "content", "__key", "__pass", "id", "source", "text", "doc_id"]
    rows = [(*[f"{n}{i}" for n in names[:11]], "ab"[i % 2] if i % 5 else None, " ".join(f"w{k}" for k in range(i % 30)) or None, i // 2) for i in range(200)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` {'long' if n == 'doc_id' else 'string'}" for n in names))
    out = mixing.mixed_documents(df)
    assert out.columns == names
    got, known = out.collect(), {(r[0], r[-1]): r for r in rows}
    assert len(got) > 200
    for r in got:
        own = known[r["key"], r["doc_id"]]
        assert tuple(r)[:12] == own[:12] and set(r["text"].split()) <= set(own[12].split())


def test_mixing_against_plain_streams(spark, monkeypatch):
    """taken of every document, by a mix that lays each source's words out as a list."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 30)
    draw = random.Random(4)
    rows = [(i, " ".join(["w"] * draw.choice([0, 1, 5, 40, 700])), None, draw.choice("aaaaab") if i else "tiny") for i in range(300)]
    rows[0] = (0, "one two three", None, "tiny")
    got = {r["doc_id"]: r for r in mixing.mix(documents(spark, rows)).collect()}
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(t.split())
    df = documents(spark, rows)
    keys = {r["doc_id"]: r["h"] for r in df.select("doc_id", F.xxhash64(mixing.row_key(df, "doc_id", "text", "source"), F.lit(11)).alias("h")).collect()}
    buckets = max(16, -(-len(rows) // 30))
    for s, source in enumerate(sorted(sizes)):
        stream = [i for _, _, i, n in sorted((keys[i] % buckets, keys[i], i, len(t.split())) for i, t, _, x in rows if x == source) for _ in range(n)]
        length = max(1, min(mixing.BLOCK, sizes[source] // mixing.BLOCKS))
        blocks, taken = -(-len(stream) // length), Counter()
        slots = min(blocks * mixing.MOST, round(brute_targets(sizes)[source] / length))
        for slot in range(slots):
            k = int(mixing.permuted(np.array([slot % blocks]), blocks, 11 * 1_000_003 + s)[0])
            taken.update(stream[k * length : (k + 1) * length])
        for i, _, _, x in rows:
            assert x != source or got[i]["taken"] == taken[i]
        assert abs(sum(taken.values()) - brute_targets(sizes)[source]) <= 2 * length
    assert got[0]["taken"] == 6  # a source of three words comes to its target, twice its size


def _sum(pairs):
    out = Counter()
    for k, v in pairs:
        out[k] += v
    return out


def test_permutation():
    for n in (1, 2, 3, 7, 64, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 5).tolist()) == list(range(n))
    assert mixing.permuted(np.arange(1000), 1000, 5).tolist() != mixing.permuted(np.arange(1000), 1000, 6).tolist()


WORDS = {"aa": ["house", "garden", "river", "stone"], "bb": ["maison", "jardin", "fleuve", "pierre"], "cc": ["zxqwk", "zqxxo", "zzzok", "zkqwo"]}


def test_language(spark):
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choice(WORDS[lang]) for _ in range(20)), lang, None) for i in range(300) for lang in [draw.choice(list(WORDS))]]
    more = [(1000, None, "aa", None), (1001, "", None, None), (1002, "12 !? 3", None, None), (1003, "gardens houses rivers", None, None), (1004, "zqzqzq zkzk", None, None), (1005, "maison " * 200_000, None, None), (None, "house", None, None)]
    df = documents(spark, rows + more)
    model = language.fit(df, learn=~language.held_out(df["doc_id"]))
    got = {r["doc_id"]: r for r in language.identify(clashing(spark, [r[:4] for r in rows + more]), model).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang, _ in rows)
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, 1004, 1005, None)] == ["und", "und", "und", "aa", "cc", "bb", "aa"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[1000]["score"] == 0
    assert all(r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    kept = {r["doc_id"] for r in language.keep_identified(df).collect()}
    assert kept == set(got) - {1000, 1001, 1002}


def test_language_without_labels(spark):
    df = documents(spark, [(1, "some words", None, None)])
    got = language.identify(df, language.fit(df)).collect()[0]
    assert (got["lang_pred"], got["score"]) == ("und", 0.0)


def test_backoff_goes_to_shorter_grams():
    model = language.Model(["aa", "bb"], {"house": [5, 0], "maison": [0, 5]}, [5, 5])
    predict = model.predictor()
    assert predict("houses")[0] == "aa" and predict("maisonette")[0] == "bb"
    assert predict("xmxa")[0] == "bb" and abs(predict("qqq")[1] - 0.5) < 0.1
    assert predict("maison qqq")[1] < predict("maison maison")[1]


def brute_language(train, text):
    """Backoff by its definition: log frequencies less their mean; an unknown word has the mean over its known n-grams of the greatest length with any."""
    languages = sorted({lang for lang, _ in train})
    find = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    words = {k: Counter(w for lang, t in train if lang == k for w in find(t)) for k in languages}
    known = sorted(set().union(*words.values()))

    def logs(counts, totals, size):
        row = [np.log((c + 0.5) / (n + 0.5 * size + 1)) for c, n in zip(counts, totals, strict=True)]
        return np.array(row) - np.mean(row)

    grams = lambda w, n: [f"<{w}>"[i : i + n] for i in range(len(w) + 3 - n)]
    table = {n: {k: Counter(g for w, c in words[k].items() for g in grams(w, n) for _ in range(c)) for k in languages} for n in (1, 2, 3, 4)}
    total = np.zeros(len(languages))
    for w in find(text):
        if w in known:
            total += logs([words[k][w] for k in languages], [sum(words[k].values()) for k in languages], len(known))
            continue
        for n in (4, 3, 2, 1):
            every = set().union(*table[n].values())
            if hit := [g for g in grams(w, n) if g in every]:
                total += np.mean([logs([table[n][k][g] for k in languages], [sum(table[n][k].values()) for k in languages], len(every)) for g in hit], axis=0)
                break
    return languages[int(np.argmax(total))], 1 / np.exp(total - total.max()).sum()


def test_language_against_brute_force(spark):
    draw = random.Random(12)
    train = [(lang, " ".join(draw.choice(WORDS[lang]) + draw.choice(["", "s", "x"]) for _ in range(draw.randint(1, 9)))) for lang in draw.choices(list(WORDS), k=60)]
    asked = ["gardens", "maisonette fleuves", "zq", "ga ri st", "house maison zxqwk", "x", "Stone! stones, pierre", "é", *(" ".join(draw.choice([w for x in WORDS.values() for w in x])[: draw.randint(1, 6)] for _ in range(4)) for _ in range(60))]
    df = documents(spark, [(i, t, lang, None) for i, (lang, t) in enumerate(train)])
    rows = [(1000 + i, t, None, None) for i, t in enumerate(asked)]
    got = language.identify(documents(spark, rows + rows), language.fit(df)).collect()
    assert len(got) == 2 * len(rows)
    for r in got:
        want = brute_language(train, asked[r["doc_id"] - 1000])
        assert r["lang_pred"] == want[0] and abs(r["score"] - want[1]) < 1e-3


def test_language_ties_go_to_the_first():
    model = language.Model(["aa", "bb"], {"same": [3, 3]}, [3, 3])
    assert model.predictor()("same")[0] == "aa" and abs(model.predictor()("same")[1] - 0.5) < 1e-6


def test_toxicity_counterfactual():
    draw = random.Random(7)
    plain = [f"w{i}" for i in range(200)]
    cache, rows, labels, pairs = {}, [], [], []
    for i in range(600):
        words = set(draw.sample(plain, 12))
        y = int(i % 3 == 0)
        words |= {"idiot"} if y and draw.random() < 0.9 else set()
        if draw.random() < (0.8 if y else 0.05):
            words |= {"muslim"}  # in this sample the group is mostly mentioned in abuse
        rows.append(toxicity.features_of(words, cache))
        labels.append(y)
        own = toxicity.features_of(words, cache)
        pairs += [(np.setdiff1d(own, new), np.setdiff1d(new, own), 1) for o in toxicity.swapped(words) for new in [toxicity.features_of(o, cache)]]
    with_swaps, without = toxicity.train(rows, np.array(labels), pairs), toxicity.train(rows, np.array(labels), [])
    gap = lambda m: abs(m.score(toxicity.features_of({"w1", "muslim"}, {})) - m.score(toxicity.features_of({"w1", "hindu"}, {})))
    assert gap(with_swaps) < 0.5 * gap(without)
    assert with_swaps.score(toxicity.features_of({"w1", "w2", "idiot"}, {})) > 0.7 > with_swaps.score(toxicity.features_of({"w1", "w2"}, {}))


def test_toxicity_minimises_its_loss(monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_Z", 0)
    draw = np.random.default_rng(3)
    labels = np.array([0, 1] * 40)
    rows = [np.unique(np.r_[draw.integers(0, 12, 4), [20] if y and draw.random() < 0.8 else [21]]).astype(np.int32) for y in labels]
    pairs = [(np.array([0], np.int32), np.array([1], np.int32), 3), (np.array([20, 2], np.int32), np.array([3], np.int32), 1)]
    for swaps in ([], pairs):
        model = toxicity.train(rows, labels, swaps)
        at = np.append(model.weights, model.bias)
        for k in (*range(25), -1):  # the slope at the end, by differences, beside that at the start
            slopes = []
            for where in (at, np.zeros(len(at))):
                step = np.zeros(len(at))
                step[k] = 1e-4
                slopes.append((toxicity.loss(where + step, rows, labels, swaps) - toxicity.loss(where - step, rows, labels, swaps)) / 2e-4)
            assert abs(slopes[0]) < 1e-3 + 0.02 * abs(slopes[1])
    free, bound = toxicity.train(rows, labels, []).weights, toxicity.train(rows, labels, pairs).weights
    assert abs(bound[0] - bound[1]) < abs(free[0] - free[1]) + 1e-9


def test_toxicity_repeated_rows_ties_and_sentences(spark):
    rows = [(i % 200, f"w{i % 7} the muslim man said. " + ("idiot" if i % 2 else "thanks"), i % 2) for i in range(400)]  # each row twice
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(labelled)
    other = toxicity.fit(labelled.repartition(7))
    assert np.array_equal(model.weights, other.weights) and model.bias == other.bias
    found = toxicity.score_toxicity(labelled.limit(0).union(labelled.where("doc_id = 3")), model).collect()
    assert len(found) == 2 and found[0] == found[1]
    score = found[0]["score"]
    tied = toxicity.score_toxicity(labelled.where("doc_id = 3"), model, least=score).collect()
    assert {r["predicted"] for r in tied} == {1}
    one = toxicity.fit(labelled.where("toxic = 1"))
    assert toxicity.score_toxicity(labelled.where("doc_id = 3"), one).first()["score"] > 0.99
    assert {"a", "hindu", "x"} in toxicity.swapped({"a", "muslim", "x"}) and len(toxicity.swapped({"muslim", "x"})) == 6 and not toxicity.swapped({"x"})


def test_toxicity_edges(spark):
    rows = [(i, f"w{i % 40} w{i % 23} " + ("scum" if i % 4 == 0 else "fine"), None, None) for i in range(400)]
    df = clashing(spark, rows + [(1000, None, None, None), (1001, "", None, None), (1002, "w1 " * 200_000 + "Scum.", None, None), (None, "scum", None, None)])
    labelled = spark.createDataFrame([(i, t, int(i % 4 == 0) if i % 50 else None) for i, t, _, _ in rows], "doc_id long, text string, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(df, toxicity.fit(labelled)).collect()}
    assert len(got) == 404
    assert all(got[i]["predicted"] == int(i % 4 == 0) for i in range(400))
    assert got[1000]["score"] == got[1001]["score"] and got[1002]["predicted"] == 1 and got[None]["predicted"] == 1
    assert toxicity.score_toxicity(df.limit(0), toxicity.fit(labelled.limit(0))).count() == 0


def test_packing(spark):
    import tokenizers

    encoder = tokenizers.Tokenizer.from_file(packing.tokenizer_file())
    rows = [r for r in EDGES if r[0] not in (None, 5)] + [(100 + i, f"Some text, number {i}! é don't" * (i % 60), None, None) for i in range(300)]
    ids = {i: np.array([*encoder.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t, _, _ in rows}
    got = packing.pack(clashing(spark, rows).repartition(3), packing.tokenizer_file()).toPandas()
    for i, part in got.groupby("doc_id"):
        part = part.sort_values("start")
        assert part["start"].tolist() == [0, *np.cumsum(part["length"])[:-1]] and (part["doc_tokens"] == len(ids[i])).all()
        assert b"".join(part["ids"]) == ids[i].tobytes()
        assert [zlib.crc32(b) for b in part["ids"]] == part["ids_crc32"].tolist()
    assert set(got["doc_id"]) == set(ids)
    sizes = got.groupby("sequence_id")["length"].sum()
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part["offset"].tolist() == [0, *np.cumsum(part["length"])[:-1]] and len(part) <= 256
    assert all(n == 2048 or n & (n - 1) == 0 for n in sizes)


def plain_packer(sizes, losses, limits):
    """The heuristic written out: item by item, in fractions."""
    from fractions import Fraction as Q

    cap, segments, loss_cap = limits
    items = [[i, 0, int(n), int(q)] for i, n, q in sorted(zip(range(len(sizes)), sizes, losses, strict=True), key=lambda x: (-x[1], x[0])) if n]
    bins = []
    while rest := sum(x[2] for x in items):
        target = cap if rest >= cap else 1 << (rest.bit_length() - 1)
        room, out = [target, segments, loss_cap], []
        while room[0] and room[1] and items:
            dot = [Q(n * room[0], cap**2) + Q(room[1], segments**2) + Q(q * room[2], loss_cap**2) for _, _, n, q in items]
            fit = [k for k, (_, _, n, q) in enumerate(items) if n <= room[0] and q <= room[2]]
            k = max(fit or range(len(items)), key=lambda k: (dot[k], -k))
            i, at, n, q = items[k]
            take = min(n, room[0], n - q + room[2])
            if not take:
                break
            used = max(0, take - (n - q))
            out.append((i, at, take))
            items[k] = [i, at + take, n - take, q - used]
            room = [room[0] - take, room[1] - 1, room[2] - used]
            items = [x for x in items if x[2]]
        bins.append(out)
    return bins


def test_packing_against_a_plain_packer():
    draw = np.random.default_rng(5)
    for limits in ((64, 256, 64), (64, 4, 32), (128, 8, 40), (16, 1, 16)):
        for n in (0, 1, 7, 60):
            sizes = draw.integers(0, 150, n)
            losses = sizes if limits[1] == 256 else draw.integers(0, sizes + 1)
            assert list(packing.pack_window(sizes, losses, limits)) == plain_packer(sizes.tolist(), losses.tolist(), limits)


def test_packing_windows_nulls_and_repeats(spark, monkeypatch):
    """Null and repeated ids, and a row of more tokens than a window holds."""
    import tokenizers

    encoder = tokenizers.Tokenizer.from_file(packing.tokenizer_file())
    texts = [(None, None), (None, "x"), (4, "same text"), (4, "same text"), (5, ""), (6, "long word " * 600_000)]
    got = packing.pack(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), packing.tokenizer_file()).toPandas()
    want = Counter()
    for i, t in texts:
        want[i] += len(encoder.encode(t or "", add_special_tokens=False).ids) + 1
    assert {None if i != i else int(i): int(n) for i, n in got.groupby("doc_id", dropna=False)["length"].sum().items()} == dict(want)
    assert want[6] > packing.WINDOW_TOKENS and got.groupby("sequence_id")["length"].sum().max() == 2048
    same = got[got["doc_id"] == 4]
    assert len(same) == 2 and same["start"].tolist() == [0, 0] and same["ids_crc32"].nunique() == 1


def test_packing_limits_and_nulls(spark):
    rows = [(i if i else None, "a b c d e f g h " * 4, 24) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, prompt int")
    got = packing.pack(df, packing.tokenizer_file(), prompt_col="prompt", max_tokens=128, max_segments=3, max_loss_tokens=20).toPandas()
    by = got.groupby("sequence_id").agg(n=("length", "sum"), pieces=("length", "count"), loss=("loss_tokens", "sum"))
    assert (by["n"] <= 128).all() and (by["pieces"] <= 3).all() and (by["loss"] <= 20).all()
    assert got["length"].sum() == 50 * 33 and got["loss_tokens"].sum() == 50 * 9
    assert got["doc_id"].isna().any()


def test_tokenizer_matches_the_whole_one():
    import tokenizers

    encoder, own = tokenizers.Tokenizer.from_file(packing.tokenizer_file()), packing.word_tokenizer(packing.tokenizer_file(), None)
    draw = random.Random(1)
    letters = [*"aAzZéÉßİıŒſ'’.,!<|>019  \n\t\x0b\x1c\x85漢字«»#ªµ×I", "<|endoftext|>", "'s", "don't", "é"]
    for _ in range(2000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 25)))
        assert np.frombuffer(own(text), "<u4").tolist() == encoder.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("ids", [[None], [5], [None, 5]])
def test_fits_draw_rows_of_one_id_or_none_like_others(spark, monkeypatch, ids):
    monkeypatch.setattr(language, "SAMPLE_OF_LANGUAGE", 300)
    monkeypatch.setattr(toxicity, "SAMPLE_OF_LABEL", 300)
    draw = random.Random(1)
    say = lambda words: " ".join(draw.choice(words) for _ in range(12))
    own = {"en": [f"the{c}" for c in "abcdefgh"], "de": [f"der{c}" for c in "abcdefgh"]}
    rows = [(ids[i % len(ids)], say(own[k]) + (" scum" if bad else ""), k, int(bad)) for i in range(3000) for k in own for bad in [i % 2 == 0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = language.fit(df)
    found = spark.createDataFrame([(1, "thea theb"), (2, "dera derb")], "doc_id long, text string")
    assert [r["lang_pred"] for r in language.identify(found, model).orderBy("doc_id").collect()] == ["en", "de"]
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda rows, labels, pairs: seen.append(np.bincount(labels)))
    toxicity.fit(df)
    assert all(200 < n < 400 for n in seen[0])


def test_row_keys_tell_fields_and_nulls_apart(spark):
    rows = [(1, "b\x1fc d e f", "a"), (1, "c d e f", "a\x1fb"), (1, None, "-"), (1, "-", None), (1, "\x00", "a"), (1, None, "a"), (1, "", "a"), (11, "a", "b"), (1, "a", "1:b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert df.select(mixing.row_key(df, "doc_id", "text", "source")).distinct().count() == len(rows)
    got = {(r["text"], r["source"]) for r in mixing.mixed_documents(df, block=1).collect()}
    assert got <= {(t, s) for _, t, s in rows} and {("b\x1fc d e f", "a"), ("c d e f", "a\x1fb")} <= got


def test_toxicity_swaps_terms_of_the_caller(spark):
    """Labels lean on one group's name; with the names as terms the gap between counterfactuals falls, and without any the fit is a plain one."""
    draw, rows = random.Random(3), []
    for i in range(1200):
        bad = i % 2
        group = draw.choices(["zorb", "quil"], [9, 1] if bad else [2, 8])[0]
        rows.append((i, f"{group} {draw.choice('abcd')}{draw.choice('efgh')} said so." + (" scum" if bad and draw.random() < 0.8 else ""), bad))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    plain, told = toxicity.fit(df), toxicity.fit(df, terms=[("zorb", "quil")])
    gap = lambda m: abs(m.score(toxicity.features_of({"zorb", "said", "so"}, {})) - m.score(toxicity.features_of({"quil", "said", "so"}, {})))
    assert plain.swaps == 0 and told.swaps == 1200 and gap(told) < 0.5 * gap(plain)
    assert told.score(toxicity.features_of({"quil", "scum", "said"}, {})) > 0.7


def test_simhash_null_ids_and_repeated_rows(spark):
    one, other = " ".join(f"w{i}" for i in range(200)), " ".join(f"v{i}" for i in range(200))
    rows = [(None, one), (5, one), (5, one), (None, other), (None, other), (7, None), (7, ""), (9, "")]
    got = Counter((r["doc_id"], r["component_id"]) for r in simhash.simhash_components(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string")).collect())
    assert got == Counter({(None, 5): 1, (5, 5): 2, (None, None): 2, (7, 7): 2, (9, 7): 1})
