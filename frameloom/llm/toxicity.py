"""Toxicity: a linear classifier that is penalised for score changes when identity terms are swapped."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.llm.util import held_out, table, text_of

#: Terms that name groups neutrally, by kind; a term may be swapped for any other of its kind.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("woman", "man", "girl", "boy", "female", "male", "transgender"),
    ("women", "men", "girls", "boys"),
    ("gay", "lesbian", "straight", "bisexual", "queer"),
    ("deaf", "blind", "disabled", "autistic"),
    ("immigrant", "refugee", "citizen", "foreigner"),
    ("young", "old", "elderly"),
)
#: Labelled rows of each label that the classifier is fitted on, about; drawn by a hash of id and text.
SAMPLE_OF_LABEL = 4000
#: Hashed features; prefixes of words of these lengths are features beside the words.
FEATURE_BITS, PREFIXES = 19, (3, 4, 5, 6)
#: A feature counts if its shares of the two labels differ by so many standard errors.
LEAST_Z = 4.5
STEPS, RIDGE, SWAP_PENALTY = 400, 1e-3, 1.0

_WORD = re.compile(r"[^\W\d_]+")
_KIND = {term: kind for kind in IDENTITY_TERMS for term in kind}


def features_of(words: set[str], cache: dict[str, tuple[int, ...]]) -> np.ndarray:
    """The distinct features that a set of words has."""
    found: set[int] = set()
    for w in words:
        if (ids := cache.get(w)) is None:
            names = [w, *(f"{w[:k]}*" for k in PREFIXES if len(w) >= k)]
            ids = tuple({zlib.crc32(n.encode("utf-8", "surrogatepass")) >> (32 - FEATURE_BITS) for n in names})
            if len(cache) > 300_000:
                cache.clear()
            cache[w] = ids
        found.update(ids)
    return np.fromiter(found, np.int32, len(found))


def swapped(words: set[str], kinds: dict[str, tuple[str, ...]] = _KIND) -> list[set[str]]:
    """The counterfactuals of a set of words: in each, one identity term is another of its kind."""
    return [words - {w} | {t} for w in sorted(words & kinds.keys()) for t in kinds[w] if t not in words]


class Classifier:
    """weights and bias; swaps: how many counterfactuals of labelled sentences the fit has seen."""

    def __init__(self, weights: np.ndarray, bias: float, swaps: int = 0):
        self.weights, self.bias, self.swaps = weights, bias, swaps

    def score(self, ids: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[ids].sum(), -30, 30))))


def screened(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Whether each feature's shares of the labels' rows differ by LEAST_Z standard errors."""
    counts = np.zeros((2, 1 << FEATURE_BITS), np.int32)
    for r, y in zip(rows, labels, strict=True):
        counts[y, r] += 1  # a row has a feature once
    (n0, n1), zeros, ones = counts, (labels == 0).sum(), (labels == 1).sum()
    p = (n1 + n0) / len(labels)
    error = np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / ones + 1 / zeros))
    return (np.abs(n1 / ones - n0 / zeros) > LEAST_Z * error) & (n1 + n0 > 1)


def loss(at: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray, int]]) -> float:
    """What train minimises, of weights with the bias last: logistic loss, labels weighted alike; RIDGE / 2 times the square of the weights;
    and SWAP_PENALTY times the mean square of the change of logit by a swap, over the pairs (features lost, features got, times)."""
    weight = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    logit = np.array([at[-1] + at[r].sum() for r in rows])
    swaps = sum(n * (at[x].sum() - at[y].sum()) ** 2 for x, y, n in pairs) / max(1, sum(n for *_, n in pairs))
    return float(weight @ np.logaddexp(0, np.where(labels == 1, -logit, logit)) + RIDGE / 2 * (at[:-1] ** 2).sum() + SWAP_PENALTY * swaps)


def train(rows: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray, int]]) -> Classifier:
    """Logistic regression on the screened features that minimises loss, by accelerated gradient steps over all rows.

    pairs: the features that a labelled sentence loses and gets when an identity term is swapped, and how often. No row, or rows of one label
    only, give the label's share as the score of every text.
    """
    if not len(rows) or labels.min() == labels.max():
        share = float(labels.mean()) if len(rows) else 0.0
        return Classifier(np.zeros(1 << FEATURE_BITS), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    good = screened(rows, labels)
    place, size = np.cumsum(good) - 1, int(good.sum())  # steps are over the screened features alone
    weights = np.zeros(size + 1)
    rows = [place[r[good[r]]] for r in rows]
    index, of = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    weight = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    times = np.array([n for *_, n in pairs], float)
    times *= 2 * SWAP_PENALTY / max(1, times.sum())
    sides = [(np.concatenate(x), np.repeat(np.arange(len(pairs)), [len(f) for f in x])) for x in list(zip(*pairs, strict=True))[:2]]
    sides = [(place[f[good[f]]], owner[good[f]]) for f, owner in sides]
    steep = 0.25 * (1 + np.bincount(of, minlength=len(rows)).max(initial=0)) + RIDGE
    steep += sum(2 * SWAP_PENALTY * 2 * np.bincount(owner, minlength=1).max(initial=0) for _, owner in sides)
    at, momentum = weights.copy(), 1.0
    for _ in range(STEPS):
        logit = at[-1] + np.bincount(of, at[index], len(rows))
        slope = weight * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels)
        gradient = np.append(np.bincount(index, slope[of], size) + RIDGE * at[:-1], slope.sum())
        if sides:
            gap = np.subtract(*(np.bincount(owner, at[f], len(pairs)) for f, owner in sides)) * times
            gradient[:-1] += np.subtract(*(np.bincount(f, gap[owner], size) for f, owner in sides))
        moved = at - gradient / steep
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        at = moved + (momentum - 1) / faster * (moved - weights)
        weights, momentum = moved, faster
    every = np.zeros(1 << FEATURE_BITS)
    every[good] = weights[:-1]
    return Classifier(every, float(weights[-1]), sum(n for *_, n in pairs))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", learn: Column | None = None, terms: Iterable[tuple[str, ...]] = IDENTITY_TERMS) -> Classifier:
    """Fit on about SAMPLE_OF_LABEL rows of label 1 and as many of label 0, among those with learn not false; null labels are left out.

    Features are made where the rows are read, and equal rows and swaps are counted before they leave their task; the driver gets the sample's
    feature numbers and each different swap once. Texts that are null count as empty, ties and repeated rows count as often as they occur,
    and no labelled row, or those of one label only, give a constant score. Rows are drawn by a hash of id and text, so rows of one id, or without one,
    are drawn like any other; wholly equal rows are drawn together.

    terms: lower-case words that name groups neutrally, by kind. Where no labelled sentence holds one there is nothing to swap, and the fit is a plain one: its swaps are 0.
    """
    rows = labelled.select(labelled[f"`{id_col}`"].alias("id"), text_of(labelled[f"`{text_col}`"]).alias("content"), labelled[f"`{label_col}`"].cast("int").alias("y"), (F.lit(True) if learn is None else learn).alias("learn")).where("learn and y in (0, 1)")
    per = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    share = F.when(F.col("y") == 1, min(1.0, SAMPLE_OF_LABEL / per.get(1, 1))).otherwise(min(1.0, SAMPLE_OF_LABEL / per.get(0, 1)))
    drawn = rows.where(F.pmod(F.xxhash64(F.col("id").cast("string"), "content", F.lit("toxicity")), F.lit(1 << 30)) < share * float(1 << 30)).select("content", "y")

    kinds = {term: tuple(kind) for kind in terms for term in kind}

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict = {}
        pack = lambda ids: np.sort(ids).tobytes()
        for batch in batches:
            found: Counter = Counter()
            for text, y in zip(batch["content"], batch["y"], strict=True):
                found[int(y), pack(features_of(set(_WORD.findall(text.lower())), cache)), b""] += 1
                for sentence in re.split(r"[.!?\n]+", text.lower()):
                    words = set(_WORD.findall(sentence))
                    own = features_of(words, cache) if words & kinds.keys() else ()
                    for other in swapped(words, kinds):
                        new = features_of(other, cache)
                        found[-1, pack(np.setdiff1d(own, new)), pack(np.setdiff1d(new, own))] += 1
            yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["y", "ids", "other", "n"])

    got = drawn.mapInPandas(featured, "y int, ids binary, other binary, n long").groupBy("y", "ids", "other").agg(F.sum("n").alias("n")).toPandas()
    ids = lambda b: np.frombuffer(b, np.int32)
    all_ = sorted((int(y), bytes(a), bytes(b), int(n)) for y, a, b, n in got.itertuples(index=False))
    rows = [(ids(a), y) for y, a, _, n in all_ if y >= 0 for _ in range(n)]
    return train([r for r, _ in rows], np.array([y for _, y in rows]), [(ids(a), ids(b), n) for y, a, b, n in all_ if y < 0])


def score_toxicity(df: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text", least: float = 0.7) -> DataFrame:
    """id_col, held_out, score and predicted (1 if score >= least, else 0) of each row, from its whole text alone.

    A null text counts as empty; an empty one has the classifier's score for no word. Null ids are not held
    out. Repeated rows give repeated results; an empty table gives none; other columns are not read.
    """
    rows = df.select(df[f"`{id_col}`"].alias("id"), held_out(df[f"`{id_col}`"]).alias("held"), text_of(df[f"`{text_col}`"]).alias("content"))
    kind = rows.schema["id"].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = Classifier(*shared.value), {}
        for batch in batches:
            found = [own.score(features_of(set(_WORD.findall(t.lower())), cache)) for t in batch.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held"), pa.array(found, pa.float64()), pa.array([int(x >= least) for x in found], pa.int32())], names=[id_col, "held_out", "score", "predicted"])

    return rows.mapInArrow(scored, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    labelled = docs.select("doc_id", "text").join(sampled_labels(labels), "doc_id")
    return score_toxicity(docs, fit(labelled, learn=~held_out(labelled["doc_id"])))


def sampled_labels(labels: DataFrame) -> DataFrame:
    """Labels that are drawn before their texts are looked up: a table of bounded size. An id's equal labels count once, null ids have no text."""
    labels = labels.where("doc_id is not null").dropDuplicates(["doc_id", "toxic"])
    per = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, SAMPLE_OF_LABEL / per.get(1, 1))).otherwise(min(1.0, SAMPLE_OF_LABEL / per.get(0, 1)))
    drawn = labels.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("labels")), F.lit(1 << 30)) < share * float(1 << 30))
    return F.broadcast(drawn)
