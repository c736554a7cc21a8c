"""Language identification: known words first, shorter and shorter character n-grams for the others."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.llm.util import TEXT_ROWS, forget, held_out, table, text_of, tidy, write_table

#: Labelled documents of each language that the model is fitted on, about; the sample is drawn by a hash of id and text.
SAMPLE_OF_LANGUAGE = 2000
#: What the model knows at most: words, n-grams of each length, and the longest n-gram. Also bounds the broadcast.
KNOWN_WORDS, KNOWN_GRAMS, LONGEST_GRAM = 50_000, 20_000, 4
#: Unknown words whose vectors a worker remembers, about, and words of a text that are scored at a time.
CACHED_WORDS, PART_WORDS = 100_000, 65_536
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Per-language log frequencies of words and n-grams, each less the languages' mean of it."""

    def __init__(self, languages: list[str], words: dict[str, list[int]], totals: list[int]):
        """words: the count of each word in each language; totals: of all words in each language."""
        self.languages = languages
        counts = np.array(list(words.values()), float).reshape(len(words), len(languages))
        self.words = {w: i for i, w in enumerate(words)}
        self.word_logs = self._logs(counts, np.asarray(totals, float))
        self.grams: list[dict[str, int]] = [{}]
        self.gram_logs = [np.zeros((0, len(languages)), np.float32)]
        for n in range(1, LONGEST_GRAM + 1):
            rows: dict[str, int] = {}
            at = [[rows.setdefault(g, len(rows)) for g in grams_of(w, n)] for w in words]
            found = np.zeros((len(rows), len(languages)))
            np.add.at(found, [k for x in at for k in x], np.repeat(counts, [len(x) for x in at], axis=0))
            names, total = list(rows), found.sum(axis=1)
            most = sorted(range(len(names)), key=lambda k: (-total[k], names[k]))[:KNOWN_GRAMS]
            self.grams.append({names[k]: i for i, k in enumerate(most)})
            self.gram_logs.append(self._logs(found[most], found.sum(axis=0)))

    @staticmethod
    def _logs(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
        logs = np.log((counts + 0.5) / (totals + 0.5 * len(counts) + 1))
        return (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32) if counts.size else np.zeros(counts.shape, np.float32)

    def unseen(self, words: list[str]) -> np.ndarray:
        """For each word, the mean over its known n-grams of the greatest length of which any is known; else zeros."""
        out, left = np.zeros((len(words), len(self.languages)), np.float32), list(range(len(words)))
        for n in range(LONGEST_GRAM, 0, -1):
            known, none, owner, rows = self.grams[n], [], [], []
            for i in left:
                found = [k for g in grams_of(words[i], n) if (k := known.get(g)) is not None]
                owner += [i] * len(found)
                rows += found
                if not found:
                    none.append(i)
            for k in range(out.shape[1] if rows else 0):
                out[:, k] += np.bincount(owner, self.gram_logs[n][rows, k], len(words))
            if rows:
                out /= np.maximum(np.bincount(owner, minlength=len(words)), 1)[:, None]
            left = none
        return out

    def predictor(self) -> Callable[[str], tuple[str, float]]:
        """A function from a text to its language and that language's share of the posterior, equal priors."""
        at, known = dict(self.words), len(self.words)
        matrix = np.zeros((known + CACHED_WORDS + PART_WORDS, len(self.languages)), np.float32)
        matrix[:known] = self.word_logs

        def predict(text: str) -> tuple[str, float]:
            words = words_of(text)
            if not self.languages or not any(map(str.isalpha, text)):
                return UNKNOWN, 0.0
            total = np.zeros(len(self.languages))
            for i in range(0, len(words), PART_WORDS):
                part = words[i : i + PART_WORDS]
                index = list(map(at.get, part))
                if None in index:
                    if len(at) > known + CACHED_WORDS:
                        at.clear()
                        at.update(self.words)
                        index = list(map(at.get, part))
                    new = list({w for w, k in zip(part, index, strict=True) if k is None})
                    matrix[len(at) : len(at) + len(new)] = self.unseen(new)
                    at.update(zip(new, range(len(at), len(at) + len(new)), strict=True))
                    index = [at[w] for w in part]
                total += matrix[index].sum(axis=0, dtype=float)
            best = int(np.argmax(total))
            return self.languages[best], float(1 / np.exp(total - total[best]).sum())

        return predict


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found: Counter = Counter()
        for lang, text in zip(batch["lang"], batch["content"], strict=True):
            found.update((lang, w) for w in words_of(text))
        yield pd.DataFrame([(lang, w, n) for (lang, w), n in found.items()], columns=["lang", "word", "n"])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", learn: Column | None = None) -> Model:
    """Fit on about SAMPLE_OF_LANGUAGE rows of each language, of those with a text, a language and learn not false.

    Rows are counted where they are read and summed by word; only the words that the model knows, at most
    KNOWN_WORDS, come to the driver. With no such row the model has no language. Rows are drawn by a hash of id and text, so rows of one id, or without one,
    are drawn like any other; wholly equal rows are drawn together.
    """
    rows = labelled.select(labelled[f"`{id_col}`"].alias("id"), labelled[f"`{text_col}`"].cast("string").alias("content"), labelled[f"`{lang_col}`"].cast("string").alias("lang"), (F.lit(True) if learn is None else learn).alias("learn"))
    rows = rows.where("learn and content is not null and lang is not null")
    per = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(per)
    if not languages:
        return Model([], {}, [])
    share = F.create_map(*(F.lit(x) for k, v in per.items() for x in (k, min(1.0, SAMPLE_OF_LANGUAGE / v))))
    drawn = rows.where(F.pmod(F.xxhash64(F.col("id").cast("string"), "content", F.lit("language")), F.lit(1 << 30)) < share[F.col("lang")] * float(1 << 30))
    counts = drawn.select("lang", "content").mapInPandas(tidy(_counts), "lang string, word string, n long")
    by_word = counts.groupBy("word").agg(F.sum("n").alias("total"), *(F.sum(F.when(F.col("lang") == k, F.col("n")).otherwise(0)).alias(f"n{i}") for i, k in enumerate(languages)))
    by_word = write_table(by_word, "word-counts", TEXT_ROWS)
    totals = by_word.agg(*(F.sum(f"n{i}") for i in range(len(languages)))).first()
    most = by_word.orderBy(F.desc("total"), "word").limit(KNOWN_WORDS).toPandas()
    forget(by_word)
    known = dict(zip(most["word"].tolist(), most[[f"n{i}" for i in range(len(languages))]].to_numpy().tolist(), strict=True))
    return Model(languages, known, [t or 0 for t in totals])


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, lang_pred and score (0 to 1) of each row, from its whole text alone.

    A null text, or one without a letter, is "und" with score 0; so is every text if the model has no
    language. Ties go to the first language in order. Very long texts are scored in parts that are summed.
    Null ids are not held out. Repeated rows give repeated results; an empty table gives none; other columns are not read.
    """
    rows = df.select(df[f"`{id_col}`"].alias("id"), held_out(df[f"`{id_col}`"]).alias("held"), text_of(df[f"`{text_col}`"]).alias("content"))
    kind, shared = rows.schema["id"].dataType.simpleString(), df.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = shared.value.predictor()
        for batch in batches:
            found = [predict(t) for t in batch.column("content").to_pylist()]
            columns = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] if math.isfinite(x[1]) else 0.0 for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held"), *columns], names=[id_col, "held_out", "lang_pred", "score"])

    return rows.mapInArrow(tidy(scored), f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")


def keep_identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = 0.5) -> DataFrame:
    """The rows whose language is told with at least that score, with df's columns, whatever their names.

    A null or empty text, or one without a letter, has no language and goes; so do all if no row has a language to learn from. Ties go to the first language,
    with half the score or less. Rows that share an id, repeated ones too, are one document, which stays if any of them is told; an empty table stays empty.
    """
    model = fit(df, id_col, text_col, lang_col, ~held_out(df[f"`{id_col}`"]))
    told = identify(df, model, id_col, text_col)
    best = F.max(F.when(F.col("lang_pred") != UNKNOWN, F.col("score")).otherwise(-1.0))
    rejected = write_table(told.groupBy(id_col).agg(best.alias("best")).where(F.col("best") < least).select(F.col(id_col).alias("__rejected")), "rejected", TEXT_ROWS)
    return df.join(rejected, df[f"`{id_col}`"].eqNullSafe(rejected["__rejected"]), "left_anti")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs, learn=~held_out(docs["doc_id"])))
