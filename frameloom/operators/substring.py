"""Rows whose text contains any of many words, without comparing each text with each word.

A list of words up to a size is searched for by an automaton that finds all of them in one pass over a text; a larger one is joined through an
inverted index of character grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from frameloom.functions.names import unused
from frameloom.sources.scratch import written

#: UTF-8 bytes of different words that are sent to the tasks, each with an automaton of about 50 times that size.
MOST_BYTES = 4 << 20
#: Characters of a gram; a shorter word is a gram as a whole.
GRAM = 3


def texts_with(df: DataFrame, text: str, words: DataFrame, word: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """df's rows whose text contains a word, once for each such row of words, with its columns. Null texts contain and null words are in nothing; "" is in every text.

    The words' size is measured first, in one small aggregate. Up to most_bytes they go to the tasks, and the texts are searched where they are read;
    beyond, only the words' grams meet those of the texts, and what meets is verified. The rows are the same.
    """
    distinct = words.select(F.col(word).alias("w")).where("w is not null").distinct()
    size = distinct.agg(F.sum(F.octet_length("w") + 1)).first()[0] or 0
    (found,) = unused(df, "found", beside=words)
    hits = _searched(df, text, distinct, found) if size <= most_bytes else _indexed(df, text, distinct, found)
    return hits.join(words, hits[found] == words[word]).drop(found)


def _searched(df: DataFrame, text: str, distinct: DataFrame, found: str) -> DataFrame:
    """df's rows with each word found, by an automaton of all words."""
    listed = sorted(r["w"] for r in distinct.collect())
    shared = df.sparkSession.sparkContext.broadcast(listed)

    @F.pandas_udf(ArrayType(StringType()))
    def matches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for w in shared.value:
            if w:
                automaton.add_word(w, w)
        always = [""] if "" in shared.value[:1] else []
        if len(automaton):
            automaton.make_automaton()
        for batch in batches:
            yield pd.Series([[] if t is None else always + (list({w for _, w in automaton.iter(t)}) if len(automaton) else []) for t in batch])

    return df.withColumn(found, F.explode(matches(F.col(text).cast("string"))))


def grams(text: Column, sizes: list[int]) -> Column:
    """The different grams of those sizes that a text has; size 0 is the empty one. The text is split into characters once."""
    per = lambda cs: F.flatten(F.array(*(_of_size(cs, k) for k in sizes if k), *([F.array(F.lit(""))] if 0 in sizes else [])))
    characters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.array_distinct(F.element_at(F.transform(F.array(characters), per), 1))


def _of_size(characters: Column, k: int) -> Column:
    joined = F.transform(characters, lambda c, i: F.concat(c, *(F.coalesce(F.get(characters, i + j), F.lit("")) for j in range(1, k))))
    return F.slice(joined, 1, F.greatest(F.size(characters) - (k - 1), F.lit(0)))


def _indexed(df: DataFrame, text: str, distinct: DataFrame, found: str) -> DataFrame:
    """df's rows with each word found, by the words' rarest grams.

    Of each word the gram that fewest texts have is looked up in the texts' inverted lists, so a word of frequent grams costs what its
    rarest one costs, and a word with a gram that no text has costs nothing. Lists hold numbers, not texts; a frequent gram is a hot key of
    its texts on one side only, which a join can split. Texts are fetched by number for what is verified.
    """
    (number,) = unused(df, "number")
    rows = written(df.withColumn(number, F.monotonically_increasing_id()), "texts")
    texts = rows.select(F.col(number).alias("n"), F.col(text).cast("string").alias("t")).where("t is not null")
    sized = distinct.withColumn("k", F.least(F.char_length("w"), F.lit(GRAM)))
    sizes = [r["k"] for r in sized.select("k").distinct().orderBy("k").collect()]
    of_words = sized.select("w", F.explode(F.filter(grams(F.col("w"), sizes), lambda g: F.char_length(g) == F.least(F.char_length("w"), F.lit(GRAM)))).alias("g"))
    needed = of_words.select("g").distinct()
    lists = written(texts.select("n", F.explode(grams(F.col("t"), sizes)).alias("g")).join(needed, "g", "left_semi"), "gram-lists")
    counts = lists.groupBy("g").agg(F.count("*").alias("texts"))
    rarest = of_words.join(counts, "g", "left").groupBy("w").agg(F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "g")).alias("least")).where("least.texts > 0").select("w", F.col("least.g").alias("g"))
    met = lists.join(rarest, "g").select("n", "w")
    hits = met.join(texts, "n").where(F.contains("t", "w")).select("n", F.col("w").alias(found))
    return rows.join(hits, rows[number] == hits["n"]).drop(number, "n")
