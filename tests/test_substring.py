"""Texts that contain any of many words: both ways against plain comparison."""

import random

import pytest
from pyspark.sql import functions as F

from frameloom.operators import catalog, substring


def tables(spark, seed):
    draw = random.Random(seed)
    some = lambda most: "".join(draw.choice("abcé日𝔸 ") for _ in range(draw.randint(0, most)))
    texts = [(i, draw.choice([None, "", some(40), some(300)]), f"x{i}") for i in range(80)] + [(1, "abc", "again"), (1, "abc", "again")]
    words = [(draw.choice([None, some(1), some(2), some(3), some(5), some(9), "never-there"]), k) for k in range(150)] + [("ab", 0), ("ab", 1)]
    return texts, words, spark.createDataFrame(texts, "number int, title string, found string").repartition(3), spark.createDataFrame(words, "word string, k int").repartition(2)


@pytest.mark.parametrize("most_bytes", [0, 1 << 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_both_ways_equal_plain_comparison(spark, most_bytes, seed):
    texts, words, df, own = tables(spark, seed)
    got = substring.texts_with(df, "title", own, "word", most_bytes)
    assert got.columns == [*df.columns, *own.columns]
    want = sorted((*t, *w) for t in texts for w in words if t[1] is not None and w[0] is not None and w[0] in t[1])
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 500


@pytest.mark.parametrize("most_bytes", [0, 1 << 20])
def test_no_words_and_no_texts(spark, most_bytes):
    _, _, df, own = tables(spark, 3)
    for a, b in ((df.limit(0), own), (df, own.limit(0)), (df, own.where("word is null"))):
        assert substring.texts_with(a, "title", b, "word", most_bytes).count() == 0
    every = substring.texts_with(df, "title", spark.createDataFrame([("",)], "word string"), "word", most_bytes)
    assert every.count() == df.where("title is not null").count()


def test_no_nested_loop_over_many_words(spark):
    df = spark.range(3000).select(F.col("id"), F.concat_ws(" ", F.sha2(F.col("id").cast("string"), 256), F.sha2(F.concat(F.lit("b"), "id"), 256)).alias("title"))
    words = spark.range(100_000).select(F.substring(F.sha2(F.col("id").cast("string"), 256), 9, 12).alias("word"))
    counts = []
    for most_bytes in (0, substring.MOST_BYTES):
        found = substring.texts_with(df, "title", words, "word", most_bytes)
        assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
        counts.append({(r["id"], r["word"]) for r in found.select("id", "word").collect()})
    assert counts[0] == counts[1] and len(counts[0]) >= 3000


def test_titles_with_any_number_of_words(spark):
    _, _, df, own = tables(spark, 4)
    assert sorted(map(tuple, catalog.titles_with(df, "title", own, "word").collect())) == sorted(map(tuple, substring.texts_with(df, "title", own, "word", 0).collect()))
