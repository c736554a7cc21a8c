"""Recognised text to records: long form, cleaning, themes, wide form, documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.functions.text import chosen_value, label_stem, numbered, shadow_label

# The labels of the two sheets.
INFO_LABELS = ("title", "library", "author")
DATA_LABELS = ("rank", "last", "total", "view", "comment", "mylist", "mylist_rate", "comment_rate", "date", "id")


def unpivot_check(df: DataFrame, index: str, labels: tuple[str, ...], shadows: bool) -> DataFrame:
    """nu, label, value, seq: a row for each cell; titles in short form, and a shadow row of the raw value if asked for.

    One explode of an array of structs, so a row is read once however many labels there are.
    """
    cells = []
    for i, label in enumerate(labels):
        value = F.col(label).cast("string")
        if shadows:
            cells.append(F.struct(shadow_label(F.lit(label)).alias("label"), value.alias("value"), F.lit(2 * i).alias("seq")))
        cells.append(F.struct(F.lit(label).alias("label"), chosen_value(F.lit(label), value).alias("value"), F.lit(2 * i + 1).alias("seq")))
    return df.select(numbered(F.col(index)).alias("nu"), F.explode(F.array(*cells)).alias("cell")).select("nu", "cell.label", "cell.value", "cell.seq")


def check_rows(info: DataFrame, data: DataFrame) -> DataFrame:
    """Info rows, then data rows, each by the stem of its label, then as they came."""
    both = info.withColumn("block", F.lit(0)).unionByName(data.withColumn("block", F.lit(1)))
    return both.withColumn("stem", label_stem(F.col("label"))).orderBy("block", "stem", "nu", "seq").select("nu", "label", "value")


def attach_theme(df: DataFrame, themes: DataFrame, key: str) -> DataFrame:
    """Add the theme of each row's number; a number that the track doesn't have is an error, as is a null theme."""
    joined = df.join(themes, key, "left")
    return joined.withColumn("theme", F.coalesce("theme", F.raise_error(F.concat(F.lit("no theme for row "), F.col(key).cast("string"))).cast("string")))


def ready_pivot(df: DataFrame, keys: list[str], label: str, value: str, seq: str, labels: list[str]) -> DataFrame:
    """A row for each key with a column for each label; of repeated labels the last value; labels that end in _ are left out.

    A conditional aggregate for each label in one pass, with the labels known beforehand.
    """
    clean = df.where(~F.col(label).endswith("_"))
    last = lambda name: F.max(F.when(F.col(label) == name, F.struct(seq, value)))[value]
    return clean.groupBy(*keys).agg(*(last(name).alias(name) for name in labels))


def ready_json(wide: DataFrame, theme: str, order: str) -> DataFrame:
    """theme, order, record: each row as JSON text, other scripts unescaped, by theme and order; a row for each record, so no theme has to fit one."""
    others = [c for c in wide.columns if c not in (theme, order)]
    return wide.select(theme, order, F.to_json(F.struct(order, *others)).alias("record")).orderBy(theme, order)
