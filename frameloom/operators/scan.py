"""Running values over long sequences: a segmented prefix scan, so that one key with all rows is work for all tasks.

The windows of operators.sequence keep a key's rows in one task, which is right for sequences of bounded length. Here rows are
dealt into ranges by key and order; each range is scanned by itself, what it hands on (its carry) is one row, the
carries are scanned by key, and each is applied to the rows of the one range that it concerns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from frameloom.functions.names import unused
from frameloom.sources.scratch import written


@dataclass(frozen=True)
class Scan:
    """A running value. local: its value from the rows of the range alone, over a window of them in order. carry: what a range hands on, an
    aggregate (place orders its rows). before: the carries of the ranges before, over a window of them. whole: the value, from the local one,
    what came before (null if nothing did) and whether the row is its key's first in the range."""

    local: Callable[[WindowSpec], Column]
    carry: Callable[[Column], Column]
    before: Callable[[Column, WindowSpec], Column]
    whole: Callable[[Column, Column, Column], Column]


def _upto(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def previous(value: Column) -> Scan:
    """The value in the row before; null in the first."""
    return Scan(
        lambda w: F.lag(value).over(w), lambda place: F.max(F.struct(place, value.alias("v")))["v"], lambda c, w: F.lag(c).over(w),
        lambda local, before, first: F.when(first, before).otherwise(local),
    )


def running_sum(value: Column) -> Scan:
    """The sum of the values so far, the row's own included; nulls add nothing."""
    v = F.coalesce(value, F.lit(0).cast("long"))
    return Scan(lambda w: F.sum(v).over(_upto(w)), lambda place: F.sum(v), lambda c, w: F.sum(c).over(_earlier(w)), lambda local, before, first: local + F.coalesce(before, F.lit(0).cast("long")))


def latest(value: Column) -> Scan:
    """The last value so far that isn't null, the row's own included."""
    return Scan(
        lambda w: F.last(value, ignorenulls=True).over(_upto(w)), lambda place: F.max(F.when(value.isNotNull(), F.struct(place, value.alias("v"))))["v"],
        lambda c, w: F.last(c, ignorenulls=True).over(_earlier(w)), lambda local, before, first: F.coalesce(local, before),
    )


def ever(flag: Column) -> Scan:
    """Whether the flag has been true so far, the row included; null is false."""
    f = F.coalesce(flag, F.lit(False))
    return Scan(lambda w: F.max(f).over(_upto(w)), lambda place: F.max(f), lambda c, w: F.max(c).over(_earlier(w)), lambda local, before, first: local | F.coalesce(before, F.lit(False)))


@dataclass(frozen=True)
class Ranges:
    """Rows in ranges by keys and order. df has the caller's columns, those that were added, the range's number and the place, which grows in order."""

    df: DataFrame
    keys: tuple[str, ...]
    range_: str
    place: str

    def _beside(self, names: list[str]) -> Ranges:
        """The same rows, the range's number and the place under names that are none of these."""
        if not {n.lower() for n in names} & {self.range_.lower(), self.place.lower()}:
            return self
        range_, place = unused(self.df.withColumns({n: F.lit(0) for n in names}), "range", "place")
        return Ranges(self.df.withColumnsRenamed({self.range_: range_, self.place: place}), self.keys, range_, place)

    def with_columns(self, columns: dict[str, Column]) -> Ranges:
        """Columns of each row by itself; they may use what scans have added."""
        free = self._beside(list(columns))
        return Ranges(free.df.withColumns(columns), free.keys, free.range_, free.place)

    def where(self, condition: Column) -> Ranges:
        return Ranges(self.df.where(condition), self.keys, self.range_, self.place)

    def scan(self, **scans: Scan) -> Ranges:
        """Add the scans' values under their names.

        Windows here are over a key's rows of one range. A key that began in an earlier range is the first of its own, so at most one row for each range
        is handed on, and that table is broadcast. A later scan of the same rows finds them where they are: it shuffles carries only.
        """
        names = list(scans)
        if (free := self._beside(names)) is not self:
            return free.scan(**scans)
        first, *carries = unused(self.df, "first", *(f"carry_{n}" for n in names))
        w = Window.partitionBy(self.range_, *self.keys).orderBy(self.place)
        kept = {n: F.row_number().over(w) == 1 for n in [first]} | {n: s.local(w) for n, s in scans.items()}
        handed = self.df.groupBy(self.range_, *self.keys).agg(*(s.carry(F.col(self.place)).alias(c) for c, s in zip(carries, scans.values(), strict=True)))
        over = Window.partitionBy(*self.keys).orderBy(self.range_)
        number, = unused(handed, "number")
        handed = handed.select(self.range_, *self.keys, F.row_number().over(over).alias(number), *(s.before(F.col(c), over).alias(c) for c, s in zip(carries, scans.values(), strict=True)))
        handed = handed.where(F.col(number) > 1).drop(number)
        own, by = self.df.withColumns(kept), [self.range_, *self.keys]
        of = unused(own, *(f"of_{c}" for c in by))
        handed = handed.toDF(*(of[by.index(c)] if c in by else c for c in handed.columns))
        joined = own.join(F.broadcast(handed), [own[c].eqNullSafe(handed[o]) for c, o in zip(by, of, strict=True)], "left")
        whole = {n: s.whole(F.col(n), F.col(c), F.col(first)) for (n, s), c in zip(scans.items(), carries, strict=True)}
        return Ranges(joined.withColumns(whole).select(*(c for c in self.df.columns if c not in names), *names), self.keys, self.range_, self.place)

    def rows(self) -> DataFrame:
        """The caller's columns and those added."""
        return self.df.drop(self.range_, self.place)


def in_ranges(df: DataFrame, keys: list[str], order: list[str], ranges: int | None = None) -> Ranges:
    """df's rows, dealt into so many ranges (as many as a shuffle has partitions) by keys and order, sorted, and written.

    Range partitioning samples its splitters, so a key of all rows is cut into as many ranges as one of few. Rows that are equal in keys and order lie in one
    range, in an order of their own that stays. Null keys are a key, null orders come first. An empty table has no range.
    """
    range_, place = unused(df, "range", "place")
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc() for c in (*keys, *order)]
    dealt = df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn(place, F.monotonically_increasing_id())
    return Ranges(written(dealt, "ranges").withColumn(range_, F.shiftright(place, 33)), tuple(keys), range_, place)


def pairs(rows: Ranges, **columns: str) -> Ranges:
    """Each named column's value in the row before; null in a key's first row."""
    return rows.scan(**{new: previous(F.col(old)) for new, old in columns.items()})


def islands(rows: Ranges, breaks: Column, name: str = "cluster_id") -> Ranges:
    """Number the runs that begin where breaks holds, from 1; rows before the first such row get 0."""
    return rows.scan(**{name: running_sum(F.coalesce(breaks, F.lit(False)).cast("long"))})


def runs(rows: Ranges, flag: Column) -> DataFrame:
    """The runs of consecutive rows that flag holds for: keys, start, end (positions from 0, end excluded), length. One row a run: its rows are counted where they are."""
    at, held, run = unused(rows.df, "at", "held", "run")
    numbered = rows.with_columns({held: F.coalesce(flag, F.lit(False))}).scan(**{at: running_sum(F.lit(1).cast("long")), run: running_sum((~F.coalesce(flag, F.lit(False))).cast("long"))})
    own = numbered.df.where(F.col(held)).groupBy(*rows.keys, run)  # rows of a run have the same count of rows outside of runs before them
    return own.agg((F.min(at) - 1).alias("start"), F.max(at).alias("end"), F.count("*").alias("length")).drop(run)


def sections(rows: Ranges, header: Column, passing: Column) -> Ranges:
    """Add passed (true from a key's first passing row on), is_header (a header that isn't passed), section (headers so far) and title_place (the place of the
    section's header; null before all)."""
    passed = rows.scan(passed=ever(passing)).with_columns({"is_header": F.coalesce(header, F.lit(False)) & ~F.col("passed")})
    return passed.scan(section=running_sum(F.col("is_header").cast("long")), title_place=latest(F.when(F.col("is_header"), F.col(rows.place))))
