"""Repeated passages: bytes of every string of 100 that also starts earlier in the corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.llm.run_length_index import RunLengthIndex
from frameloom.llm.util import forget, partitions, table, write_table

#: Bytes of a repeat, of an anchor inside it, and how many starts of anchors a repeat has.
LENGTH, ANCHOR = 100, 32
STARTS = LENGTH - ANCHOR + 1
#: Bytes that are hashed at a time, and of texts whose anchors a task compares before it lets them go.
PIECE, FLUSH = 1 << 19, 1 << 25
#: Segments of one anchor that one index holds at most; the windows of an anchor of more are dealt out one by one.
HOT_SEGMENTS = 20_000

_PRIME = 0x9E3779B97F4A7C15 | 1
_PLACE_BITS = 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_PRIME))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_PRIME, n, 1 << 64))


def gram_hashes(data: np.ndarray, longest: int) -> dict[int, np.ndarray]:
    """Polynomial hashes modulo 2 ** 64 of all strings of 1, 2, 4, ... longest bytes, by their start."""
    out, n = {1: _BYTE[data]}, 1
    while n < longest:
        a = out[n]
        out[2 * n] = a[: max(0, len(a) - n)] * _power(n) + a[n:]
        n *= 2
    return out


def segments(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, count, anchor hash, content hash) of the segments of the texts that lie in data up to each of ends.

    The anchor of a window of LENGTH bytes is the one of its strings of ANCHOR bytes whose hash is smallest, the
    last such. It depends on the window's bytes alone, so equal windows have equal anchors wherever they are. A
    segment is a run of window starts that share an anchor at one place.
    """
    none = np.empty(0, np.int64)
    size = len(data) - LENGTH + 1
    if size <= 0:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    grams = gram_hashes(data, 64)
    hashed = _mixed(grams[ANCHOR])
    low = np.uint64((1 << _PLACE_BITS) - 1)
    key = (hashed & ~low) | (low - np.arange(len(hashed), dtype=np.uint64))
    padded = np.full(-(-len(key) // STARTS) * STARTS, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(key)] = key
    blocks = padded.reshape(-1, STARTS)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    place = low - (np.minimum(after[:size], before[STARTS - 1 : STARTS - 1 + size]) & low)
    inside = np.ones(size + LENGTH, bool)
    for back in range(1, LENGTH):
        inside[ends[:-1] - back] = False
    inside = inside[:size]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (place[1:] != place[:-1])
    start = np.flatnonzero(first)
    stop = np.flatnonzero(inside & np.append(first[1:] | ~inside[1:], True))
    count = stop - start + 1
    last = start + count - 1 + LENGTH - 64
    content = _mixed(grams[64][start]) * _power(3) + _mixed(grams[64][(start + last) // 2]) * _power(5) + _mixed(grams[64][last]) + count.astype(np.uint64)
    return start, count, hashed[place[start].astype(np.int64)], _mixed(content)


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals [start, end) sorted by doc and start, those that touch made one."""
    if not len(doc):
        return doc, start, end
    fresh = np.append(True, doc[1:] != doc[:-1])
    group = np.cumsum(fresh) - 1
    offset = group * np.int64(1 << 40)
    reach = np.maximum.accumulate(end + offset)
    fresh[1:] |= start[1:] + offset[1:] > reach[:-1]
    at = np.flatnonzero(fresh)
    stop = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], reach[stop] - offset[stop]


def once(*columns: np.ndarray) -> list[np.ndarray]:
    """Sorted columns without rows that are equal to the one before."""
    keep = np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0)) if len(columns[0]) else np.zeros(0, bool)
    return [c[keep] for c in columns]


#: Rows between stages; doc is a row's number in order. kind 0: a segment (anchor, content, doc, place); 1: a repeat [start, end) of doc, with
#: end in content; 2: a segment whose windows have to be compared. place = start << 7 | count.
_ROW = "kind int, anchor long, content long, doc long, place long"
_NAMES = [x.split()[0] for x in _ROW.split(", ")]


def _rows(kind: np.ndarray | int, anchor: np.ndarray, content: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    kind = np.full(len(doc), kind) if np.isscalar(kind) else kind
    return pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), *(pa.array(x.view(np.int64)) for x in (anchor, content, doc, place))], names=_NAMES)


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of the documents. Of equal ones that the task holds together only the first goes on; the others are repeats already."""
    held: list[tuple] = []
    texts: list[tuple[int, bytes, int]] = []
    size = total = 0

    def hash_texts() -> None:
        nonlocal size
        if texts:
            data = np.frombuffer(b"".join(t for _, t, _ in texts), np.uint8)
            lengths = np.array([len(t) for _, t, _ in texts])
            ends = np.cumsum(lengths)
            start, count, anchor, content = segments(data, ends)
            of = np.searchsorted(ends, start, side="right")
            doc, base = (np.array([t[k] for t in texts], np.int64) for k in (0, 2))
            held.append((anchor, content, doc[of], (start - (ends - lengths)[of] + base[of]) << 7 | count))
        texts.clear()
        size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal total
        if held:
            anchor, content, doc, place = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((place, doc, content, anchor))
            anchor, content, doc, place = once(anchor[order], content[order], doc[order], place[order])
            again = np.append(False, (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1]))
            yield _rows(0, anchor[~again], content[~again], doc[~again], place[~again])
            yield _repeats(doc[again], place[again])
        total = 0

    for batch in batches:
        for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            for base in range(0, max(1, len(raw) - LENGTH + 1), PIECE):
                part = raw[base : base + PIECE + LENGTH - 1]
                if len(part) < LENGTH:
                    continue
                if size + len(part) > PIECE + LENGTH:
                    hash_texts()
                texts.append((doc, part, base))
                size, total = size + len(part), total + len(part)
            if total > FLUSH:
                hash_texts()
                yield from flush()
    hash_texts()
    yield from flush()


def _repeats(doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Rows of kind 1 for segments that are repeats as a whole; the anchor deals them out by document."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    start = place >> 7
    owner, begin, end = merged(doc, start, start + (place & 127) - 1 + LENGTH)
    return _rows(1, _mixed(owner.view(np.uint64) ^ begin.view(np.uint64)), end, owner, begin << 7)


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over partitions sorted by anchor, content, doc, place: repeats, and the first of equal segments. Only the last row is kept between batches."""
    last: list[np.ndarray] | None = None
    for batch in batches:
        rows = _columns(batch, _NAMES)
        known = rows[0] == 1
        if known.any():
            yield _rows(1, *(x[known] for x in rows[1:]))
        rows = [x[~known] for x in rows[1:]]
        if not len(rows[0]):
            continue
        before = [np.append(y, x[:-1]) for x, y in zip(rows, last or [x[:1] for x in rows], strict=True)]
        same = (rows[0] == before[0]) & (rows[1] == before[1])
        fresh = ~same | (rows[2] != before[2]) | (rows[3] != before[3])
        if last is None:
            same[0] = False
        last = [x[-1:] for x in rows]
        yield _repeats(rows[2][same & fresh], rows[3][same & fresh])
        anchor, _, doc, place = (x[~same] for x in rows)
        yield _rows(2, anchor, np.zeros(len(anchor), np.int64), doc, place)  # one row for each content, so counts need no content


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments that have to be compared."""
    for batch in batches:
        anchors, docs, places, hot, bodies = [], [], [], [], []
        for doc, text, parts in zip(*(batch.column(n).to_pylist() for n in ("doc", "text", "parts")), strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            for part in parts:
                place = part["place"]
                start = place >> 7
                anchors.append(part["anchor"]), docs.append(doc), places.append(place), hot.append(part["hot"]), bodies.append(raw[start : start + (place & 127) - 1 + LENGTH])
        yield pa.RecordBatch.from_arrays([pa.array(anchors, pa.int64()), pa.array(docs, pa.int64()), pa.array(places, pa.int64()), pa.array(hot, pa.bool_()), pa.array(bodies, pa.binary())], names=["anchor", "doc", "place", "hot", "body"])


def _later(anchor: np.ndarray, doc: np.ndarray, place: np.ndarray, bodies: list[bytes]) -> pa.RecordBatch:
    """The windows of the segments that start earlier in another segment of the same anchor."""
    order = np.lexsort((place, doc, anchor))
    order = order[np.append(True, (np.diff(anchor[order]) != 0) | (np.diff(doc[order]) != 0) | (np.diff(place[order]) != 0))]
    anchor, doc, place, bodies = anchor[order], doc[order], place[order], [bodies[k] for k in order]
    count, lengths = place & 127, np.array([len(b) for b in bodies], np.int64)
    index = RunLengthIndex(np.frombuffer(b"".join(bodies), np.uint8), lengths)
    row = np.repeat(np.arange(len(bodies)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    window = index.classes(LENGTH)[(np.cumsum(lengths + 1) - lengths - 1)[row] + step]
    start = (place[row] >> 7) + step
    order = np.lexsort((start, doc[row], window))
    hit = np.sort(order[np.append(False, window[order][1:] == window[order][:-1])])
    return _repeats(doc[row[hit]], start[hit] << 7 | 1)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over partitions sorted by anchor: each batch of whole groups gets an index."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        anchor = batch.column("anchor").to_numpy()
        cut = int(np.searchsorted(anchor, anchor[-1], side="left")) if len(anchor) else 0
        if held and len(anchor) and anchor[0] != held[-1].column("anchor")[-1].as_py():
            yield _indexed(held)
            held = []
        if cut:
            yield _indexed([*held, batch.slice(0, cut)])
            held = []
        if len(anchor) > cut:
            held.append(batch.slice(cut))
    if held:
        yield _indexed(held)


def _indexed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(batches)
    return _later(*(rows.column(n).to_numpy() for n in ("anchor", "doc", "place")), rows.column("body").to_pylist())


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window of the segments, with its bytes."""
    for batch in batches:
        rows = [(doc, (place >> 7) + k, body[k : k + LENGTH])
                for doc, place, body in zip(*(batch.column(n).to_pylist() for n in ("doc", "place", "body")), strict=True) for k in range(place & 127)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["doc", "at", "window"])


def _digest(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                spans = sorted((p["place"] >> 7, p["content"]) for p in parts or ())
                kept, at, removed, runs = [], 0, 0, 0
                for start, end in spans:
                    if start > at or not runs:
                        kept.append(raw[at:start])
                        runs += 1
                        removed += end - start
                    else:
                        removed += max(0, end - at)
                    at = max(at, end)
                kept.append(raw[at:])
                rest = b"".join(kept)
                out.append((len(raw), removed, runs, hashlib.sha256(rest).hexdigest(), rest if keep else None))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            new = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *new], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = True) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes; null if keep_bytes is False) of each row.

    A byte goes if a string of LENGTH bytes that covers it also starts earlier: in a row of smaller id, or
    earlier in the row. Null texts are empty; a text shorter than LENGTH loses nothing. A null id comes after
    all others. Rows that share an id come in order of a digest of their text, and each is a document of its own: of
    wholly equal rows, one keeps its text. An empty table gives none.

    Rows are numbered in order of id, digest and place by a range partitioning, so that each has a number of its own.

    1. Windows are dealt out by their anchors, so that equal windows meet; a task sends on one of equal segments.
    2. Segments equal to an earlier one are repeats; they meet by anchor and content, so that an anchor of many contents is
       dealt to many tasks. Where an anchor has several contents, by a count that combines before its shuffle, segments go on.
    3. Their bytes are looked up. A run-length index of a batch of anchors' segments streams matching statistics;
       what matches over LENGTH bytes is compared by place. The windows of an anchor with more than HOT_SEGMENTS
       segments meet one by one instead, by their bytes, with a minimum that combines before its shuffle.
    4. Each document gets its repeats, merges them and cuts them out.
    """
    spark, n = df.sparkSession, partitions(df.sparkSession)
    docs = df.select(df[f"`{id_col}`"].alias("id"), F.coalesce(df[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_last(), F.sha2("text", 256).asc(), F.col("row").asc()]
    ranged = docs.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order)
    docs = write_table(ranged.select("id", "text", F.monotonically_increasing_id().alias("doc")), "numbered-texts")
    rows = docs.select("doc", "text").mapInArrow(_anchored, _ROW)
    settled = rows.repartition(n, "anchor", "content").sortWithinPartitions("anchor", "content", "doc", "place")
    found = write_table(settled.mapInArrow(_grouped, _ROW), "repeats")
    unsure = found.where("kind = 2").select("doc", "anchor", "place")
    several = write_table(unsure.groupBy("anchor").count().where("count > 1").select("anchor", (F.col("count") > HOT_SEGMENTS).alias("hot")), "several-contents")
    unsure = write_table(unsure.join(several, "anchor"), "unsure-segments")  # by itself, so that its shuffle is gone before texts move
    parts = unsure.groupBy("doc").agg(F.collect_list(F.struct("anchor", "place", "hot")).alias("parts"))
    bodies = write_table(docs.select("doc", "text").join(parts, "doc").mapInArrow(_cut, "anchor long, doc long, place long, hot boolean, body binary"), "segments")
    compared = bodies.where("not hot").drop("hot").repartition(n, "anchor").sortWithinPartitions("anchor").mapInArrow(_compared, _ROW)
    windows = bodies.where("hot").select("doc", "place", "body").mapInArrow(_windows, "doc long, at long, window binary")
    first = windows.groupBy("window").agg(F.min(F.struct("doc", "at")).alias("first"))
    first = write_table(first, "first-windows")
    later = windows.join(first, "window").where(F.struct("doc", "at") != F.col("first"))
    later = later.select(F.lit(1).alias("kind"), F.lit(0).cast("long").alias("anchor"), (F.col("at") + LENGTH).alias("content"), "doc", F.shiftleft("at", 7).alias("place"))
    more = write_table(compared.union(later), "repeats")
    forget(several, unsure, bodies, first)
    marks = found.where("kind = 1").union(more).groupBy("doc").agg(F.collect_list(F.struct("place", "content")).alias("parts"))
    kind = docs.schema["id"].dataType.simpleString()
    out = docs.join(marks, "doc", "left").select("id", "text", "parts").mapInArrow(_digest(keep_bytes), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumnRenamed("id", id_col)


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_bytes=False).drop("kept")
