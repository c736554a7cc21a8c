"""One named file for each row, written by tasks: drafts that are renamed, runs that may be repeated, and a preview."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.sources.scratch import _path, written

#: Files whose contents go to Python at a time.
FILE_ROWS = 500


def write_files(df: DataFrame, name: str, content: str, root: str, dry_run: bool = False, encode: Callable[[Any], bytes] | None = None) -> DataFrame:
    """Write each row's content (text or bytes; null is empty) to the file of its name under root; a row of name, change (new, changed or same), bytes and sha256 for each.

    A task writes a draft beside the file and renames it, so a reader sees the old file or the new one, whole; equal files aren't touched. A task that
    runs again, or beside another try of its own, ends with the same files; what an earlier try has written it reports as same. With dry_run nothing is written, and the
    report tells what would be. Files of root that no row names stay. Names are relative paths; one that is null, empty or leads out of root, or that two rows have, is an error before
    anything is written. encode, if given, makes a file's bytes of the content, of any type, where it is written. root is an address that pyarrow's file systems know (file://, hdfs://, s3://, ...).
    """
    rows = df.select(F.col(name).cast("string").alias("name"), (F.col(content) if encode else F.coalesce(F.col(content).cast("binary"), F.lit(b""))).alias("body"))
    bad = F.col("name").isNull() | (F.col("name") == "") | F.col("name").startswith("/") | F.col("name").rlike(r"(^|/)\.\.?(/|$)|//|/$")
    faulty = rows.groupBy("name").agg(F.count("*").alias("n")).where(bad | (F.col("n") > 1)).orderBy("name").first()
    if faulty is not None:
        raise ValueError(f"{faulty['n']} rows for the name {faulty['name']!r}" if faulty["n"] > 1 else f"the name {faulty['name']!r} leads to no file under the root")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        made: set[str] = set()
        for b in batches:
            out = []
            for n, body in ((n.as_py(), body.as_py()) for n, body in zip(b.column("name"), b.column("body"), strict=True)):  # one content at a time
                body = body if encode is None else b"" if body is None else encode(body)
                path = f"{base.rstrip('/')}/{n}"
                there = store.get_file_info(path)
                same = there.type == fs.FileType.File and there.size == len(body) and _read(store, path) == body
                change = "same" if same else "new" if there.type == fs.FileType.NotFound else "changed"
                if not same and not dry_run:
                    folder, _, last = path.rpartition("/")
                    if folder not in made:
                        store.create_dir(folder, recursive=True)
                        made.add(folder)
                    draft = f"{folder}/.{last}.{uuid.uuid4().hex}"
                    with store.open_output_stream(draft) as stream:
                        stream.write(body)
                    store.move(draft, path)
                out.append((n, change, len(body), hashlib.sha256(body).hexdigest()))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)], names=["name", "change", "bytes", "sha256"])

    return written(rows.mapInArrow(put, "name string, change string, bytes long, sha256 string"), "file-report", FILE_ROWS)


def _read(store, path: str) -> bytes:
    with store.open_input_stream(path) as stream:
        return stream.read()


def move_output(spark: SparkSession, made: str, target: str, *scratch: str) -> None:
    """Rename a finished folder to its place and delete scratch folders. A target that is there is an error, and nothing is done; a scratch folder that isn't there is none."""
    (source, store), (place, _) = _path(spark, made), _path(spark, target)
    if store.exists(place):
        raise FileExistsError(target)
    if not store.exists(source):
        raise FileNotFoundError(made)
    store.mkdirs(place.getParent())
    if not store.rename(source, place):
        raise OSError(f"{made} could not be renamed to {target}")
    for folder in scratch:
        gone, its = _path(spark, folder)
        its.delete(gone, True)
