"""Sharding by size-tiered compaction: immutable shards under a versioned manifest. DataFrame operations only."""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from frameloom.llm.util import new_path, table, text_of

#: Runs of a tier that are merged together, bytes of the smallest tier, and of the files that a merge writes (about).
FAN_IN, TIER_BYTES, TARGET_BYTES = 4, 1 << 20, 64 << 20
#: Arrivals into which the query deals its table.
ARRIVALS = 8


class ShardStore:
    """A table as runs of Parquet files. A run is one arrival or one merge; a manifest of each version names the runs.

    A version is committed by renaming a finished manifest to a name that must not exist, so that readers see
    one version or the next and of two writers one has to try again. That needs a store in which renaming to a name that is taken fails
    (HDFS, local files); object stores whose rename copies need a committer that writes if absent. Files that no manifest names (of a writer
    that was lost) are never read. Only file names and sizes pass through the driver.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, fan_in: int = FAN_IN, target_bytes: int = TARGET_BYTES):
        self.spark, self.path, self.schema, self.fan_in, self.target = spark, path.rstrip("/"), schema, fan_in, target_bytes
        jvm = spark.sparkContext._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self._at = lambda name: self._hadoop.Path(f"{self.path}/{name}")
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._at("").getFileSystem(conf)
        self._context = self._hadoop.FileContext.getFileContext(self._at("").toUri(), conf)
        self._files.mkdirs(self._at("manifests"))

    def _list(self, folder: str, end: str) -> list[tuple[str, int]]:
        if not self._files.exists(self._at(folder)):
            return []
        return sorted((s.getPath().getName(), s.getLen()) for s in self._files.listStatus(self._at(folder)) if s.getPath().getName().endswith(end))

    def version(self) -> int:
        return max((int(n[1:-5]) for n, _ in self._list("manifests", ".json") if n.startswith("v")), default=0)

    def manifest(self, version: int | None = None) -> list[dict]:
        """The runs of a version, the latest if none is given: name, files, bytes, tier."""
        version = self.version() if version is None else version
        if not version:
            return []
        stream = self._files.open(self._at(f"manifests/v{version:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))["runs"]
        finally:
            stream.close()

    def _commit(self, change: Callable[[list[dict]], list[dict] | None]) -> bool:
        """Apply change to the latest runs, again if another writer was first; change returns None to give up."""
        while True:
            version = self.version()
            if (runs := change(self.manifest(version))) is None:
                return False
            draft = self._at(f"manifests/_draft-{uuid.uuid4().hex}")
            stream = self._files.create(draft, False)
            try:
                stream.write(bytearray(json.dumps({"version": version + 1, "runs": runs}).encode("utf-8")))
            finally:
                stream.close()
            try:
                none = self.spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 0)
                self._context.rename(draft, self._at(f"manifests/v{version + 1:012d}.json"), none)
                return True
            except Exception as e:
                self._files.delete(draft, False)
                if "FileAlreadyExists" not in str(e):
                    raise

    def _run(self, folder: str) -> dict | None:
        files = self._list(folder, ".parquet")
        size = sum(n for _, n in files)
        return {"name": folder, "files": [f"{folder}/{n}" for n, _ in files], "bytes": size, "tier": self.tier(size)} if files else None

    def tier(self, size: int) -> int:
        return max(0, math.floor(math.log(max(size, 1) / TIER_BYTES, self.fan_in) + 1e-9)) if size > TIER_BYTES else 0

    def append(self, df: DataFrame, arrival: Column | None = None) -> int:
        """Add df's rows as a run, or as one for each value of arrival, written in one pass; the runs added.

        Nulls, empty and very long texts and repeated rows are kept as they are; columns that the schema doesn't name are left out, and the schema's
        may have any names. No row adds no run and no version.
        """
        name = f"runs/{uuid.uuid4().hex}"
        rows = df.select(*(df[f"`{f.name}`"] for f in self.schema.fields), *([] if arrival is None else [arrival.alias(mark := self._free_name())]))
        (rows.write if arrival is None else rows.write.partitionBy(mark)).parquet(f"{self.path}/{name}")
        if self.spark.read.schema(self.schema).parquet(f"{self.path}/{name}").isEmpty():
            self._files.delete(self._at(name), True)
            return 0
        folders = [name] if arrival is None else [f"{name}/{s.getPath().getName()}" for s in self._files.listStatus(self._at(name)) if s.isDirectory()]
        runs = [r for r in map(self._run, sorted(folders)) if r]
        if runs:
            self._commit(lambda old: old + runs)
        return len(runs)

    def _free_name(self) -> str:
        """A name for the arrivals' column that no column of the schema has, whatever its case."""
        taken = {f.name.lower() for f in self.schema.fields}
        return next(n for n in (f"arrival_{k}" for k in range(len(taken) + 1)) if n not in taken)

    def _load(self, runs: list[dict]) -> DataFrame:
        files = [f"{self.path}/{f}" for r in runs for f in r["files"]]
        return self.spark.read.schema(self.schema).parquet(*files) if files else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, the latest if none is given."""
        return self._load(self.manifest(version))

    def compact(self) -> int:
        """Merge while a tier has fan_in runs; the merges made.

        A merge reads the runs of one tier and writes files of about the target size. It keeps Spark's reading
        partitions together (coalesce), so nothing is shuffled. If another writer took one of the runs, the
        merge is thrown away. A merge takes fan_in runs, the smallest first.
        """
        merges = 0
        while True:
            tiers: dict[int, list[dict]] = {}
            for run in self.manifest():
                tiers.setdefault(run["tier"], []).append(run)
            full = [t for t in sorted(tiers) if len(tiers[t]) >= self.fan_in]
            if not full:
                return merges
            inputs = sorted(tiers[full[0]], key=lambda r: (r["bytes"], r["name"]))[: self.fan_in]
            size, name = sum(r["bytes"] for r in inputs), f"runs/{uuid.uuid4().hex}"
            self._load(inputs).coalesce(max(1, math.ceil(size / self.target))).write.parquet(f"{self.path}/{name}")
            made, gone = self._run(name), {r["name"] for r in inputs}
            made["tier"] = max(made["tier"], full[0] + 1)  # compression may gain what would hold it back

            def change(old: list[dict], made: dict = made, gone: set = gone) -> list[dict] | None:
                return [r for r in old if r["name"] not in gone] + [made] if gone <= {r["name"] for r in old} else None

            if self._commit(change):
                merges += 1
            else:
                self._files.delete(self._at(name), True)

    def vacuum(self, grace_seconds: float = 0, orphans_after: float = 7 * 86_400) -> int:
        """Delete the runs that no manifest within the grace names, then the older manifests; the runs deleted.

        A version is older if a later one has been there for grace_seconds, so that readers have so long to end. Files that no manifest has ever named are
        of a writer that was lost, or of one at work: they go once they are orphans_after seconds old.
        """
        now, version = time.time(), self.version()
        made = {int(n[1:-5]): self._files.getFileStatus(self._at(f"manifests/{n}")).getModificationTime() / 1000 for n, _ in self._list("manifests", ".json") if n.startswith("v")}
        older = [v for v in made if v < version and now - made.get(v + 1, now) >= grace_seconds]
        kept = {r["name"] for v in made if v not in older for r in self.manifest(v)}
        gone = {r["name"] for v in older for r in self.manifest(v)} - kept
        named = {n.split("/")[1] for n in kept | gone}
        if self._files.exists(self._at("runs")):
            gone |= {f"runs/{s.getPath().getName()}" for s in self._files.listStatus(self._at("runs")) if s.getPath().getName() not in named and now - s.getModificationTime() / 1000 >= orphans_after}
        for name in gone:
            self._files.delete(self._at(name), True)
        for v in older:
            self._files.delete(self._at(f"manifests/v{v:012d}.json"), False)
        return len(gone)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, dealt into arrivals, appended, compacted and read back through the manifest."""
    docs = table(spark, sf_dir, "documents")
    store = ShardStore(spark, new_path(spark, "shards"), docs.schema)
    store.append(docs, F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS)))
    store.compact()
    store.vacuum()
    text = text_of(F.col("text"))
    return store.read().select("doc_id", "lang", "source", "n_chars", F.length(text.cast("binary")).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("text_sha256"))


OP4_SQL = """
SELECT doc_id, lang, source, n_chars, octet_length(encode(coalesce(text, ''))) AS n_bytes, sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
