"""The frame pipeline's stages as pyspark.ml transformers, and runs that resume by themselves.

A stage's parameters save and load with it, alone or in a PipelineModel. A run keeps a manifest beside its tables: which stage, of which parameters, on which
input wrote which table. A run that was stopped goes on after the last stage that ended; a changed parameter or input runs what comes after it again.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions import scoring
from frameloom.operators import images
from frameloom.plans.stages import grouped_frames, one_of_each
from frameloom.sources.scratch import _path, drop_path

BOX_SCHEMA = "pos int, name string, box struct<x:int,y:int,w:int,h:int>, ref_width int, ref_height int"


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer whose parameters may be given by name."""

    def __init__(self, **given):
        super().__init__()
        self._setDefault(**self.defaults)
        self._set(**given)

    defaults: dict = {}

    def of(self, param: Param):
        return self.getOrDefault(param)


class _Boxed(_Stage):
    boxes = Param(Params._dummy(), "boxes", "a region config as JSON: [pos, name, [x, y, w, h], width, height] for each box", TypeConverters.toString)

    def regions(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(p, n, tuple(b), w, h) for p, n, b, w, h in json.loads(self.of(self.boxes))], BOX_SCHEMA)


def boxes_json(boxes: DataFrame) -> str:
    """A region config (as read_roi gives it: a few boxes of a file) as the parameter boxes; with a theme before them, if it has one."""
    themed = ["theme"] if "theme" in boxes.columns else []
    rows = boxes.select(*themed, "pos", "name", F.array("box.x", "box.y", "box.w", "box.h").alias("b"), "ref_width", "ref_height").orderBy(*themed, "pos").collect()
    return json.dumps([list(r) for r in rows], ensure_ascii=False)


class Standardise(_Stage):
    """Each frame's title, turned, beside its statistics."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return images.standardise(dataset)


class KeepBright(_Stage):
    """Frames whose darkness costs at most so much."""

    most = Param(Params._dummy(), "most", "the greatest cost that stays", TypeConverters.toFloat)
    defaults = {"most": scoring.DARK_KEEP}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return images.good_frames(dataset, images.dark_scores(dataset), self.of(self.most))


class KeepComplete(_Boxed):
    """Frames none of whose lines is missing."""

    most = Param(Params._dummy(), "most", "the greatest cost that stays", TypeConverters.toFloat)
    defaults = {"most": scoring.LINE_KEEP}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return images.good_frames(dataset, images.line_scores(dataset, self.regions(dataset.sparkSession)), self.of(self.most))


class OneOfEach(_Stage):
    """One frame of each run of like ones."""

    least = Param(Params._dummy(), "least", "the least likeness of frames of a run", TypeConverters.toFloat)
    defaults = {"least": scoring.SAME_KEEP}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return one_of_each(dataset, self.of(self.least))


class GroupColours(_Boxed):
    """Frames with the colour cluster and theme of their issue's groups."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return grouped_frames(dataset, self.regions(dataset.sparkSession))


class TakeCells(_Boxed):
    """The cells of frames with a theme; boxes have their theme first."""

    def regions(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(t, p, n, tuple(b), w, h) for t, p, n, b, w, h in json.loads(self.of(self.boxes))], f"theme string, {BOX_SCHEMA}")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return images.take_cells(dataset, self.regions(dataset.sparkSession))


def digest_of_rows(df: DataFrame) -> str:
    """A digest of a table's rows and schema, whatever their order: their number and two sums of 64-bit hashes."""
    by_name = [F.col(f"`{c}`") for c in sorted(df.columns)]
    row = df.select(F.xxhash64(*by_name).alias("a"), F.xxhash64(F.lit("again"), *by_name).alias("b")).agg(
        F.count("*"), *(F.sum(F.col(c).cast("decimal(38,0)")).cast("string") for c in ("a", "b"))
    ).first()
    return hashlib.sha256(json.dumps([df.schema.simpleString(), *row]).encode()).hexdigest()


def stage_digest(stage: Transformer, before: str) -> str:
    """What a stage's table depends on: its kind, its parameters, and what its input depends on."""
    told = {p.name: stage.getOrDefault(p) for p in stage.params if stage.isDefined(p)}
    return hashlib.sha256(json.dumps([type(stage).__module__, type(stage).__name__, told, before], sort_keys=True, default=str, ensure_ascii=False).encode()).hexdigest()


class Run:
    """A run of stages under a folder of the shared store: its manifest, and a table for each stage that has ended."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def manifest(self) -> list[dict]:
        """The stages that have ended: name, digest, table."""
        where, store = _path(self.spark, f"{self.path}/manifest.json")
        if not store.exists(where):
            return []
        return json.loads("\n".join(r["value"] for r in self.spark.read.text(f"{self.path}/manifest.json").collect()))

    def _commit(self, ended: list[dict]) -> None:
        """Replace the manifest by a rename, so that a reader sees the old one or the new one."""
        draft, store = _path(self.spark, f"{self.path}/_manifest-{uuid.uuid4().hex}")
        stream = store.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(ended, ensure_ascii=False).encode("utf-8")))
        finally:
            stream.close()
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(draft.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()) if draft.toUri().getScheme() else hadoop.FileContext.getFileContext(self.spark.sparkContext._jsc.hadoopConfiguration())
        over = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        over[0] = hadoop.Options.Rename.OVERWRITE
        context.rename(draft, hadoop.Path(f"{self.path}/manifest.json"), over)

    def run(self, stages: list[Transformer], source: DataFrame, source_digest: str | None = None) -> DataFrame:
        """The last stage's table. Stages whose table the manifest has, from the first on, for the same parameters and input, aren't run again.

        source_digest: a name for the input's state, such as its version; its rows are hashed if none is given. A table is written under a name of its own and
        named in the manifest when it is whole, so a killed run leaves nothing that is read; tables that the manifest no longer names are deleted.
        """
        before, ended, known, df = source_digest or digest_of_rows(source), [], self.manifest(), source
        for k, stage in enumerate(stages):
            before = stage_digest(stage, before)
            old = known[k] if k < len(known) and len(ended) == k else None
            if old and old["digest"] == before:
                ended.append(old)
            else:
                name = type(stage).__name__
                table = f"{k:02d}_{name}-{uuid.uuid4().hex}"
                stage.transform(df).write.parquet(f"{self.path}/{table}")
                ended.append({"name": name, "digest": before, "table": table})
                self._commit(ended)
                for gone in {r["table"] for r in known[k:]}:
                    drop_path(self.spark, f"{self.path}/{gone}")
                known = list(ended)
            df = self.spark.read.parquet(f"{self.path}/{ended[-1]['table']}")
        return df
