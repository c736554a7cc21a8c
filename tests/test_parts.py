"""Pipeline parts: parameters that save and load, runs that resume by themselves."""

import json

import pytest
from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import functions as F

from frameloom.operators import images
from frameloom.plans import parts
from frameloom.plans.stages import one_of_each

BOXES = [(0, "l1", (0, 0, 8, 3), 8, 8), (1, "l2", (0, 5, 8, 3), 8, 8)]


@pytest.fixture
def frames(spark):
    rows = [(i % 2, i, f"f{i}.png", 8, 8, bytearray(((i // 6 * 60 + j * (i // 3 % 2) * 3) % 256 for j in range(192)))) for i in range(24)]
    return spark.createDataFrame(rows, "issue_id int, frame_idx int, name string, height int, width int, bgr binary")


class Counted(parts._Stage):
    """Adds a number to frame_idx; tells the test that it ran, and fails when asked to."""

    ran: list = []
    fail = False
    by = parts.Param(parts.Params._dummy(), "by", "the number", parts.TypeConverters.toInt)
    defaults = {"by": 1}

    def _transform(self, dataset):
        Counted.ran.append(self.of(self.by))
        if Counted.fail:
            raise RuntimeError("stopped")
        return dataset.withColumn("frame_idx", F.col("frame_idx") + self.of(self.by))


def test_parameters_save_and_load(spark, frames, tmp_path):
    boxes = spark.createDataFrame(BOXES, parts.BOX_SCHEMA)
    told = parts.boxes_json(boxes)
    assert [tuple(r) for r in parts.KeepComplete(boxes=told).regions(spark).collect()] == [tuple(r) for r in boxes.collect()]
    model = PipelineModel([parts.KeepBright(most=0.9), parts.OneOfEach(least=0.5), parts.GroupColours(boxes=told)])
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert [type(s).__name__ for s in loaded.stages] == ["KeepBright", "OneOfEach", "GroupColours"] and loaded.stages[0].of(loaded.stages[0].most) == 0.9
    key = lambda d: sorted((r["issue_id"], r["frame_idx"], r["cluster_id"], r["theme"]) for r in d.collect())
    assert key(loaded.transform(frames)) == key(model.transform(frames)) != []
    single = parts.OneOfEach(least=0.5)
    single.write().overwrite().save(str(tmp_path / "stage"))
    assert sorted(r["frame_idx"] for r in parts.OneOfEach.load(str(tmp_path / "stage")).transform(frames).collect()) == sorted(r["frame_idx"] for r in one_of_each(frames, 0.5).collect())
    bright = parts.KeepBright()
    assert bright.of(bright.most) == parts.scoring.DARK_KEEP and isinstance(single, Transformer)


def test_stages_are_those_of_the_operators(spark, frames):
    boxes = spark.createDataFrame(BOXES, parts.BOX_SCHEMA)
    kept = parts.KeepComplete(boxes=parts.boxes_json(boxes), most=0.5).transform(frames)
    assert sorted(r["frame_idx"] for r in kept.collect()) == sorted(r["frame_idx"] for r in images.good_frames(frames, images.line_scores(frames, boxes), 0.5).collect())
    themed = frames.withColumns({"cluster_id": F.lit(0), "theme": F.lit("blue")})
    cells = spark.createDataFrame([("blue", 0, "rank", (0, 0, 4, 4), 8, 8)], f"theme string, {parts.BOX_SCHEMA}")
    assert parts.TakeCells(boxes=parts.boxes_json(cells)).transform(themed).count() == 24


def test_a_stopped_run_goes_on_after_its_last_stage(spark, frames, tmp_path):
    run, stages = parts.Run(spark, f"file://{tmp_path}/run"), [parts.OneOfEach(least=0.5), Counted(by=10), Counted(by=100), Counted(by=1000)]
    Counted.ran, before = [], stages[2]._transform
    stages[2]._transform = lambda d: (_ for _ in ()).throw(RuntimeError("killed"))
    with pytest.raises(RuntimeError, match="killed"):
        run.run(stages, frames)
    assert Counted.ran == [10] and [r["name"] for r in run.manifest()] == ["OneOfEach", "Counted"]
    stages[2]._transform = before
    (tmp_path / "run" / "02_Counted-half").mkdir()  # what a killed task may leave
    Counted.ran = []
    out = run.run(stages, frames)
    assert Counted.ran == [100, 1000]
    want = sorted(r["frame_idx"] + 1110 for r in one_of_each(frames, 0.5).collect())
    assert sorted(r["frame_idx"] for r in out.collect()) == want
    Counted.ran = []
    assert sorted(r["frame_idx"] for r in run.run(stages, frames.repartition(5)).collect()) == want and Counted.ran == []  # the same rows in another order


def test_changed_parameters_and_input_run_again(spark, frames, tmp_path):
    run = parts.Run(spark, f"file://{tmp_path}/run")
    ask = lambda numbers, source, **more: sorted(r["frame_idx"] for r in run.run([Counted(by=n) for n in numbers], source, **more).collect())[0]
    Counted.ran = []
    assert ask([1, 2, 3], frames) == 6 and Counted.ran == [1, 2, 3]
    tables = {p.name for p in (tmp_path / "run").iterdir() if p.is_dir()}
    Counted.ran = []
    assert ask([1, 5, 3], frames) == 9 and Counted.ran == [5, 3]
    now = {p.name for p in (tmp_path / "run").iterdir() if p.is_dir()}
    assert len(now) == 3 and len(now & tables) == 1  # the tables that no manifest names are gone
    Counted.ran = []
    assert ask([1, 5], frames) == 6 and ask([1, 5, 3, 7], frames) == 16 and Counted.ran == [7] or Counted.ran == [3, 7]
    Counted.ran = []
    assert ask([1], frames.where("frame_idx > 3")) == 5 and Counted.ran == [1]
    Counted.ran = []
    assert ask([1], frames, source_digest="v1") == 1 and ask([1], frames.limit(0).unionByName(frames), source_digest="v1") == 1 and Counted.ran == [1]
    assert json.loads((tmp_path / "run/manifest.json").read_text()) == run.manifest()


def test_digests_tell_rows_apart(spark, frames):
    assert parts.digest_of_rows(frames) == parts.digest_of_rows(frames.repartition(7).select(*reversed(frames.columns)).select(*frames.columns))
    others = [frames.limit(23), frames.unionByName(frames.limit(1)), frames.withColumnRenamed("name", "n"), frames.withColumn("height", F.lit(9)), frames.limit(0)]
    assert len({parts.digest_of_rows(d) for d in [frames, *others]}) == 6
