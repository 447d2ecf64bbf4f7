"""State snapshots, run history, stage snapshots and report files."""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..fixed_values import STAGE_NUMBERS
from ..operators.reports import by_score
from ..schemas import RUN_SCHEMA, STATE_SCHEMA


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, target = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def finished_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions of a snapshot table whose write committed."""
    fs, _ = _files(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    names = [n for n in _children(spark, root) if n.startswith("version=")]
    return sorted(int(n.split("=")[1]) for n in names if fs.exists(path(f"{root}/{n}/_SUCCESS")))


def read_state(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """State table at a version, the latest one by default; empty before the first write."""
    versions = finished_versions(spark, root)
    if not versions:
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).parquet(f"{root}/version={version or versions[-1]}")


class VersionConflict(Exception):
    """Another writer took the version that was to follow the one this write started from."""


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _files(spark, path)
    fs.delete(target, True)


def move_new(spark: SparkSession, folder: str, target: str) -> bool:
    """Renames a written folder unless the target is there: the commit that only one of several writers gets.

    One step where the file system renames atomically (HDFS; local folders, as a folder that holds files is never replaced).
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(folder).toUri() if "://" in folder else path(folder).getFileSystem(conf).getUri(), conf)
        context.rename(path(folder), path(target), options)
    except Py4JJavaError:
        fs, there = _files(spark, target)
        if fs.exists(there):
            return False
        raise
    return True


def write_state(state: DataFrame, root: str, base: int | None = None) -> int:
    """Writes the next version; the version being read is never touched, and no two writers get the same version.

    The rows are written to a folder of their own and renamed to `version=N` at the end. With `base`, the version the rows were
    made from, the write fails with `VersionConflict` if another writer has followed that version by now; without it the next
    free number is taken.
    """
    spark = state.sparkSession
    staged = f"{root}/_staged-{uuid.uuid4().hex}"
    state.write.parquet(staged)
    version = (max(finished_versions(spark, root), default=0) if base is None else base) + 1
    while not move_new(spark, staged, f"{root}/version={version}"):
        if base is not None:
            _delete(spark, staged)
            raise VersionConflict(f"version {version} is taken")
        version += 1
    return version


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run history, latest run first."""
    if not _children(spark, path):
        return spark.createDataFrame([], RUN_SCHEMA)
    return latest_first(spark.read.schema(RUN_SCHEMA).option("recursiveFileLookup", True).parquet(path))


def latest_first(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.col("run_date").desc(), F.col("id").desc())


def append_run(spark: SparkSession, path: str, **values) -> int:
    """Adds one run and gives its id; counts default to 0, texts to ''. Runs that end at once get ids of their own."""
    last = read_runs(spark, path).agg(F.max("id")).first()[0] or 0
    row = {f.name: "" if f.dataType.simpleString() == "string" else 0 for f in RUN_SCHEMA}
    row |= {"avg_score": 0.0, "run_date": dt.datetime.now()} | values
    while True:
        last += 1
        row["id"] = values.get("id", last)
        staged = f"{path}/_staged-{uuid.uuid4().hex}"
        spark.createDataFrame([tuple(row[f.name] for f in RUN_SCHEMA)], RUN_SCHEMA).coalesce(1).write.parquet(staged)
        if move_new(spark, staged, f"{path}/run-{row['id']:012d}"):
            return row["id"]
        _delete(spark, staged)
        if "id" in values:
            raise VersionConflict(f"run {row['id']} is taken")


def stage_folder(run_folder: str, stage: str) -> str:
    return f"{run_folder}/stage={STAGE_NUMBERS.get(stage, '99')}_{stage}"


def stage_table(rows: DataFrame, stage: str, credits_used: int = 0, at: dt.datetime | None = None) -> DataFrame:
    """Stage rows with their stage, number, time and credits as columns."""
    return rows.withColumns({
        "module": F.lit(stage),
        "stage_no": F.lit(STAGE_NUMBERS.get(stage, "99")),
        "ts": F.lit(at or dt.datetime.now()),
        "credits_used": F.lit(credits_used),
    })


def write_stage(rows: DataFrame, run_folder: str, stage: str, credits_used: int = 0) -> None:
    stage_table(rows, stage, credits_used).write.mode("overwrite").parquet(stage_folder(run_folder, stage))


def read_stage(spark: SparkSession, run_folder: str, stage: str) -> DataFrame:
    return spark.read.parquet(stage_folder(run_folder, stage)).drop("module", "stage_no", "ts", "credits_used")


def read_all_stages(spark: SparkSession, run_folder: str) -> DataFrame:
    """Union of all stages of a run, in stage order."""
    return in_stage_order(spark.read.option("basePath", run_folder).parquet(run_folder).drop("stage"))


def in_stage_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy("stage_no", "module", "seq")


def write_report(rows: DataFrame, path: str) -> None:
    """CSV with header, best score first; an empty report has no header. Sorted parts keep their order by name."""
    data = by_score(rows)
    header = not rows.isEmpty()
    data.write.mode("overwrite").option("header", header).option("escape", '"').csv(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A written report, all columns as text; values may hold line breaks."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def in_written_order(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a written parquet report with `position`: 1 for the first row of the first file by name."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))  # one row a file
    start = F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.withColumn("_start", F.coalesce(start, F.lit(0))).drop("_n")
    told = rows.join(F.broadcast(starts), "_file")
    return told.withColumn("position", F.col("_start") + F.col("_row") + 1).drop("_file", "_row", "_start")
