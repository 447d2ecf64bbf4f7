"""Session helpers: builder for local use, lineage cuts and hot-key handling."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A key holding more than 1/HOT_PARTS of all rows is hot; there are at most HOT_PARTS such keys.
HOT_PARTS = 1000
# Inputs of at most this many rows take the plain way.
PLAIN_ROWS = 100_000
# Ranges for numbering rows: one for so many rows, within these limits.
RANGE_ROWS, LEAST_RANGES, MOST_RANGES = 5_000_000, 16, 2_000


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, **extra) -> SparkSession:
    """Session for one machine; on a cluster the submitted configuration rules."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("leadweave")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: `spark.checkpoint.dir` of the session.

    Only a local master may fall back to a folder of its own; on a cluster a
    machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("leadweave.work.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can read")
    folder = tempfile.mkdtemp(prefix="leadweave-")
    spark.conf.set("leadweave.work.dir", folder)
    return folder


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage of iterative plans: lost executors re-read files instead of
    replaying every earlier round, and the plan stays short.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"
    written = _temporary.get()
    if written is not None:
        written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Folders of the tables that `cut` writes inside `temporary_tables`.
_temporary: ContextVar[list[str] | None] = ContextVar("temporary", default=None)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the tables that `cut` wrote inside: for steps whose results are written or collected by then."""
    token = _temporary.set([])
    try:
        yield
    finally:
        for path in _temporary.get():
            _delete(spark, path)
        _temporary.reset(token)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*tables: DataFrame) -> None:
    """Deletes tables written by `cut` that nothing reads any more."""
    for table in tables:
        for file in table.inputFiles()[:1]:  # all files of such a table lie in its folder
            _delete(table.sparkSession, file.rsplit("/", 1)[0])


def row_order(df: DataFrame, order_col: str, out: str, start: int = 0) -> DataFrame:
    """Consecutive numbers start+1, start+2, ... by a unique `order_col`, without one global window.

    Rows are cut into ranges of `order_col` at sampled quantiles; each range is numbered on its own
    and shifted by the number of rows in the ranges before it.
    """
    ranges = min(MOST_RANGES, max(LEAST_RANGES, df.count() // RANGE_ROWS))
    quantiles = F.percentile_approx(order_col, [i / ranges for i in range(1, ranges)], 10 * ranges)
    cuts = sorted(set(df.agg(quantiles.alias("q")).first()["q"] or []))
    points = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    part = F.size(F.filter(points, lambda c: c < F.col(order_col)))
    marked = df.withColumn("_part", part.cast("int"))
    counts = {r["_part"]: r["count"] for r in marked.groupBy("_part").count().collect()}  # at most RANGES rows
    shift, total = [], start
    for i in range(len(cuts) + 1):
        shift.append(total)
        total += counts.get(i, 0)
    within = F.row_number().over(Window.partitionBy("_part").orderBy(order_col))
    base = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in shift]), F.col("_part") + 1)
    return marked.withColumn(out, (base + within).cast("bigint")).drop("_part")


def lookup(rows: DataFrame, table: DataFrame, key: str, counts: DataFrame, total: int, plain: int | None = None) -> DataFrame:
    """Left join `rows` to `table` (one row per key) where some keys may hold a large share of `rows`.

    `counts` has columns (key, n): rows per key. Keys with more than total/HOT_PARTS rows number at
    most HOT_PARTS, so their entries are broadcast; all other keys take the ordinary shuffle join, as do all keys of up to
    `plain` rows (PLAIN_ROWS by default).
    """
    if total <= (PLAIN_ROWS if plain is None else plain):
        return rows.join(table, key, "left")
    hot_keys = counts.filter(F.col("n") > F.lit(total // HOT_PARTS)).select(key)
    hot = F.broadcast(hot_keys.join(table, key, "left").withColumn("_hot", F.lit(True)))  # hot keys without an entry too
    value_columns = [c for c in table.columns if c != key]
    tagged = rows.join(hot.select(key, F.struct(*value_columns).alias("_hit"), "_hot"), key, "left")
    done = tagged.filter("_hot").select(*[c for c in rows.columns], *[F.col(f"_hit.{c}") for c in value_columns])
    rest = tagged.filter("_hot IS NULL").drop("_hot", "_hit").join(table, key, "left")
    return done.unionByName(rest)
