"""Pieces that several corpus operators share."""

from __future__ import annotations

import contextlib
import math
import re
import tempfile
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A table of at most this many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 200_000
#: Rows that one task ranks, on average.
RANK_ROWS = 20_000

_own_dirs: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it. Only a local session, as in tests, may leave it unnamed."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="tidewatch-")
    return _own_dirs[app]


def _files(spark: SparkSession) -> int:
    return 2 * spark.sparkContext.defaultParallelism


def fewer_files(df: DataFrame) -> DataFrame:
    """The narrow results of a heavy stage, dealt evenly to two files for each core; the stage itself keeps its width."""
    return df.repartition(_files(df.sparkSession))


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def cut(df: DataFrame, what: str, narrow: bool = True) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: what follows neither repeats its work nor depends on an executor.

    Narrow rows would make tiny files, so a shuffle deals them to a few. What ``discard`` doesn't delete goes when the
    session ends.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{what}-{uuid.uuid4().hex}"
    (fewer_files(df) if narrow else df).write.parquet(path)
    fs, where = _located(spark, path)
    fs.deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Send batches of at most ``rows`` rows to Python in the jobs that run inside; the session's setting comes back after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(*frames: DataFrame) -> None:
    """Delete the files behind frames that ``cut`` returned, once nothing reads them any more."""
    for df in frames:
        fs, where = _located(df.sparkSession, df.__dict__["_cut_path"])
        fs.delete(where, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are within BROADCAST_ROWS."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def text_of(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: as a column, the optimiser may put it into every step of a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Stands for a null id, which so comes before all others.
NO_ID = -(1 << 63)


def known_id(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))


def id_again(column: str) -> Column:
    """The id with null where it was null, under its name."""
    return F.nullif(F.col(column), F.lit(NO_ID)).alias(column)


def order_key(*cols: str | Column) -> Column:
    """A hex key that spreads rows evenly whatever their ids are."""
    return F.md5(F.concat_ws(":", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]).cast("binary"))


def ranked(df: DataFrame, by: Sequence[str], key: str, ties: Sequence[str], out: str, n_rows: int) -> DataFrame:
    """Number the rows of each ``by`` group from 0, gapless, in the order of ``key`` then ``ties``.

    ``key`` is a hex digest, so its leading digits split every group into even slices: slices are counted, the counts
    are summed up before each slice, and only within a slice is there a sort. ``df`` is read twice.
    """
    digits = max(1, math.ceil(math.log(max(n_rows, 1) / RANK_ROWS, 16))) if n_rows > RANK_ROWS else 1
    sliced = df.withColumn("_slice", F.substring(key, 1, digits))
    group = [*by, "_slice"]
    counts = cut(sliced.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")), "slices")
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*group).orderBy(key, *ties)
    return (
        sliced.join(small(starts, counts.count()), group)
        .withColumn(out, F.col("_start") + F.row_number().over(within) - 1)
        .drop("_slice", "_start")
    )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of every node that is not the smallest of its component, for the links a-b."""
    if len(a) == 0:
        return a.astype(np.int64), b.astype(np.int64)
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[i], root[j]
        low, high = np.minimum(x, y), np.maximum(x, y)
        new = root.copy()
        np.minimum.at(new, high, low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        if np.array_equal(new, root):
            break
        root = new
    rest = root != np.arange(len(nodes))
    return nodes[rest], nodes[root[rest]]


def _local_forest(batches):
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        a = np.concatenate([a, batch.column(0).to_numpy(zero_copy_only=False)])
        b = np.concatenate([b, batch.column(1).to_numpy(zero_copy_only=False)])
        if len(a) > 1_000_000:
            a, b = forest(a, b)
    a, b = forest(a, b)
    for s in range(0, len(a), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(a[s : s + 50_000]), pa.array(b[s : s + 50_000])], names=["node", "root"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link, root being the smallest node it reaches; roots themselves have no row.

    ``links`` has two long columns. Each round links the nodes of every node to the least of them and follows the
    pointers one step; the rounds grow with the logarithm of the longest chain. Rounds are cut off in the shared folder.
    """
    a, b = links.columns[:2]
    edges = links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).where("node <> root").repartition("node")
    read: list[DataFrame] = []
    while True:
        stars = cut(edges.mapInArrow(_local_forest, "node long, root long"), "stars")
        discard(*read)
        least = cut(stars.groupBy("node").agg(F.min("root").alias("m"), F.max("root").alias("most")), "least")
        hop = least.select(F.col("node").alias("m"), F.col("m").alias("mm"))
        jumped = cut(
            least.join(hop, "m", "left").select("node", F.coalesce("mm", "m").alias("m"), (F.col("m") < F.col("most")).alias("forked"), F.col("mm").isNotNull().alias("moved")),
            "jumped",
        )
        discard(least)
        state = jumped.agg(F.max("forked").alias("forked"), F.max("moved").alias("moved")).first()
        if not state["forked"] and not state["moved"]:
            discard(stars)
            return jumped.select("node", F.col("m").alias("root"))
        read = [stars, jumped]
        pointers = jumped.select("node", "m")
        edges = pointers.toDF("node", "root")
        if state["forked"]:
            more = stars.join(pointers, "node").where("root <> m").select(F.greatest("root", "m").alias("node"), F.least("root", "m").alias("root"))
            edges = edges.unionByName(more).distinct()
