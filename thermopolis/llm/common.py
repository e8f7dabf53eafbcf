"""What several operators share: cutting lineage, graph components, Arrow batches in pieces."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Rows go to Python in batches of so many bytes, a larger row alone.
ARROW_BYTES = 8 << 20
#: A long text is split into words by slices of so many bytes.
SLICE = 1 << 20


def shared_folder(spark) -> str:
    """The folder that driver and executors share; the session must name it."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get(CHECKPOINT_KEY, None)
    if not folder:
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Compute a narrow ``df`` once into the shared checkpoint folder and go on from there.

    Unlike cached rows it outlives executors. Only tables of a few numbers a row pass through here.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def scratch(spark, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"


def remove(spark, folder: str) -> None:
    """Delete a folder that ``scratch`` named, in whatever store it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def put_file(spark, path: str, content: bytes) -> str:
    """Ship a small file to every executor; its name there, for ``SparkFiles.get``."""
    jvm, target = spark.sparkContext._jvm, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(content))
    stream.close()
    spark.sparkContext.addFile(path)
    return jvm.org.apache.hadoop.fs.Path(path).getName()


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Return the memory that this process has freed to the machine."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def lean(step: Step) -> Step:
    """``step`` for mapInArrow, after which the Python worker gives its freed memory back.

    Workers outlive their tasks; what they keep adds to the next stage's memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        give_back()

    return run


def map_arrow(df: DataFrame, step: Step, schema) -> DataFrame:
    """``df.mapInArrow(lean(step), schema)`` with batches of about ARROW_BYTES at most, bounded by Spark
    before they reach Python. The session keeps that setting, which changes no result."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return df.mapInArrow(lean(step), schema)


def pieces(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of one string column, a longer row alone."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        start = total = 0
        for row, size in enumerate(sizes):
            if row > start and total + (size or 0) > limit:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size or 0
        if start < len(sizes):
            yield batch.slice(start)


def split_words(text: bytes) -> Iterator[list[bytes]]:
    """A text's words, runs without ASCII white space, in lists of bounded size."""
    at = 0
    while at < len(text):
        end = min(at + SLICE, len(text))
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        yield text[at:end].split()
        at = end


def gathered(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some ``limit`` bytes of one string column: small batches together, large
    ones in pieces. What has been handed on is not held here."""
    held, size = [], 0

    def together() -> pa.RecordBatch:
        whole = held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        held.clear()
        return whole

    for batch in pieces(batches, column, limit):
        if held and size + batch.column(column).nbytes > limit:
            size = 0
            yield together()
        held.append(batch)
        size += batch.column(column).nbytes
    if held:
        yield together()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node reached.

    Alternating large and small stars. Minima are aggregates with map-side combine and reach the
    edges by joins, so a node that holds a third of all edges is neither a group of one task nor a
    list. Rounds grow with the logarithm of a component's diameter; each ends in the shared folder.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one parent at most and no parent has one itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("below")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("below"))
    )
    odd = ends.groupBy("node").agg(F.sum("below").alias("parents"), F.min("below").alias("least"))
    return odd.where("parents > 1 or (parents = 1 and least = 0)").isEmpty()
