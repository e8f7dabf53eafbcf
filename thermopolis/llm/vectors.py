"""Embedding near-duplicates: sorted projection passes find the groups, tiles inside each count its links."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopolis.llm.common import components, lean, materialize

MIN_COSINE = 0.93
#: Passes for each doubling of the largest label's different vectors, and the least number of them.
PASSES = 2
LEAST_PASSES = 16
#: Each vector meets so many that follow it in the order of a pass.
WINDOW = 64
HASHES = 64
SEED = 8
#: Rows compared at a time.
STEP = 4096
#: A group of more vectors is counted tile by tile, each pair of tiles apart: tiles of so many vectors
#: until there are so many tiles, larger ones beyond.
TILE = 1024
TILES = 8
#: Vectors and components of a tile at most.
TILE_ROWS = 8192
TILE_VALUES = 1 << 20
#: Rows of all passes, or of all tiles, in one partition.
PARTITION_ROWS = 50_000
#: Cosines at a time.
STEP_VALUES = 1 << 22

SORTED = ["pass", "label", "dim", "code", "node"]
GROUP = ["component", "dim", "low", "high"]


def near_duplicates(
    vectors: DataFrame,
    min_cosine: float = MIN_COSINE,
    window: int = WINDOW,
    tile: int = TILE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row for each row of ``vectors``: the id, ``n_links``, ``component_id`` and ``kept``.

    Vectors of one label link at a cosine of ``min_cosine`` in double precision. Equal vectors become
    one node first, with the number of its copies. In each pass a node's code is the concatenation of
    64 random hyperplane hashes; nodes are sorted by label and code over the whole cluster, and each
    is compared with its ``window`` successors, across the borders of partitions too. The verified pairs
    of all passes are united. Passes grow with the logarithm of the largest label.

    A window ends before a large group does, so links are not counted there: inside each group that the
    passes have united, all pairs are compared, tile by tile, and only counts are emitted. So a group of
    any size has all of its links, and a link is missed only if no pass brings its two groups
    together (README has the measured recall). The passes' work is rows x passes x window, that of the
    counts grows with the square of a group, not of a label.

    Defined results: a NULL label or id, and a vector that is NULL, empty, zero or has a component
    that is NULL, NaN or infinite, link with nothing (component is the own id); vectors of different
    length do not link; repeated rows count as vectors of their own; an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & ~odd & some, F.lit(False))
    rows = rows.withColumn("vector", F.when(usable, F.col("vector"))).withColumn("hash", F.xxhash64("vector"))
    good = rows.where(F.col("vector").isNotNull())
    nodes = good.groupBy("label", "hash", "vector").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
    nodes = materialize(nodes)
    groups = materialize(components(_united(nodes, min_cosine, window)))
    degrees = _counted(nodes.join(groups, "node"), min_cosine, tile).groupBy("node").agg(F.sum("linked").alias("linked"))
    named = (
        nodes.join(degrees, "node", "left")
        .join(groups, "node", "left")
        .select(
            "label", "hash", "vector",
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    alone = rows.where(F.col("vector").isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    linked = good.join(named, ["label", "hash", "vector"]).select("id", "n_links", "component_id")
    result = linked.unionByName(alone)
    return result.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _united(nodes: DataFrame, min_cosine: float, window: int) -> DataFrame:
    """Edges (a, b) that connect the nodes whose pairs some pass has verified; a forest for each step."""
    most, total = nodes.groupBy("label").count().agg(F.max("count"), F.sum("count")).first()
    passes = max(LEAST_PASSES, PASSES * math.ceil(math.log2(max(most or 1, 1))))
    partitions = max(1, (total or 0) * passes // PARTITION_ROWS)
    label = nodes.schema["label"].dataType.simpleString()
    node = nodes.schema["node"].dataType.simpleString()
    coded = nodes.select("label", "node", "vector").mapInArrow(
        lean(lambda batches: _coded(batches, passes)), f"pass int, label {label}, dim int, code long, node {node}, vector array<double>"
    )
    ordered = coded.repartitionByRange(partitions, *SORTED).sortWithinPartitions(*SORTED)
    kept = f"pass int, label {label}, dim int, node {node}, vector array<double>"
    seen = materialize(
        ordered.mapInArrow(lean(lambda batches: _compared(batches, min_cosine, window)), f"a {node}, b {node}, seam int, place int, {kept}")
    )
    across = (
        seen.where("seam is not null")
        .repartition("seam")
        .sortWithinPartitions("seam", "place")
        .select("seam", "place", "pass", "label", "dim", "node", "vector")
        .mapInArrow(lean(lambda batches: _seams(batches, min_cosine, window)), f"a {node}, b {node}")
    )
    return seen.where("a is not null").select("a", "b").unionByName(across)


def _planes(dim: int, number: int) -> np.ndarray:
    return np.random.default_rng([SEED, number, dim]).standard_normal((dim, HASHES))


def _coded(batches: Iterator[pa.RecordBatch], passes: int) -> Iterator[pa.RecordBatch]:
    """Each node once for each pass; codes are shifted so that signed numbers sort like the bits."""
    planes: dict[tuple[int, int], np.ndarray] = {}
    for whole in batches:
        for at in range(0, whole.num_rows, STEP):
            batch = whole.slice(at, STEP)
            lists = batch.column(2)
            dims = lists.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                for number in range(passes):
                    if (number, dim) not in planes:
                        planes[number, dim] = _planes(dim, number)
                    bits = np.packbits(x @ planes[number, dim] > 0, axis=1, bitorder="big").view(">u8")[:, 0]
                    code = (bits.astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
                    n = len(code)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, number, np.int32)), part.column(0), pa.array(np.full(n, dim, np.int32)), pa.array(code),
                         part.column(1), part.column(2)],
                        ["pass", "label", "dim", "code", "node", "vector"],
                    )


def _padded_units(vectors: pa.Array, keys: list[pa.Array]) -> tuple[list[np.ndarray], np.ndarray]:
    """Unit vectors in double precision, padded with zeros to one length, and a number for each run of equal keys."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    x = np.zeros((len(lengths), max(lengths, default=0)))
    x[np.arange(x.shape[1]) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    x /= np.abs(x).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    run = np.zeros(len(lengths), np.int64)
    for key in keys:
        values = key.to_numpy(zero_copy_only=False)
        run[1:] += values[1:] != values[:-1]
    return x, np.cumsum(run > 0)


def _near(batch: pa.RecordBatch, min_cosine: float, window: int, offset: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of one run within the window by ``offset`` whose later row is ``fresh`` or above."""
    x, run = _padded_units(batch.column("vector"), [batch.column("pass"), batch.column("label"), batch.column("dim")])
    first, second = [], []
    for step in range(1, min(window, len(x) - 1) + 1):
        begin = max(0, fresh - step)
        a, b = x[begin : len(x) - step], x[begin + step :]
        hit = np.flatnonzero(
            (np.einsum("ij,ij->i", a, b) >= min_cosine)
            & (run[begin : len(x) - step] == run[begin + step :])
            & (offset[begin + step :] - offset[begin : len(x) - step] <= window)
        )
        first.append(hit + begin)
        second.append(hit + begin + step)
    return np.concatenate([*first, np.zeros(0, int)]), np.concatenate([*second, np.zeros(0, int)])


def _forest(batch: pa.RecordBatch, first: np.ndarray, second: np.ndarray) -> list[pa.Array]:
    """An edge from each row in a pair to the first row that it reaches."""
    root = np.arange(batch.num_rows)
    while True:
        least = np.minimum(root[first], root[second])
        before = root.copy()
        np.minimum.at(root, first, least)
        np.minimum.at(root, second, least)
        root = root[root]
        if (root == before).all():
            break
    some = np.flatnonzero(root != np.arange(len(root)))
    node = batch.column("node")
    return [node.take(pa.array(some)), node.take(pa.array(root[some]))]


def _compared(batches: Iterator[pa.RecordBatch], min_cosine: float, window: int) -> Iterator[pa.RecordBatch]:
    """Links inside a sorted partition, then its first and last rows for the seams beside it.

    A seam has the number of the partition before it. Places count from the seam: -1 is the last row
    before it, 0 the first row after it.
    """
    part, held, head, count = TaskContext.get().partitionId(), None, [], 0

    def edge(rows: pa.RecordBatch, seam: int, place: int) -> pa.RecordBatch:
        n = rows.num_rows
        nothing = [pa.nulls(n, rows.schema.field("node").type)] * 2
        where = [pa.array(np.full(n, seam, np.int32)), pa.array(np.arange(place, place + n, dtype=np.int32))]
        kept = [rows.column(c) for c in ("pass", "label", "dim", "node", "vector")]
        return pa.RecordBatch.from_arrays([*nothing, *where, *kept], OUT)

    for whole in batches:
        for at in range(0, whole.num_rows, STEP):
            new = whole.slice(at, STEP)
            if count < window:
                head.append(new.slice(0, window - count))
            count += new.num_rows
            rows = new if held is None else _joined([held, new])
            first, second = _near(rows, min_cosine, window, np.arange(rows.num_rows), rows.num_rows - new.num_rows)
            if len(first):
                edges = _forest(rows, first, second)
                rest = [pa.nulls(len(edges[0]), t) for t in (pa.int32(), pa.int32(), pa.int32())]
                rest += [pa.nulls(len(edges[0]), rows.column(c).type) for c in ("label", "dim", "node", "vector")]
                yield pa.RecordBatch.from_arrays([*edges, *rest], OUT)
            held = rows.slice(max(0, rows.num_rows - window))
    if held is not None:
        yield edge(held, part, -held.num_rows)
        if part:
            yield edge(_joined(head), part - 1, 0)


OUT = ["a", "b", "seam", "place", "pass", "label", "dim", "node", "vector"]


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _seams(batches: Iterator[pa.RecordBatch], min_cosine: float, window: int) -> Iterator[pa.RecordBatch]:
    """Links across each seam, of at most ``window`` rows on either side."""

    def links(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        place = rows.column("place").to_numpy(zero_copy_only=False)
        first, second = _near(rows, min_cosine, window, place, 0)
        over = (place[first] < 0) & (place[second] >= 0)
        if over.any():
            yield pa.RecordBatch.from_arrays(_forest(rows, first[over], second[over]), OUT[:2])

    held = None
    for batch in batches:
        rows = batch if held is None else _joined([held, batch])
        seams = rows.column("seam").to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero(seams[1:] != seams[:-1]) + 1])
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield from links(rows.slice(a, b - a))
        held = rows.slice(int(starts[-1]))
    if held is not None:
        yield from links(held)


def _counted(nodes: DataFrame, min_cosine: float, tile: int) -> DataFrame:
    """(node, linked) for each pair of tiles of a component in which a node has links: the vectors it
    links with, copies counted."""
    node = nodes.schema["node"].dataType.simpleString()
    sized = nodes.select("component", "node", "copies", "vector", F.size("vector").alias("dim"))
    most = F.greatest(F.lit(1), F.least(F.lit(TILE_ROWS), F.floor(F.lit(TILE_VALUES) / F.col("dim"))))
    tiles = F.greatest(F.least(F.ceil(F.col("n") / tile), F.lit(TILES)), F.ceil(F.col("n") / most)).cast("int")
    counts = sized.groupBy("component", "dim").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = materialize(counts.select("component", "dim", "n", tiles.alias("tiles")))
    partitions = max(1, (counts.agg(F.sum(F.col("n") * F.col("tiles"))).first()[0] or 0) // PARTITION_ROWS)
    placed = sized.join(counts.drop("n"), ["component", "dim"]).withColumn("tile", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    grouped = (
        placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("component", "dim", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "node", "tile", "copies", "vector")
        .repartition(partitions, *GROUP)
        .sortWithinPartitions(*GROUP, "node")
    )
    schema = f"node {node}, linked long"
    return grouped.mapInArrow(lean(lambda batches: _tiles(batches, min_cosine)), schema)


def _units(vectors: pa.Array) -> np.ndarray:
    """Unit vectors in double precision, of vectors of one length."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with every group in one piece; a group holds two tiles at most."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in GROUP]
        new = np.zeros(batch.num_rows, bool)
        for c, key in zip(GROUP, keys, strict=True):
            new[1:] |= key[1:] != key[:-1]
            new[:1] |= bool(held) and held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py()
        starts = np.flatnonzero(new).tolist()
        for a, b in zip([0, *starts], [*starts, batch.num_rows], strict=True):
            if a in starts and held:
                yield _joined(held)
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
    if held:
        yield _joined(held)


def _tiles(batches: Iterator[pa.RecordBatch], min_cosine: float) -> Iterator[pa.RecordBatch]:
    """Counts of each group: of one tile all pairs, of two those across."""
    for rows in _groups(batches):
        x = _units(rows.column("vector"))
        tile, copies, node = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("tile", "copies", "node"))
        low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        first, second = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
        linked, others = np.zeros(len(x), np.int64), x[second].T
        step = max(1, STEP_VALUES // max(1, len(second)))
        for at in range(0, len(first), step):
            part = first[at : at + step]
            near = x[part] @ others >= min_cosine
            if low == high:
                near[np.arange(len(part)), at + np.arange(len(part))] = False
            linked[part] += near @ copies[second]
            if low != high:
                linked[second] += copies[part] @ near
        some = np.flatnonzero(linked)
        if len(some):
            kind = rows.column("node").type
            yield pa.RecordBatch.from_arrays([pa.array(node[some], kind), pa.array(linked[some])], ["node", "linked"])
