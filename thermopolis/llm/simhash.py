"""SimHash near-duplicates: fingerprints of word shingles, compared in bit-sliced blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopolis.llm.common import components, lean, map_arrow, materialize, pieces

BITS = 64
#: A bucket with more fingerprints is compared tile by tile, each pair of tiles in a group of its own.
TILE = 4096
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
PIECE = 4 << 20


def near_duplicates(
    docs: DataFrame, shingle_words: int = 3, max_distance: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: the id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Documents link when their fingerprints differ in at most ``max_distance`` bits; ``component_id``
    is the smallest id reachable. Equal fingerprints become one node first. Two fingerprints within
    the distance agree in at least two of ``max_distance + 2`` blocks of bits, so each is put into one
    bucket per pair of blocks and compared with the bucket's others: no link is lost, and no pair of
    documents is ever emitted, only each bucket's spanning forest.

    Defined results: NULL, empty and blank texts have fingerprint zero and link with each other;
    repeated rows come out once each; rows with a NULL id keep their row, and their component is the
    smallest id that is not NULL, NULL if there is none; an empty table gives no rows.
    """
    prints = materialize(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), shingle_words))
    nodes = prints.groupBy("print").agg(F.min("id").alias("first"))
    edges = links(nodes.select("print"), max_distance)
    found = components(edges).select(F.col("node").alias("print"), "component")
    classes = nodes.join(found, "print", "left").select("print", "first", F.coalesce("component", "print").alias("class"))
    least = classes.groupBy("class").agg(F.min("first").alias("component_id"))
    named = classes.join(least, "class").select("print", "component_id")
    return prints.join(named, "print").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def fingerprints(docs: DataFrame, shingle_words: int) -> DataFrame:
    """(id, print) of (id, text): bit i is set where more than half of the shingle hashes set it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1, PIECE):
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            prints = np.array([fingerprint(x or b"", shingle_words) for x in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["id", "print"])

    kind = docs.schema["id"].dataType.simpleString()
    return map_arrow(docs, run, f"id {kind}, print long")


def fingerprint(text: bytes, shingle_words: int) -> int:
    """Words are split at ASCII white space and A-Z are lower-cased, both on bytes."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(len(words) - shingle_words, 0)
    first_end = min(shingle_words, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: last + 1].tolist(), ends[first_end:].tolist(), strict=True)
    hashes = np.array([digest(line[a:b], 42) for a, b in spans], "<u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def masks(max_distance: int) -> list[int]:
    """A mask for each pair of the blocks, of which that many bits can touch all but two."""
    edges = np.linspace(0, BITS, max_distance + 3).round().astype(int).tolist()
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [x | y for x, y in combinations(blocks, 2)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, max_distance: int, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints within the distance of one another."""
    keys = F.array(*[F.col("print").bitwiseAND(F.lit(signed(m))) for m in masks(max_distance)])
    keyed = prints.select("print", F.posexplode(keys).alias("bucket", "key"))
    crowded = keyed.groupBy("bucket", "key").count().where(F.col("count") > tile)
    crowded = crowded.select("bucket", "key", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    keyed = keyed.join(crowded, ["bucket", "key"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    keyed = keyed.withColumn("tile", F.pmod(F.xxhash64("print"), "tiles").cast("int"))
    group = ["bucket", "key", "low", "high"]
    grouped = (
        keyed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("bucket", "key", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "print")
        .repartition(*group)
        .sortWithinPartitions(*group, "print")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, values in whole_groups(batches):
            a, b = forest(keys, values, max_distance)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return grouped.mapInArrow(lean(run), "a long, b long")


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Group number and fingerprint of sorted rows, with every group in one piece.

    A group holds two tiles at most, so what is carried over stays small.
    """
    held: list[np.ndarray] = [np.zeros((0, 4), np.int64), np.zeros(0, np.uint64)]

    def numbered(rows, values):
        new = np.any(rows[1:] != rows[:-1], axis=1)
        return np.concatenate([[0], np.cumsum(new)]), values

    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
        rows = np.concatenate([held[0], rows])
        values = np.concatenate([held[1], batch.column(4).to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(rows):
            continue
        cut = int(np.flatnonzero(np.any(rows != rows[-1], axis=1))[-1]) + 1 if np.any(rows[0] != rows[-1]) else 0
        held = [rows[cut:], values[cut:]]
        if cut:
            yield numbered(rows[:cut], values[:cut])
    if len(held[0]):
        yield numbered(*held)


def forest(keys: np.ndarray, values: np.ndarray, max_distance: int, step: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint linked inside its group, an edge to the smallest it reaches there.

    Sixty-four fingerprints of a group make a word: word j of plane i holds bit i of each. A
    fingerprint meets the words of its group from its own on; differing bits enter counters whose
    binary digits are words too, and a word is abandoned once all of its counters have passed the
    distance. Fingerprints of all groups are compared in the same vector operations.
    """
    size = np.bincount(keys)
    keep = size[keys] > 1
    keys, values = np.unique(keys[keep], return_inverse=True)[1], values[keep]
    n = len(values)
    if not n:
        return values, values
    size = np.bincount(keys)
    begin = np.cumsum(size) - size
    lane = np.arange(n) - begin[keys]
    words = -(-size // 64)
    word_begin = np.cumsum(words) - words
    slot = (word_begin[keys] + lane // 64) * 64 + lane % 64
    total = int(words.sum())
    spread = np.zeros(total * 64, np.uint64)
    spread[slot] = values
    used = np.zeros(total * 64, np.uint8)
    used[slot] = 1
    owner = np.zeros(total * 64, np.int64)
    owner[slot] = np.arange(n)
    valid = np.packbits(used, bitorder="little").view("<u8")
    bits = np.unpackbits(spread.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(bits.reshape(total, 64, 64), axis=1, bitorder="little")  # word, byte of lanes, bit
    planes = np.ascontiguousarray(planes.transpose(2, 0, 1)).view("<u8")[:, :, 0]
    root = np.arange(n)
    meets = words[keys] - lane // 64
    bound = np.concatenate([[0], np.cumsum(meets)])
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(bound, bound[at] + step, "right")) - 1)
        query = np.repeat(np.arange(at, to), meets[at:to])
        word = slot[query] // 64 + np.arange(len(query)) - (bound[query] - bound[at])
        query, word, near = compared(values, planes, query, word, max_distance)
        near &= valid[word]
        seen = np.flatnonzero(near)
        if len(seen):
            hit, bit = np.nonzero(np.unpackbits(near[seen].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            a, b = root[query[seen[hit]]], root[owner[word[seen[hit]] * 64 + bit]]
            joined = a != b
            if joined.any():
                merge(root, np.unique(np.stack([a[joined], b[joined]], axis=1), axis=0))
        at = to
    linked = root != np.arange(n)
    return values[linked], values[root[linked]]


def compared(values, planes, query, word, max_distance):
    """The (query, word) pairs that may hold a near fingerprint, with a word of flags for each."""
    digits = [np.zeros(len(query), np.uint64) for _ in range(max(1, (max_distance).bit_length()))]
    beyond = np.zeros(len(query), np.uint64)
    start = (1 << len(digits)) - 1 - max_distance  # counters begin there, so that passing the distance overflows
    for i, digit in enumerate(digits):
        if start >> i & 1:
            digit |= FULL
    for plane in range(BITS):
        mine = np.uint64(0) - (values[query] >> np.uint64(plane) & np.uint64(1))
        carry = planes[plane][word] ^ mine
        for digit in digits:
            digit ^= carry
            carry &= ~digit
        beyond |= carry
        if plane % 8 == 7:
            alive = beyond != FULL
            if not alive.all():
                query, word, beyond = query[alive], word[alive], beyond[alive]
                digits = [d[alive] for d in digits]
    return query, word, ~beyond


def merge(root: np.ndarray, pairs: np.ndarray) -> None:
    """Union-find over pairs of roots; afterwards every entry names the smallest of its set."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    for a, b in pairs.tolist():
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    for x in list(parent):
        root[x] = find(x)
    root[:] = root[root]
