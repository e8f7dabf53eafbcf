"""Suffix-array deduplication: bytes of long repeats are cut, the earliest copy stays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopolis.llm.common import lean, pieces

LENGTH = 100
#: Bytes behind a window's minimum: that many equal bytes are needed to look at a window at all.
KMER = 32
#: Window starts in one context at most; a longer run of one minimum is cut.
CONTEXT = 2048
PIECE = 2 << 20
#: Contexts a task remembers, to ship equal ones once.
MEMO_ROWS = 200_000
#: Windows of a minimum with more runs meet by their own bytes instead.
CROWDED = 4096
#: Bytes of contexts whose suffixes one call sorts.
SORT_BYTES = 4 << 20
ODD, MIX, WORD = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, (1 << 64) - 1


def cut_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """The id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of every row; with ``texts``
    also ``kept``, the bytes that stay.

    A byte goes if some ``length`` bytes that cover it also start earlier: in a document of smaller id,
    or further left in the same one. All is judged on the input texts in UTF-8.

    Every window of ``length`` bytes has a minimum, the least hash of its 32-byte parts. Equal windows
    have equal minima, and neighbouring windows mostly share theirs, so a text falls into runs of
    windows with one minimum, some 36 long. 1. Texts equal as a whole are one unit; the later copies go
    whole. 2. Runs are shuffled as (minimum, hash of the text): only minima that occur twice matter. 3. Their
    contexts, the bytes of all windows of the run, are shuffled by minimum. There a suffix array over
    the contexts, as deep as a window, gives the longest previous factor of each window: in suffix
    order, its previous or next smaller position shares ``length`` bytes with it just when it has an
    earlier copy. 4. The ranges found are joined to the texts and cut. No window is sampled or capped.

    A passage that many documents share meets in few rows: within a task, equal contexts are one row,
    the first's, and the others are known to repeat it. At the passage's edges contexts differ in every
    document, so the windows of a minimum with over ``CROWDED`` runs go one by one, each to the place
    of a hash of its bytes and again only the first of equal ones: what meets is bounded by the number
    of batches, not of documents.

    Defined results: NULL counts as empty; texts shorter than ``length`` stay; rows with one id and one
    text are one document and get one result each; different texts under one id are ordered by a hash
    of the text, rows with a NULL id come after all others; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Two halves of a strong hash name a text in all narrow rows, so that every step below joins on
    # what the texts are grouped by and the one exchange of the texts serves all.
    # They are declared not NULL, else inner and outer joins would filter the scan differently.
    halves = [F.coalesce(F.conv(F.substring(F.md5("text"), at, 16), 16, -10).cast("long"), F.lit(0)) for at in (1, 17)]
    rows = rows.select("id", "text", halves[0].alias("u1"), halves[1].alias("u2"))
    unit = ["u1", "u2"]
    # Equal texts are combined before the shuffle.
    units = rows.groupBy(*unit).agg(F.min("id").alias("owner"), F.any_value("text").alias("text"))
    order = F.coalesce(F.col("owner").cast("long"), F.lit((1 << 63) - 1))
    units = units.select(order.alias("id"), "u1", "u2", "text")

    seen = units.mapInArrow(lean(lambda b: _minima(b, length)), "minimum long, u1 long, u2 long, known int, runs long")
    # Rows that are known to repeat need no comparison and are spread; the others meet by minimum.
    place = F.when(F.col("known") == 2, F.xxhash64("u1", "minimum")).otherwise(F.col("minimum"))
    repeated = seen.repartition(place).sortWithinPartitions("minimum").mapInArrow(_repeated, "minimum long, u1 long, u2 long")
    crowded = repeated.where("u1 is null").select("minimum", F.lit(True).alias("many"))
    repeated = repeated.where("u1 is not null").join(crowded, "minimum", "left")
    many = F.collect_set(F.when(F.col("many"), F.col("minimum"))).alias("crowded")
    wanted = repeated.groupBy(*unit).agg(F.collect_set("minimum").alias("minima"), many)

    contexts = units.join(wanted, unit).select("id", "u1", "u2", "text", "minima", "crowded")
    contexts = contexts.mapInArrow(lean(lambda b: _contexts(b, length)), "minimum long, id long, u1 long, u2 long, start int, windows int, bytes binary, later int"
    )
    place = F.when(F.col("later") == 1, F.xxhash64("u1", "start")).otherwise(F.col("minimum"))
    contexts = contexts.repartition(place).sortWithinPartitions("minimum", "id", *unit, "start")
    ranges = contexts.mapInArrow(lean(lambda b: _factors(b, length)), "u1 long, u2 long, start int, windows int")
    spans = ranges.groupBy(*unit).agg(F.collect_list(F.struct("start", "windows")).alias("spans"))

    schema = "u1 long, u2 long, owner long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    cut = units.join(spans, unit, "left").select("u1", "u2", "id", "text", "spans").mapInArrow(lean(lambda b: _cut(b, length, texts)), schema)
    mine = F.coalesce(F.col("id").cast("long"), F.lit((1 << 63) - 1)) == F.col("owner")
    stays = mine | (F.col("n_bytes") < length)
    return (
        rows.select("id", "u1", "u2")
        .join(cut, unit)
        .select(
            F.col("id").alias(id_col),
            "n_bytes",
            F.when(stays, F.col("n_removed")).otherwise(F.col("n_bytes")).alias("n_removed"),
            F.when(stays, F.col("n_spans")).otherwise(F.lit(1).cast("long")).alias("n_spans"),
            F.when(stays, F.col("kept_sha256")).otherwise(F.sha2(F.lit("").cast("binary"), 256)).alias("kept_sha256"),
            *[F.when(stays, F.col("kept")).otherwise(F.lit(b"")).alias("kept")] * texts,
        )
    )


def window_minima(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``length`` bytes the least hash of its parts of ``KMER`` bytes; the hashes."""
    hashes, width, factor = data.astype(np.uint64) + np.uint64(1), 1, ODD
    while width < KMER:
        hashes = hashes[:-width] * np.uint64(factor) + hashes[width:]
        hashes ^= hashes >> np.uint64(29)
        width, factor = 2 * width, factor * factor * MIX & WORD
    hashes = hashes.view(np.int64)
    least, width, parts = hashes, 1, length - KMER + 1
    while 2 * width <= parts:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < parts:
        least = np.minimum(least[: len(least) - (parts - width)], least[parts - width :])
    return least, hashes


def runs(values: np.ndarray, limit: int = CONTEXT) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of equal values, long ones cut at ``limit``."""
    new = np.concatenate([[True], values[1:] != values[:-1]])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(values)))
    if size.max(initial=0) > limit:
        parts = -(-size // limit)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, whole = np.repeat(start, parts) + nth * limit, np.repeat(start + size, parts)
        size = np.minimum(whole - start, limit)
    return start, size


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column in one array, and where each row begins and ends."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _runs_of(batch: pa.RecordBatch, column: int, length: int):
    """All runs of a batch's texts: row, start in the text, windows, minimum, and whether a part with
    the minimum's hash occurs twice, so that the run may repeat itself; and bytes and offsets."""
    data, offsets = _texts(batch.column(column))
    if len(data) < length:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing, nothing > 0, data, offsets
    least, hashes = window_minima(data, length)
    # Windows over a text's end belong to none: cut the runs at the last window of each text.
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    inside = np.arange(len(least)) + length <= offsets[row + 1]
    at = np.flatnonzero(inside)
    new = np.ones(len(at), bool)
    new[1:] = (least[at[1:]] != least[at[:-1]]) | (row[at[1:]] != row[at[:-1]])
    start, size = runs(np.cumsum(new))
    if not len(start):
        return start, start, start, start, start > 0, data, offsets
    minimum, last = least[at[start]], at[start + size - 1]
    times = np.add.reduceat((hashes[at] == least[at]).astype(np.int64), start)
    for step in range(1, length - KMER + 1):
        times += hashes[last + step] == minimum
    return row[at[start]], at[start] - offsets[row[at[start]]], size, minimum, times > 1, data, offsets


def _minima(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(minimum, unit, known, runs) of each run. known: 0 for a minimum that the batch has once, else 1
    for one row of it, with the number of its runs, and 2 for the others, and for a run that may repeat
    itself."""
    for batch in pieces(batches, 3, PIECE):
        row, _, _, minimum, twice, _, _ = _runs_of(batch, 3, length)
        if len(row):
            _, first, inverse, times = np.unique(minimum, return_index=True, return_inverse=True, return_counts=True)
            known = np.where((times[inverse] > 1) | twice, 2, 0).astype(np.int32)
            known[first[(times > 1) | twice[first]]] = 1
            # Of the others a text needs each minimum once.
            others = np.flatnonzero(known == 2)
            _, once = np.unique(np.stack([minimum[others], row[others]], axis=1), axis=0, return_index=True)
            at = np.concatenate([np.flatnonzero(known < 2), others[once]])
            u1, u2 = (batch.column(i).to_numpy()[row[at]] for i in (1, 2))
            number = np.where(known[at] < 2, times[inverse[at]], 0)
            arrays = [*map(pa.array, (minimum[at], u1, u2, known[at], number))]
            yield pa.RecordBatch.from_arrays(arrays, ["minimum", "u1", "u2", "known", "runs"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by minimum, those known to repeat or with the minimum of a neighbour; and a row
    without unit for each minimum of too many runs.

    The rows that carry runs of one minimum are all in one partition, one for each batch of texts.
    """
    held, last_minimum, last_runs = None, None, 0

    def marks(minima: list[int]) -> pa.RecordBatch:
        unit = pa.nulls(len(minima), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(minima, pa.int64()), unit, unit], ["minimum", "u1", "u2"])

    for batch in batches:
        if batch.num_rows:
            minimum = batch.column(0).to_numpy()
            start = np.flatnonzero(np.concatenate([[True], minimum[1:] != minimum[:-1]]))
            groups, runs = minimum[start].tolist(), np.add.reduceat(batch.column(4).to_numpy(), start).tolist()
            if groups[0] == last_minimum:
                runs[0] += last_runs
            else:
                groups, runs = [last_minimum, *groups], [last_runs, *runs]
            last_minimum, last_runs = groups[-1], runs[-1]
            yield marks([g for g, n in zip(groups[:-1], runs[:-1], strict=True) if n > CROWDED])
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        minimum = rows.column(0).to_numpy()
        equal = minimum[1:] == minimum[:-1]
        out = rows.column(3).to_numpy() > 0
        out[1:] |= equal
        out[:-1] |= equal
        last = rows.num_rows - 1
        # The last row waits for its successor, with the mark that it has met its equal.
        held = rows.slice(last)
        if out[last]:
            held = held.set_column(3, "known", pa.array([1], pa.int32()))
        yield rows.slice(0, last).filter(pa.array(out[:last])).select([0, 1, 2])
    if last_runs > CROWDED:
        yield marks([last_minimum])
    if held is not None and held.column(3)[0].as_py() > 0:
        yield held.select([0, 1, 2])


def _contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The runs whose minimum is wanted, with their bytes.

    A run whose bytes the task has met before, earlier in the order of the texts, is marked ``later``
    and carries none: all its windows are repeats. Other runs of a crowded minimum are cut into windows,
    with the hash of the window as minimum, and those the task has met are marked in the same way.
    """
    names = ["minimum", "id", "u1", "u2", "start", "windows", "bytes", "later"]
    known: dict[bytes, tuple[int, ...]] = {}
    for batch in pieces(batches, 3, PIECE):
        row, start, size, minimum, _, data, offsets = _runs_of(batch, 3, length)
        bounds = batch.column(4).offsets.to_numpy()
        wanted = batch.column(4).flatten().to_numpy()
        if not len(row) or not len(wanted):
            continue
        # Two rows' minima may mix here by chance: that only adds runs that need not be looked at.
        mixed = wanted ^ (np.repeat(np.arange(batch.num_rows), np.diff(bounds)) << 40)
        at = np.flatnonzero(np.isin(minimum ^ (row << 40), mixed))
        ids, u1, u2 = (batch.column(i).to_numpy()[row] for i in range(3))
        at = at[np.lexsort((start[at], u2[at], u1[at], ids[at]))]
        begin = offsets[row[at]] + start[at]
        minimum, ids, u1, u2, start, size = (x[at] for x in (minimum, ids, u1, u2, start, size))
        # Whether a minimum is crowded does not depend on the text, so all its runs here are cut.
        crowded = np.isin(minimum, batch.column(5).flatten().to_numpy())
        text, rows = data.tobytes(), []

        def met(part: bytes, place: tuple[int, ...]) -> bool:
            before = known.get(part)
            if before is not None and before < place:
                return True
            if len(known) > MEMO_ROWS:
                known.clear()
            known[part] = place
            return False

        for m, a, n, cut, *place in zip(*(x.tolist() for x in (minimum, begin, size, crowded, ids, u1, u2, start)), strict=True):
            part = text[a : a + n + length - 1]
            if met(part, tuple(place)):
                rows.append((m, *place, n, None, 1))
            elif not cut:
                rows.append((m, *place, n, part, 0))
            else:
                *unit, first = place
                for i in range(n):
                    window = text[a + i : a + i + length]
                    if n == 1 or not met(window, (*unit, first + i)):
                        rows.append((xxhash.xxh64_intdigest(window) - (1 << 63), *unit, first + i, 1, window, 0))
                    elif rows[-1][-1] and rows[-1][1:4] == tuple(unit) and rows[-1][4] + rows[-1][5] == first + i:
                        rows[-1] = (*rows[-1][:5], rows[-1][5] + 1, None, 1)
                    else:
                        rows.append((m, *unit, first + i, 1, None, 1))
            if len(rows) >= MEMO_ROWS:
                yield _rows(rows, names)
                rows = []
        if rows:
            yield _rows(rows, names)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def suffix_array(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions of ``data`` (symbols over the bytes, every separator one of its own) in the order
    of their first ``length`` symbols, equal ones by position; and each position's rank.

    Ranks double in depth. The last step overlaps, so that the depth is exact.
    """
    n = len(data)
    rank, depth = np.unique(data, return_inverse=True)[1].astype(np.int64), 1
    while depth < length:
        step = min(depth, length - depth)
        ahead = np.zeros(n, np.int64)
        ahead[: max(n - step, 0)] = rank[step:] + 1
        pair = rank * (n + 1) + ahead
        order = np.argsort(pair, kind="stable")
        new = np.concatenate([[0], np.cumsum(pair[order][1:] != pair[order][:-1])])
        rank[order] = new
        depth += step
    return np.argsort(rank, kind="stable"), rank


def smaller_neighbours(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of a suffix order the nearest places before and behind it with a smaller
    position, -1 and n if there is none."""
    n = len(order)
    before, behind = np.full(n, -1, np.int64), np.full(n, n, np.int64)
    stack: list[int] = []
    for place, position in enumerate(order.tolist()):
        while stack and order[stack[-1]] > position:
            behind[stack.pop()] = place
        if stack:
            before[place] = stack[-1]
        stack.append(place)
    return before, behind


def previous_factors(data: np.ndarray, length: int) -> np.ndarray:
    """Longest previous factor of each position, up to ``length``: the most symbols that from there on
    equal those from an earlier position on (the two may overlap).

    The earlier position with the longest common prefix is the previous or the next smaller position
    in suffix order, and prefixes along the order are minima of the neighbours'.
    """
    order, rank = suffix_array(data, length)
    n = len(data)
    common = np.zeros(n + 1, np.int64)  # of the suffixes at a place and the one before
    for place in range(1, n):
        a, b = order[place - 1], order[place]
        most = min(length, n - max(a, b))
        differ = np.flatnonzero(data[a : a + most] != data[b : b + most])
        common[place] = differ[0] if len(differ) else most
    before, behind = smaller_neighbours(order)
    factor = np.zeros(n, np.int64)
    for place in range(n):
        a, b = before[place], behind[place]
        left = common[a + 1 : place + 1].min() if a >= 0 else 0
        right = common[place + 1 : b + 1].min() if b < n else 0
        factor[order[place]] = max(left, right)
    return factor


def have_previous(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Whether the longest previous factor of the windows at ``starts`` (ascending) reaches ``length``,
    with the windows alone as positions.

    That is so if a window's previous or next smaller position in suffix order shares its ``length``
    bytes. In the order of the windows' bytes, equal ones by position, those with equal bytes stand
    together and ascend: the previous smaller position then is the place before, and there is no next
    one. Bytes are compared eight at a time. A window whose 64-bit hash occurs once has no copy and is
    not sorted.
    """
    eights = np.ndarray((len(data) - 7,), ">u8", np.ascontiguousarray(data), strides=(1,))
    steps = [*range(0, length - 7, 8), length - 8]
    keys = [eights[starts + s].astype(np.uint64) for s in steps]
    mixed = keys[0]
    for key in keys[1:]:
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(ODD) + key
    order = np.argsort(mixed)
    equal = mixed[order[1:]] == mixed[order[:-1]]
    twice = np.zeros(len(starts), bool)
    twice[order[1:]] = equal
    twice[order[:-1]] |= equal
    some = np.flatnonzero(twice)
    keys = [key[some] for key in keys]
    order = np.lexsort(keys[::-1])
    equal = np.ones(max(len(order) - 1, 0), bool)
    for key in keys:
        equal &= key[order[1:]] == key[order[:-1]]
    out = np.zeros(len(starts), bool)
    out[some[order[1:]]] = equal
    return out


def _factors(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(unit, start, windows) of the ranges of windows with an earlier copy.

    Rows come sorted by minimum and then in the order of the texts, so positions in the joined
    contexts are in that order as well. Whole minima are sorted together until enough bytes are there.
    """
    held: list[pa.RecordBatch] = []
    held_bytes = 0

    def solve(rows: pa.RecordBatch) -> pa.RecordBatch:
        later = rows.column(7).to_numpy() > 0
        out = [rows.column(i).to_numpy()[later] for i in (2, 3, 4, 5)]
        have = rows.filter(pa.array(~later))
        u1, u2, starts, sizes = (have.column(i).to_numpy() for i in (2, 3, 4, 5))
        if have.num_rows:
            data, offsets = _texts(have.column(6))
            begin, sizes = offsets[:-1], sizes.astype(np.int64)
            place = np.repeat(begin, sizes) + (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
            context = np.repeat(np.arange(have.num_rows), sizes)
            hit = np.flatnonzero(have_previous(data, place, length))
            if len(hit):
                new = np.ones(len(hit), bool)
                new[1:] = (np.diff(hit) != 1) | (context[hit[1:]] != context[hit[:-1]])
                first = np.flatnonzero(new)
                c = context[hit[first]]
                found = [u1[c], u2[c], starts[c] + place[hit[first]] - begin[c], np.diff(np.append(first, len(hit)))]
                out = [np.concatenate(x) for x in zip(out, found, strict=True)]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["u1", "u2", "start", "windows"])

    def whole(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    for batch in pieces(batches, 6, SORT_BYTES):
        held.append(batch)
        held_bytes += batch.nbytes
        if held_bytes >= SORT_BYTES:
            rows = whole(held)
            minimum = rows.column(0).to_numpy()
            cut = int(np.searchsorted(minimum, minimum[-1]))
            if cut:
                yield solve(rows.slice(0, cut))
            held = [rows.slice(cut)]
            held_bytes = held[0].nbytes if cut else 0
    if held:
        yield solve(whole(held))


def _cut(batches: Iterator[pa.RecordBatch], length: int, texts: bool) -> Iterator[pa.RecordBatch]:
    """Unite the ranges of each text and cut them."""
    names = ["u1", "u2", "owner", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * texts
    for batch in pieces(batches, 3, PIECE):
        ranges, bounds = batch.column(4).flatten(), batch.column(4).offsets.to_numpy()
        bounds = bounds - bounds[0]
        begin, size = (ranges.field(i).to_numpy().astype(np.int64) for i in range(2))
        out: list[list] = [[], [], [], [], []]
        for row, text in enumerate(batch.column(3).cast(pa.large_binary()).to_pylist()):
            a, n = begin[bounds[row] : bounds[row + 1]], size[bounds[row] : bounds[row + 1]]
            order = np.argsort(a)
            a, b = a[order], np.maximum.accumulate((a + n + length - 1)[order])
            if len(a):
                apart = np.flatnonzero(a[1:] > b[:-1])
                a, b = a[np.append(0, apart + 1)], b[np.append(apart, len(b) - 1)]
            kept = b"".join([text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)], strict=True)])
            for column, value in zip(out, (len(text), len(text) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), kept), strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        arrays = [pa.array(x, k) for x, k in zip(out, kinds, strict=True)][: 5 if texts else 4]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], names)
