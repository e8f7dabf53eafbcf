"""BPE encoding and decoding through a minimal acyclic transducer of frequent words."""

from __future__ import annotations

import hashlib
import mmap
import struct
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopolis.llm.common import gathered, give_back, map_arrow, materialize, put_file, scratch
from thermopolis.llm.tokens import load
from thermopolis.llm.words import BatchMerger, runs_in, splitter

#: Words in the transducer, the most frequent of the corpus.
LEXICON_WORDS = 200_000
#: Words seen less often never enter it.
LEXICON_COUNT = 3
#: Longer words are left to the merges, which bounds the transducer's size.
LEXICON_BYTES = 64
#: Text whose different runs are counted or encoded together, in bytes; a longer one alone.
PIECE = 12 << 20
#: Runs that are split into words together.
RUNS = 50_000
#: Rows whose tokens are joined together.
ROWS = 500


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all documents, for words that the transducer may hold.

    Each task sums what it sees before the shuffle, which then carries a row per word and task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter()
        for batch in gathered(batches, 0, PIECE):
            _, places, runs = runs_in(batch.column(0))
            words: Counter[str] = Counter()
            for run, n in zip(runs, np.bincount(places, minlength=len(runs)).tolist(), strict=True):
                for word in split(run.decode()) or ():
                    if len(word) <= LEXICON_BYTES:
                        words[word] += n
            yield pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])

    counted = map_arrow(docs.select(F.col(text_col).alias("text")), run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Transducer:
    """A word's token ids from a compiled file; None for a word it does not hold.

    The automaton is minimal: words share their beginnings and their ends. Each arc carries a number,
    and the numbers on a word's way add up to its place in the sorted lexicon, where its ids stand.
    File: counts of states, arcs and words; per state the first arc; per arc target and number; where
    each word's ids begin; the ids; per arc its byte; per state whether a word ends there.
    """

    def __init__(self, data):
        states, arcs, words, ids = struct.unpack_from("<4i", data)
        view, at = memoryview(data), 16
        self.parts = []
        for n in (states + 1, arcs, arcs, words + 1, ids):
            self.parts.append(view[at : at + 4 * n].cast("i"))
            at += 4 * n
        self.first, self.target, self.number, self.begin, self.ids = self.parts
        self.data, self.label_at, self.final_at = data, at, at + arcs

    def __call__(self, word: bytes) -> list[int] | None:
        state = place = 0
        find, first, labels = self.data.find, self.first, self.label_at
        for i in range(len(word)):
            arc = find(word[i : i + 1], labels + first[state], labels + first[state + 1]) - labels
            if arc < 0:
                return None
            place += self.number[arc]
            state = self.target[arc]
        if not self.data[self.final_at + state]:
            return None
        return self.ids[self.begin[place] : self.begin[place + 1]].tolist()


    def all(self, words: list[str]) -> list[list[int] | None]:
        """The ids of each word, all words of one length taking a step at a time."""
        first, target, number = (np.frombuffer(x, np.int32) for x in (self.first, self.target, self.number))
        labels = np.frombuffer(self.data, np.uint8, len(target), self.label_at)
        final = np.frombuffer(self.data, np.uint8, len(first) - 1, self.final_at)
        keys = np.repeat(np.arange(len(first) - 1, dtype=np.int64), np.diff(first)) << 8 | labels
        out: list[list[int] | None] = [None] * len(words)
        by_length: dict[int, list[int]] = {}
        coded = [w.encode() for w in words]
        for i, word in enumerate(coded):
            by_length.setdefault(len(word), []).append(i)
        for length, places in by_length.items():
            if not len(keys):
                continue
            letters = np.frombuffer(b"".join([coded[i] for i in places]), np.uint8).reshape(len(places), length)
            rows, state, place = np.array(places), np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
            for step in range(length):
                want = state << 8 | letters[:, step]
                at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                held = keys[at] == want
                rows, letters, at = rows[held], letters[held], at[held]
                place, state = place[held] + number[at], target[at].astype(np.int64)
                if not len(rows):
                    break
            ends = final[state] > 0
            for i, p in zip(rows[ends].tolist(), place[ends].tolist(), strict=True):
                out[i] = self.ids[self.begin[p] : self.begin[p + 1]].tolist()
        return out


def compile_words(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The transducer file of (word, ids), built word by word in sorted order.

    Only the newest word's path is open. What a next word leaves behind is closed: a state equal to an
    earlier one, in its end mark and arcs, is replaced by it, so the automaton is minimal throughout.
    """
    known: dict[tuple, int] = {}
    closed: list[tuple] = []
    path: list[list] = [[False, []]]  # end mark, arcs (byte, closed target)
    previous, begin, ids = b"", array("i", [0]), array("i")

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            state = (final, tuple(arcs))
            if state not in known:
                known[state] = len(closed)
                closed.append(state)
            path[-1][1].append((previous[len(path) - 1], known[state]))

    for word, its in sorted(entries):
        shared = 0
        while shared < min(len(word), len(previous)) and word[shared] == previous[shared]:
            shared += 1
        close(shared)
        path += [[False, []] for _ in word[shared:]]
        path[-1][0] = True
        previous = word
        ids.extend(its)
        begin.append(len(ids))
    close(0)
    closed.append((path[0][0], tuple(path[0][1])))
    below: list[int] = []
    for final, arcs in closed:  # a state's targets come before it
        below.append(final + sum(below[t] for _, t in arcs))
    order = range(len(closed) - 1, -1, -1)  # the start state becomes number 0
    first, target, number, labels = array("i", [0]), array("i"), array("i"), bytearray()
    for state in order:
        final, arcs = closed[state]
        passed = int(final)
        for byte, to in arcs:
            labels.append(byte)
            target.append(len(closed) - 1 - to)
            number.append(passed)
            passed += below[to]
        first.append(len(target))
    finals = bytes(closed[s][0] for s in order)
    head = struct.pack("<4i", len(closed), len(target), len(begin) - 1, len(ids))
    return head + b"".join(x.tobytes() for x in (first, target, number, begin, ids)) + bytes(labels) + finals


def lexicon(docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS, text_col: str = "text") -> bytes:
    """The transducer of the corpus's most frequent words, ``words`` at most; a few MB at any size.

    The least count that enters comes from a histogram of the counts, in steps of an eighth of a
    doubling, so the driver gets the lexicon and a few hundred numbers and no task sorts words.
    """
    merge = BatchMerger(tokenizer)
    counts = materialize(word_counts(docs, text_col).where(F.col("n") >= LEXICON_COUNT))
    band = F.floor(F.log2("n") * 8)
    left, least = words, None
    for r in sorted(counts.groupBy(band.alias("band")).count().collect(), reverse=True):
        left -= r["count"]
        if left < 0:
            break
        least = r.band
    if least is None:
        return compile_words([])
    most = [r.word for r in counts.where(band >= least).select("word").collect()]
    return compile_words((word.encode(), ids) for word, ids in zip(most, merge.all(most), strict=True))


def encode_decode(
    docs: DataFrame,
    tokenizer: str,
    words: int = LEXICON_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    full: bool = True,
) -> DataFrame:
    """The id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every row; with ``full`` also
    ``ids`` (array<int>) and ``decoded``.

    Each executor fetches the compiled lexicon as a file and maps it into memory. A word it lacks is
    merged exactly; runs with other characters than Latin ones, and those that may hold a special
    token, go through the library, whose tables for case and normal form they need. Decoding joins the
    tokens with spaces, as the library does for a file without a decoder. The different runs of some
    PIECE bytes of text are encoded once and taken by all rows that have them; nothing is kept beyond.

    Defined results: NULL and empty texts have no ids and decode to an empty text; repeated rows come
    out once each; a NULL id passes; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    name = put_file(spark, scratch(spark, "lexicon"), lexicon(docs, tokenizer, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(SparkFiles.get(name), "rb") as file:
            look_up = Transducer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
        merge, library, split = BatchMerger(tokenizer), load(tokenizer), splitter()
        vocabulary = library.get_vocab(with_added_tokens=True)
        by_id = {i: t.encode() for t, i in vocabulary.items()}
        tokens = pa.array([by_id.get(i) for i in range(max(by_id) + 1)], pa.large_binary())
        numbers = pa.array([b"%d" % i for i in range(len(tokens))], pa.large_binary())
        del vocabulary, by_id

        def encode_runs(runs: list[bytes]) -> pa.LargeListArray:
            """The token ids of each run: those of its words out of the transducer or, if it lacks them, by merges."""
            texts = [run.decode() for run in runs]
            parts = [split(x) if x else [] for x in texts]
            words = list({w for ws in parts if ws for w in ws})
            ids = look_up.all(words)
            unseen = [i for i, x in enumerate(ids) if x is None]
            for i, merged in zip(unseen, merge.all([words[i] for i in unseen]), strict=True):
                ids[i] = merged
            place = {w: i for i, w in enumerate(words)}
            places, ends = array("q"), array("q", [0])
            for text, ws in zip(texts, parts, strict=True):
                if ws is None:
                    places.append(len(ids))
                    ids.append(library.encode(text, add_special_tokens=False).ids)
                else:
                    places.extend([place[w] for w in ws])
                ends.append(len(places))
            return chained(pa.array(ids, pa.large_list(pa.int32())), np.array(places, np.int64), np.array(ends, np.int64))

        for batch in gathered(batches, 1, PIECE):
            names = batch.column(0)
            ends, places, runs = runs_in(batch.column(1))
            del batch
            ids = pa.concat_arrays([encode_runs(runs[at : at + RUNS]) for at in range(0, len(runs), RUNS)] or [NO_LISTS])
            del runs
            give_back()
            for at in range(0, len(names), ROWS):
                mine = ends[at : min(at + ROWS, len(names)) + 1]
                yield rows_of(names.slice(at, ROWS), chained(ids, places[mine[0] : mine[-1]], mine - mine[0]), numbers, tokens)

    def rows_of(names: pa.Array, ids: pa.LargeListArray, *spelt: pa.Array) -> pa.RecordBatch:
        """Rows of token ids, their number, and the digests of both ways to spell them, joined by spaces."""
        arrays = [names, pa.array(np.diff(ids.offsets), pa.int64())]
        for spelling in spelt:
            joined = pc.binary_join(pa.LargeListArray.from_arrays(ids.offsets, spelling.take(ids.values)), SPACE)
            arrays.append(pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in joined], pa.string()))
        if full:
            arrays += [ids.cast(pa.list_(pa.int32())), pa.array([x.as_py().decode() for x in joined], pa.string())]
        return pa.RecordBatch.from_arrays(arrays, NAMES[: len(arrays)])

    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * full
    return map_arrow(docs, run, schema).withColumnRenamed("id", id_col)


def chained(lists: pa.LargeListArray, places: np.ndarray, ends: np.ndarray) -> pa.LargeListArray:
    """The lists at ``places``, those up to each of ``ends`` as one."""
    found = lists.take(pa.array(places))
    return pa.LargeListArray.from_arrays(pa.array(found.offsets.to_numpy()[ends]), found.values)


NO_LISTS = pa.array([], pa.large_list(pa.int32()))
SPACE = pa.scalar(b" ", pa.large_binary())
NAMES = ["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
