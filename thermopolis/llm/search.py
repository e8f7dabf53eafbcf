"""Ranked lexical search: impact lists of bounded shards, read by the Best Position Algorithm."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermopolis.llm.common import lean, pieces, split_words

#: Items are ranked in blocks of about so many bytes, each in a pass of its own over the documents.
ITEM_BYTES = 8 << 20
#: A shard ends with the document that brings it to so many postings.
SHARD_POSTINGS = 2 << 20
PIECE = 4 << 20
#: Sorted accesses to each list in the first round; every round reads twice as many.
DEPTH = 32
#: The best of all shards meet by item and a hash of the document first, then by item.
MERGE_BUCKETS = 16
#: A-Z to lower case, other ASCII characters but letters and digits to spaces, all else as it is.
TABLE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """A text's terms in lists of bounded size."""
    return split_words((text or b"").translate(TABLE))


class Shard:
    """Impact lists over some documents: for each term its documents by descending impact, read in
    that order by sorted access or for given documents by direct access."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, m: np.ndarray):
        """Postings, one for each pair of term and document, and each document's length part ``m``."""
        self.documents = len(m)
        impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        term = term[order]
        first = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(term))
        self.lists = dict(zip(term[first].tolist(), zip(first.tolist(), last.tolist(), strict=True), strict=True))
        keys = term * self.documents + self.doc
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]

    def places(self, term: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Where the pairs stand in the lists, -1 for a document without the term."""
        want = term * self.documents + doc
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.by_key[at], -1)

    def best(self, weights: dict[int, int], k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The documents with the ``k`` highest scores above 0 and the scores, equal ones by ``ids``.

        Best Position Algorithm: documents met by sorted access are scored through direct accesses to
        all lists, which mark positions as seen too. A list's best position is the end of its seen
        prefix; no unseen document has a greater impact there. Reading stops once the k-th score is
        strictly above the weighted sum of the impacts at the best positions, so that a document
        with an equal score and a smaller id cannot be missed.
        """
        lists = [(t, w, *self.lists[t]) for t, w in weights.items() if w > 0 and t in self.lists]
        if not lists:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        term, weight, first, last = (np.array(x, np.int64) for x in zip(*lists, strict=True))
        offset = np.concatenate(([0], np.cumsum(last - first)))
        seen = np.zeros(offset[-1], bool)
        best, read, depth = np.zeros(len(lists), np.int64), 0, DEPTH
        met = np.zeros(self.documents, bool)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while True:
            parts = [self.doc[a + read : min(a + read + depth, b)] for a, b in zip(first, last, strict=True)]
            new = np.unique(np.concatenate(parts))
            new = new[~met[new]]
            met[new] = True
            read, depth = read + depth, 2 * depth
            place = self.places(np.repeat(term, len(new)), np.tile(new, len(term))).reshape(len(term), len(new))
            held = place >= 0
            scores = np.append(scores, (np.where(held, self.impact[place], 0) * weight[:, None]).sum(axis=0))
            docs = np.append(docs, new)
            seen[(place - first[:, None] + offset[:-1, None])[held]] = True
            limit = 0
            for i, (a, b) in enumerate(zip(offset[:-1].tolist(), offset[1:].tolist(), strict=True)):
                tail = seen[a + best[i] : b]
                gap = int(tail.argmin()) if len(tail) and not tail.all() else len(tail)
                best[i] += gap
                if best[i] < b - a:
                    # Sorted access has read one position at least, so there is a seen prefix.
                    limit += int(weight[i]) * int(self.impact[first[i] + best[i] - 1])
            if limit == 0 or (len(scores) >= k and np.partition(scores, len(scores) - k)[len(scores) - k] > limit):
                break
        top = np.lexsort((ids[docs], -scores))[:k]
        top = top[scores[top] > 0]
        return docs[top], scores[top]


def _statistics(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[int, int, list[int]]:
    """Documents with a term, terms in all of them, and the documents that hold each of ``vocabulary``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holders, totals = np.zeros(len(vocabulary), np.int64), [0, 0]
        for batch in pieces(batches, 0, PIECE):
            for text in batch.column(0).cast(pa.large_binary()):
                n, held = 0, set()
                for part in terms(text.as_py()):
                    n += len(part)
                    held.update(map(vocabulary.get, part))
                held.discard(None)
                holders[list(held)] += 1
                totals = [totals[0] + (n > 0), totals[1] + n]
        which = np.flatnonzero(holders)
        rows = {"term": [-2, -1, *which.tolist()], "n": [*totals, *holders[which].tolist()]}
        yield pa.RecordBatch.from_pydict(rows, pa.schema([("term", pa.int32()), ("n", pa.int64())]))

    # A row for each term of the block and two totals: bounded by ITEM_BYTES.
    counted = docs.select("text").mapInArrow(lean(count), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counted.collect()}
    return found.get(-2, 0), found.get(-1, 0), [found.get(i, 0) for i in range(len(vocabulary))]


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(item, ``rank``, document, ``score``): each item's ``k`` documents with the highest scores above 0.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. N is the number of
    documents with a term, L all their terms, df the documents that hold a term; a term's weight is
    floor(1000 ln((2 N + 2) / (2 df + 1))). A document with n terms, a term tf times among them, has for
    it the impact 10^9 tf div (1000 tf + 12 m), m = 75 + 25 n N div L; its score is the sum of weight
    times impact over the item's terms, repeats included. Equal scores are ranked by document id.

    Documents are counted where they lie, once for the statistics of all of them. Then each task builds
    impact lists of the items' terms, shard after shard of bounded size, and reads them by the Best
    Position Algorithm for every item. Only the best ``k`` of each shard and item travel. Items
    go in blocks of bounded size, each with passes of its own.

    Defined results: NULL, empty and term-less texts are no documents and are never found; every row is a
    document of its own, repeated ones get ranks of their own; a NULL document id comes behind equal
    scores; rows of one item id (NULL is one too) with the same text count once, with different texts
    their terms add up; an item without terms, or whose terms no document holds, has no rows.
    """
    docs = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"))
    items = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).distinct()
    kind = items.schema["item"].dataType
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // ITEM_BYTES + 1
    ranked = []
    for block in range(blocks):
        wanted = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        # At most about ITEM_BYTES of text.
        counts: dict[object, Counter] = {}
        for row in wanted.collect():
            for part in terms((row["text"] or "").encode()):
                counts.setdefault(row["item"], Counter()).update(part)
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counts.values())))}
        n, length, holders = _statistics(docs, vocabulary)
        weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) if df else 0 for df in holders]
        names = list(counts)
        weights = [{i: c * weight[i] for t, c in counts[name].items() if weight[i := vocabulary[t]] > 0} for name in names]
        found = docs.mapInArrow(lean(_searcher(vocabulary, weights, n, length, k)), "entry int, id long, score long")
        known = docs.sparkSession.createDataFrame(list(enumerate(names)), f"entry int, item {kind.simpleString()}")
        ranked.append(found.join(F.broadcast(known), "entry").select("item", "id", "score"))
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    bucket = F.pmod(F.xxhash64("id"), F.lit(MERGE_BUCKETS))
    best = reduce(DataFrame.unionAll, ranked).withColumn("bucket", bucket)
    for keys in (["item", "bucket"], ["item"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return best.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _searcher(vocabulary: dict[bytes, int], weights: list[dict[int, int]], n: int, length: int, k: int):
    """A step from (text, id) to the best ``k`` (entry, id, score) of each entry in each shard."""

    def ranked(ids: list, m: list[int], postings: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        term, doc, tf = np.concatenate(postings, axis=1)
        shard = Shard(term, doc, tf, np.array(m, np.int64))
        # NULL ids come last and stay apart from all others.
        order = np.array([np.iinfo(np.int64).max if i is None else i for i in ids], np.int64)
        entries, found, scores = [], [], []
        for entry, mine in enumerate(weights):
            best, score = shard.best(mine, k, order)
            entries += [entry] * len(best)
            found += [ids[i] for i in best.tolist()]
            scores += score.tolist()
        columns = [pa.array(entries, pa.int32()), pa.array(found, pa.int64()), pa.array(scores, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["entry", "id", "score"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, m, postings, held = [], [], [], 0
        for batch in pieces(batches, 0, PIECE):
            for text, i in zip(batch.column(0).cast(pa.large_binary()), batch.column(1).to_pylist(), strict=True):
                words, tf = 0, Counter()
                for part in terms(text.as_py()):
                    words += len(part)
                    tf.update(map(vocabulary.get, part))
                tf.pop(None, None)
                if not tf:
                    continue
                doc = np.full(len(tf), len(ids), np.int64)
                postings.append(np.array([[*tf], doc, [*tf.values()]], np.int64))
                ids.append(i)
                m.append(75 + 25 * words * n // length)
                held += len(tf)
                if held >= SHARD_POSTINGS:
                    yield from ranked(ids, m, postings)
                    ids, m, postings, held = [], [], [], 0
        if ids:
            yield from ranked(ids, m, postings)

    return search
