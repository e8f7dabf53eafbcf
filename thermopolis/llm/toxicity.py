"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopolis.llm.common import map_arrow, materialize, pieces
from thermopolis.llm.words import make_room

#: The bounded sample of labelled rows: about so many documents, chosen by a hash of their id.
MAX_EXAMPLES = 12_000
#: The most telling words and word beginnings of the sample span the vectors, if in at least so many texts ...
MAX_TERMS = 4_000
MIN_TERM_DOCS = 5
#: ... and in at least so large a share of the sample's texts.
MIN_TERM_SHARE = 0.0015
#: A term's share of toxic documents, against that of all.
MIN_LIFT = 3.0
PREFIXES = range(3, 8)
NEIGHBOURS = 25
BLOCK = 64
#: Weight of the share of toxic examples beside the neighbours' votes.
PRIOR = 0.5
EVIDENCE = 3
PIECE = 4 << 20
MEMO_ROWS = 150_000
#: Longer runs are not remembered.
LONGEST_RUN = 64
#: What the index remembers, by an estimate of its bytes.
MEMO_BYTES = 32 << 20
EVIDENCE_TYPE = "array<struct<example_id:long,cosine:double,toxic_share:double>>"

WORD = re.compile(r"\w+")


def terms_of(run: str) -> list[str]:
    """The words of a run without white space, and their beginnings with a star."""
    words = WORD.findall(run.lower())
    return words + [w[:n] + "*" for w in words for n in PREFIXES if len(w) > n]


class Vectorizer:
    """Term frequencies of a text over a fixed list of terms, remembering runs it has seen."""

    def __init__(self, terms: list[str]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.memo: dict[bytes, tuple[int, ...]] = {}

    def __call__(self, text: bytes | None) -> dict[int, int]:
        found: Counter[int] = Counter()
        runs, memo, number = (text or b"").split(), self.memo, self.number
        new = set(runs).difference(memo)
        make_room(memo, len(new), MEMO_ROWS)
        for run in new:
            if len(run) <= LONGEST_RUN:
                memo[run] = tuple(number[t] for t in terms_of(run.decode()) if t in number)
        get = memo.get
        for run in runs:
            if hit := get(run):
                found.update(hit)
            elif hit is None:  # a long run, or one of a text with more runs than the memo has room for
                found.update(number[t] for t in terms_of(run.decode()) if t in number)
        return dict(sorted(found.items()))


def unit(found: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    terms = np.fromiter(found, np.int64, len(found))
    weights = (1 + np.log(np.fromiter(found.values(), np.float64, len(found)))) * idf[terms]
    return terms, weights / math.sqrt((weights * weights).sum())


class Index:
    """Distinct example vectors, an inverted list for each term, and each list's maxima by block.

    Examples are ordered by their heaviest terms, so that a block of 64 holds alike ones and its
    maxima are tight. The bound of a block is what the query's weights make of its maxima; blocks are
    opened in the order of their bounds until none can reach the neighbours found.
    """

    def __init__(self, examples: list[tuple[int | None, dict[int, int], int, int]], idf: np.ndarray):
        """``examples``: id, term frequencies, rows with that text, toxic ones among them."""
        merged: dict[tuple, list] = {}
        for name, found, rows, toxic in examples:
            entry = merged.setdefault(tuple(found.items()), [name, 0, 0])
            entry[0] = min((x for x in (entry[0], name) if x is not None), default=None)
            entry[1] += rows
            entry[2] += toxic
        self.nothing = merged.pop((), [None, 0, 0])
        self.idf = idf
        self.rows, self.toxic = (sum(e[i] for e in merged.values()) + self.nothing[i] for i in (1, 2))
        vectors = [(unit(dict(k), idf), e) for k, e in merged.items()]
        vectors.sort(key=lambda v: (v[0][0][np.argsort(-v[0][1], kind="stable")].tolist(), v[1][0] is None, v[1][0] or 0))
        self.names = [e[0] for _, e in vectors]
        self.counts = np.array([e[1:] for _, e in vectors], np.float64).reshape(-1, 2)
        sizes = [len(v[0]) for v, _ in vectors]
        term = np.concatenate([v[0] for v, _ in vectors] or [np.zeros(0, np.int64)])
        weight = np.concatenate([v[1] for v, _ in vectors] or [np.zeros(0)])
        example = np.repeat(np.arange(len(vectors)), sizes)
        order = np.lexsort((example, term))
        term, self.weight, self.example = term[order], weight[order], example[order]
        self.blocks = -(-len(vectors) // BLOCK)
        part = term * max(self.blocks, 1) + self.example // BLOCK
        self.part, self.part_at = np.unique(part, return_index=True)
        self.part_end = np.append(self.part_at[1:], len(part))
        self.part_max = np.maximum.reduceat(self.weight, self.part_at) if len(part) else np.zeros(0)
        self.memo: dict[tuple, tuple[float, list]] = {}
        self.memo_bytes = 0

    def nearest(self, found: dict[int, int], k: int) -> list[tuple[float, int]]:
        """The ``k`` examples of the largest cosine, exactly; of equal ones those that stand first."""
        terms, weights = unit(found, self.idf)
        begin = np.searchsorted(self.part, terms * self.blocks)
        end = np.searchsorted(self.part, (terms + 1) * self.blocks)
        chosen = np.concatenate([np.arange(a, b) for a, b in zip(begin, end, strict=True)])
        by_term = np.repeat(weights, end - begin)
        block = self.part[chosen] % self.blocks
        bound = np.bincount(block, by_term * self.part_max[chosen], self.blocks)
        best: list[tuple[float, int]] = []
        for at in np.argsort(-bound, kind="stable").tolist():
            if bound[at] <= 0 or len(best) == k and bound[at] < -best[-1][0] - 1e-9:
                break
            cosines = np.zeros(BLOCK)
            for i in np.flatnonzero(block == at).tolist():
                a, b = self.part_at[chosen[i]], self.part_end[chosen[i]]
                cosines[self.example[a:b] - at * BLOCK] += by_term[i] * self.weight[a:b]
            hits = np.flatnonzero(cosines)
            best = sorted(best + [(-c, e) for c, e in zip(np.round(cosines[hits], 12).tolist(), (hits + at * BLOCK).tolist(), strict=True)])[:k]
        return [(-c, e) for c, e in best]

    def score(self, found: dict[int, int], k: int) -> tuple[float, list[dict]]:
        """Votes of the neighbours, weighted by the square of the cosine; the evidence beside it."""
        if not self.rows:
            return 0.0, []
        share = self.toxic / self.rows
        if not found:
            _, rows, toxic = self.nothing
            return (toxic + PRIOR * share) / (rows + PRIOR), []
        key = tuple(found.items())
        if key not in self.memo:
            near = self.nearest(found, k)
            weight = np.array([c * c for c, _ in near])
            counts = self.counts[[e for _, e in near]].reshape(-1, 2)
            value = float((weight @ counts[:, 1] + PRIOR * share) / (weight @ counts[:, 0] + PRIOR)) if near else share
            shown = [
                {"example_id": self.names[e], "cosine": c, "toxic_share": float(self.counts[e, 1] / self.counts[e, 0])}
                for c, e in near[:EVIDENCE]
            ]
            size = 1500 + 150 * len(key)
            if self.memo_bytes + size > MEMO_BYTES:
                self.memo.clear()
                self.memo_bytes = 0
            self.memo[key] = (value, shown)
            self.memo_bytes += size
        return self.memo[key]


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, max_terms: int = MAX_TERMS) -> tuple[list[str], Index]:
    """The terms and the index, from ``labels`` (doc_id, toxic) that may be learnt from.

    The sample is about ``max_examples`` labelled documents by a hash of the id, which bounds all that
    is broadcast or reaches the driver; equal texts are one example. Document frequencies behind the
    weights count all of ``docs``.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, max_examples / max(1, known.count()))
    sample = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    examples = (
        texts.join(F.broadcast(sample), "doc_id")
        .groupBy("text")
        .agg(F.min("doc_id").alias("name"), F.count(F.lit(1)).alias("rows"), F.sum("toxic").alias("toxic"))
    )
    counts = map_arrow(examples.select("text", "rows", "toxic"), _term_counts, "term string, n long, toxic long")
    counts = materialize(counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")))
    total = counts.where("term = ''").select("n", "toxic").first()
    if total is None or not total.toxic:
        return [], Index([(None, {}, total.n if total else 0, 0)], np.zeros(0))
    n, toxic = F.col("n"), F.col("toxic")
    rate = total.toxic / total.n
    expected = n * rate
    chosen = (
        counts.where((n >= max(MIN_TERM_DOCS, MIN_TERM_SHARE * total.n)) & (toxic >= n * min(MIN_LIFT * rate, 0.9)) & (F.col("term") != ""))
        .orderBy(F.desc((toxic - expected) * (toxic - expected) / expected), "term")
        .limit(max_terms)
    )
    terms = sorted(r.term for r in chosen.select("term").collect())

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector, seen, rows = Vectorizer(terms), Counter(), 0
        for batch in pieces(batches, 0, PIECE):
            for text in batch.column(0).cast(pa.large_binary()).to_pylist():
                seen.update(vector(text).keys())
                rows += 1
        seen[-1] = rows
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.int64())], ["term", "n"])

    df = map_arrow(texts.select("text"), frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = {r.term: r.n for r in df.collect()}  # max_terms rows and one
    idf = np.array([math.log((1 + df[-1]) / (1 + df.get(i, 0))) + 1 for i in range(len(terms))])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = Vectorizer(terms)
        for batch in pieces(batches, 1, PIECE):
            found = [vector(x) for x in batch.column(1).cast(pa.large_binary()).to_pylist()]
            arrays = [pa.array([list(f) for f in found], pa.list_(pa.int64())), pa.array([list(f.values()) for f in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, batch.column(2), batch.column(3)], ["name", "terms", "times", "rows", "toxic"])

    schema = "name long, terms array<long>, times array<long>, rows long, toxic long"
    rows = examples.select(F.col("name").cast("long"), "text", "rows", F.col("toxic").cast("long"))
    rows = map_arrow(rows, vectors, schema).collect()
    return terms, Index([(r.name, dict(zip(r.terms, r.times, strict=True)), r.rows, r.toxic) for r in rows], idf)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, texts with it, toxic ones among them) of a task's texts; the term "" counts all."""
    n, toxic = Counter(), Counter()
    for batch in pieces(batches, 0, PIECE):
        for text, rows, bad in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
            terms = {t for run in set(text.split()) for t in terms_of(run)} | {""}
            n.update(terms)
            if 2 * bad >= rows:
                toxic.update(terms)
    yield pa.RecordBatch.from_arrays(
        [pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64()), pa.array([toxic[t] for t in n], pa.int64())],
        ["term", "n", "toxic"],
    )


def score(
    docs: DataFrame,
    labels: DataFrame,
    max_examples: int = MAX_EXAMPLES,
    max_terms: int = MAX_TERMS,
    neighbours: int = NEIGHBOURS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The id, ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``evidence`` of every document.

    Documents and examples are vectors of TF-IDF weights over the terms that tell toxic examples
    from others: words, and word beginnings of three to seven letters. The score is the vote of the
    nearest distinct example vectors, with the square of the cosine as weight and a small weight on
    the share of toxic examples, so that remote neighbours decide nothing. ``evidence`` names the
    three nearest. Only the text enters a score.

    Defined results: NULL and empty texts, and texts without any of the terms, get the share of toxic
    ones among the examples without any; without labelled examples every score is 0; labels that are
    NULL or contradict (the larger wins) and repeated rows are allowed; an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    terms, index = fit(docs, labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")), max_examples, max_terms)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = Vectorizer(terms)
        for batch in pieces(batches, 1, PIECE):
            found = [index.score(vector(x), neighbours) for x in batch.column(1).cast(pa.large_binary()).to_pylist()]
            scores = np.array([s for s, _ in found])
            shown = pa.array([e for _, e in found], EVIDENCE_ARROW)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), shown],
                ["doc_id", "score", "predicted", "evidence"],
            )

    scored = map_arrow(docs, run, f"doc_id {kind}, score double, predicted int, evidence {EVIDENCE_TYPE}")
    return scored.withColumnRenamed("doc_id", id_col)


def reject(
    docs: DataFrame,
    labels: DataFrame,
    max_examples: int = MAX_EXAMPLES,
    max_terms: int = MAX_TERMS,
    neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) that ``score`` does not predict toxic.

    Rows are dropped where they are scored, so no text is shuffled for it.
    """
    terms, index = fit(docs, labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")), max_examples, max_terms)
    column = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = Vectorizer(terms)
        for batch in pieces(batches, column, PIECE):
            texts = batch.column(column).cast(pa.large_binary()).to_pylist()
            yield batch.filter(pa.array([index.score(vector(x), neighbours)[0] < 0.5 for x in texts]))

    return map_arrow(docs, run, docs.schema)


EVIDENCE_ARROW = pa.list_(pa.struct([("example_id", pa.int64()), ("cosine", pa.float64()), ("toxic_share", pa.float64())]))
