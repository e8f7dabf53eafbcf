"""Ranked search against scores of all documents; the query against SQL is in test_with_sql."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from thermopolis.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def slow_rank(docs, items, k):
    held = [(i, Counter(t)) for i, text in docs if (t := terms(text))]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    out = set()
    wanted = {}
    for item, text in dict.fromkeys(items):
        wanted.setdefault(item, Counter()).update(terms(text))
    for item, counts in wanted.items():
        found = []
        for i, tf in held:
            m = 75 + 25 * sum(tf.values()) * n // length
            score = 0
            for t, c in counts.items():
                df = sum(t in other for _, other in held)
                if tf[t]:
                    score += c * math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
            if score > 0:
                found.append((-score, math.inf if i is None else i))
        out |= {(item, r + 1, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(found)[:k])}
    return out


ITEMS = [(1, "The quick BROWN fox"), (1, "The quick BROWN fox"), (2, "word, word! Über"), (3, None), (4, "zzz"), (None, "x y z"), (5, "naïve façade 中文"), (6, "")]


@pytest.mark.parametrize("postings, k", [(1 << 20, 20), (5, 3), (1, 1)])
def test_search_is_brute_force(spark, odd, monkeypatch, postings, k):
    monkeypatch.setattr(search, "SHARD_POSTINGS", postings)
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    docs += [(100 + i, ("the " * (i % 4) + "fox quick " * (i % 3) + "brown x-y " * (i % 2) + "same " * (i % 7))) for i in range(60)]
    docs += [(9, "The same fox"), (8, "The same fox"), (7, "the SAME fox")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [tuple(r) for r in search.rank_documents(frame, items, k).collect()]
    assert set(rows) == slow_rank(docs, ITEMS, k) and len(rows) == len(set(rows))


def test_blocks_of_items_give_the_same_rows(spark, sf_dir, con, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, search.rank_documents(docs, items, 5).collect()))
    monkeypatch.setattr(search, "ITEM_BYTES", 2000)
    assert sorted(map(tuple, search.rank_documents(docs, items, 5).collect())) == whole and len(whole) > 100


def test_no_documents_and_no_items(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search.rank_documents(empty, items).collect() == []
    assert search.rank_documents(odd, items.limit(0)).collect() == []
    assert search.rank_documents(odd.where("text is null"), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_reading_stops_before_the_ends_of_the_lists(monkeypatch):
    """The best documents stand at the heads of all lists: few positions are read."""
    size = 20_000
    term = np.repeat(np.arange(4), size)
    doc = np.tile(np.arange(size), 4)
    tf = np.where(doc < 30, 50 + doc, 1)
    shard = search.Shard(term, doc, tf, np.full(size, 100 + np.arange(size) % 5))
    asked = []
    places = shard.places
    monkeypatch.setattr(shard, "places", lambda t, d: asked.append(len(d)) or places(t, d))
    docs, scores = shard.best({0: 3, 1: 5, 2: 1, 3: 2}, 20, np.arange(size))
    assert docs.tolist() == list(range(29, 9, -1)) and (np.diff(scores) < 0).all()
    assert sum(asked) < size


def test_equal_scores_keep_the_smaller_ids():
    size = 3000
    shard = search.Shard(np.zeros(size, np.int64), np.arange(size), np.ones(size, np.int64), np.full(size, 100))
    docs, _ = shard.best({0: 7}, 20, np.arange(size)[::-1].copy())
    assert docs.tolist() == list(range(size - 1, size - 21, -1))
