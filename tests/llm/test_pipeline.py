"""Each stage on its own input against brute force, and the whole against the stages."""

import hashlib

import corpus_pipeline
from test_simhash import slow_components, slow_print

from thermopolis.llm import decontaminate, lines, tokens, toxicity
from thermopolis.llm.queries import held_out, table, word_bpe


def words(text):
    return text.lower().split()


def best_similarity(text, item):
    """Of all windows of the item's size, by weighted shingles."""
    from collections import Counter

    doc, it = words(text), words(item)
    k = min(5, len(it))
    grams = lambda w: Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    theirs, best = grams(it), 0.0
    shared = set(theirs)
    if not shared & set(grams(doc)):
        return 0.0
    for start in range(max(1, len(doc) - len(it) + 1)):
        mine = grams(doc[start : start + len(it)])
        both = sum((mine & theirs).values())
        best = max(best, both / (sum(mine.values()) + sum(theirs.values()) - both))
    return best


def test_stages(spark, sf_dir, con):
    benchmark = [t for (t,) in con.execute("SELECT text FROM benchmark").fetchall()]
    library = tokens.load(word_bpe())
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        after = {r.doc_id: r for r in out.collect()}
        if name == "toxicity":
            labels = table(spark, sf_dir, "labels").where(~held_out())
            good = toxicity.score(docs, labels).where("predicted = 0")
            assert set(after) == {r.doc_id for r in good.collect()} and 0 < len(after) < len(before)
            assert all(after[i] == before[i] for i in after)
        elif name == "line_dedup":
            assert set(after) == set(before)
            hosts, pages = {}, {}
            for r in before.values():
                hosts[r.source] = hosts.get(r.source, 0) + 1
                for line in set(r.text.split("\n")):
                    pages[r.source, line] = pages.get((r.source, line), 0) + 1
            bad = {k for k, n in pages.items() if n >= lines.MIN_PAGES and n > lines.MAX_RATIO * hosts[k[0]] and k[1].strip(" \t\n\v\f\r")}
            for i, r in after.items():
                assert r.text == "\n".join(x for x in before[i].text.split("\n") if (r.source, x) not in bad)
                assert r.n_chars == len(r.text)
        elif name == "simhash_near_dedup":
            ids = sorted(before)
            prints = [slow_print(before[i].text) for i in ids]
            assert set(after) == set(slow_components(ids, prints))
        elif name == "benchmark_decontamination":
            leaks = {i for i, r in before.items() if any(best_similarity(r.text, b) >= decontaminate.MIN_SIMILARITY for b in benchmark)}
            assert set(after) == set(before) - leaks
        else:
            assert set(after) == set(before)
            for i, r in after.items():
                ids = library.encode(before[i].text, add_special_tokens=False).ids
                assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        if name != "bpe":
            assert out.columns == columns
            docs = spark.createDataFrame(out.collect(), out.schema)
            before = after
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(whole) == sorted(after.values())


def test_stages_take_odd_rows(spark, odd, empty, sf_dir):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            rows = out.collect()
            if name != "bpe":
                assert out.columns == docs.columns
            if name in ("toxicity", "line_dedup", "bpe"):
                assert len(rows) == docs.count()
            if docs is odd and name == "simhash_near_dedup":
                assert sorted((r.doc_id for r in rows), key=str) == sorted([0, 3, 5, 6, 7, None, None], key=str)
