"""Token counts as the tokenizers library gives them, huge documents in overlapping chunks."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopolis.llm.common import lean, pieces
from thermopolis.llm.words import MEMO_ROWS, splitter, worker_memo

#: Documents with more characters are encoded in chunks of so many.
CHUNK = 65_536
OVERLAP = 1_024
#: So many tokens after a boundary must agree in both encodings.
AGREE = 8
PIECE = 4 << 20


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The id, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row of ``docs``.

    ``tokenizer`` is a file of the tokenizers library whose pre-tokenizer drops white space (a BPE with
    word ends). Up to ``chunk`` characters a text's count is the sum over its words, each counted by
    the library and remembered by the worker. A longer text is encoded whole in overlapping chunks,
    see ``count_long``; its encodings are held two chunks at a time.

    Defined results: NULL and empty texts have 0 bytes and 0 tokens; repeated rows come out once each;
    a NULL id passes; special strings inside texts count as the library's default has them.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = load(tokenizer)
        split = splitter()
        memo, counts = worker_memo(f"runs {tokenizer}"), worker_memo(f"counts {tokenizer}")

        def learn(runs: set[bytes]) -> None:
            if len(memo) + len(runs) > MEMO_ROWS:
                memo.clear()
            if len(counts) > 2 * MEMO_ROWS:
                counts.clear()
            new = [x for x in runs if x not in memo]
            words = [split(run := x.decode()) or [run] for x in new]
            unseen = list({w for ws in words for w in ws if w not in counts})
            for at in range(0, len(unseen), 20_000):
                part = unseen[at : at + 20_000]
                counts.update(zip(part, map(len, library.encode_batch_fast(part, add_special_tokens=False)), strict=True))
            memo.update((x, sum(map(counts.__getitem__, ws))) for x, ws in zip(new, words, strict=True))

        for batch in pieces(batches, 1, PIECE):
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            long = [x is not None and len(x) > chunk and len(x.decode()) > chunk for x in texts]
            runs = [[] if is_long or not x else x.split() for x, is_long in zip(texts, long, strict=True)]
            learn({w for ws in runs for w in ws})
            n_tokens = [
                count_long(library, x.decode(), chunk, overlap) if is_long else sum(map(memo.__getitem__, ws))
                for x, ws, is_long in zip(texts, runs, long, strict=True)
            ]
            n_bytes = [len(x or b"") for x in texts]
            columns = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_tokens"])

    counted = docs.mapInArrow(lean(run), f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def count_long(library, text: str, chunk: int, overlap: int) -> int:
    """Encode chunk after chunk and splice the encodings where both are proven right.

    Two neighbours overlap. A boundary is taken where a token starts in both encodings right after
    white space, which this kind of tokenizer never crosses, and the next tokens agree in id and
    place: what is left of it the first chunk has whole, what is right of it the second. Where no such
    boundary exists the overlap is doubled, and once it spans the chunk, the chunk grows instead, up
    to the whole text.
    """

    def encode(start: int, end: int) -> list[tuple[int, int, int]]:
        found = library.encode(text[start:end], add_special_tokens=False)
        return [(start + a, start + b, i) for (a, b), i in zip(found.offsets, found.ids, strict=True)]

    total, counted_to, start, end = 0, 0, 0, min(chunk, len(text))
    left = encode(start, end)
    while end < len(text):
        width, cut = overlap, None
        while cut is None:
            begin = max(end - width, start)
            if begin <= counted_to:
                end = min(end + chunk, len(text))
                left = encode(start, end)
                if end == len(text):
                    break
                width = overlap
                continue
            to = min(begin + max(chunk, 2 * width), len(text))
            right = encode(begin, to)
            cut = boundary(text, left, right, begin, end)
            width *= 2
        if cut is None:
            break
        total += sum(counted_to <= a < cut for a, _, _ in left)
        counted_to, start, end, left = cut, begin, to, right
    return total + sum(a >= counted_to for a, _, _ in left)


def boundary(text: str, left: list, right: list, begin: int, end: int) -> int | None:
    """The first place after ``begin`` where both encodings are proven to agree, or None."""
    last = max((a for a, _, _ in left), default=begin)
    ours = [t for t in left if begin < t[0] and t[1] < end and t[0] < last]
    theirs = {t[0]: i for i, t in reversed(list(enumerate(right))) if t[0] <= end}
    for at, token in enumerate(ours):
        place = token[0]
        if not text[place - 1].isspace() or place not in theirs or (at and ours[at - 1][0] == place):
            continue
        ahead = ours[at : at + AGREE]
        if len(ahead) == AGREE and right[theirs[place] : theirs[place] + AGREE] == ahead:
            return place
    return None
