"""The words of a BPE tokenizer with word ends: lower-cased, white space dropped, one by one merged.

White space never is part of a token there, so the runs between it are encoded each on its own.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Fixed value: the tokenizer file's own split pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters whose case, class and normal form need no table of the library's.
PLAIN = re.compile("[!-~\xa1-ſ]+")
SPECIAL = "<|"
MEMO_ROWS = 400_000


def worker_memo(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, so that its next task finds it filled."""
    return sys.modules.setdefault(f"_memo_{name}", types.ModuleType(f"_memo_{name}")).__dict__.setdefault("rows", {})


def make_room(memo: dict, new: int, most: int = MEMO_ROWS) -> None:
    """Forget the newer half if ``new`` rows do not fit: what came first is what is frequent."""
    if len(memo) + new > most:
        for key in list(memo)[len(memo) // 2 :]:
            del memo[key]


def runs_of(text: bytes | None) -> list[bytes]:
    """A text's runs between ASCII white space, A-Z lower-cased unless a special token may be inside."""
    text = text or b""
    return (text if SPECIAL.encode() in text else text.lower()).split()


def splitter():
    """A function from a run without ASCII white space to its words, None if only the library may tell."""
    find = regex.compile(PATTERN).findall

    def words(run: str) -> list[str] | None:
        if SPECIAL in run or not PLAIN.fullmatch(run):
            return None
        run = run.lower()
        # Letters alone are one word, with a single other sign behind them two.
        if run.isalpha():
            return [run]
        if run[:-1].isalpha() and not run[-1].isalnum():
            return [run[:-1], run[-1]]
        return find(run)

    return words


def runs_in(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The runs between ASCII white space of all texts, as ``runs_of`` has them: where each text's runs
    end, each run's place among the different ones, and those. The empty run may be among them."""
    texts = pc.fill_null(texts, "")
    special = pc.match_substring(texts, SPECIAL)
    lists = pc.ascii_split_whitespace(pc.if_else(special, texts, pc.ascii_lower(texts)))
    coded = lists.flatten().dictionary_encode()
    ends = lists.offsets.to_numpy().astype(np.int64)
    del lists
    return ends - ends[0], coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.cast(pa.binary()).to_pylist()


class Merger:
    """The merges of a tokenizer file, applied to one word exactly as its library does."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        pairs = (tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"])
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.ids = model["vocab"]
        self.end = model["end_of_word_suffix"]
        # Byte-level BPE writes printable bytes as themselves, the others from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def __call__(self, word: str) -> list[int]:
        parts = [self.letters[b] for b in word.encode()]
        parts[-1] += self.end
        rank, none = self.rank.get, len(self.rank)
        ranks = [rank(pair, none) for pair in zip(parts, parts[1:])]  # noqa: B905
        while ranks and (least := min(ranks)) < none:
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), none)
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), none)
        return [self.ids[part] for part in parts]


class BatchMerger(Merger):
    """The same merges for many words at once: words of one length are rows of a matrix, and each step
    merges every row's first pair of the least rank."""

    #: Longer words are merged one by one, through a queue of their pairs.
    LONGEST = 40

    def __init__(self, path: str):
        super().__init__(path)
        ids = self.ids
        pairs = np.array([(ids[a], ids[b], r, ids[a + b]) for (a, b), r in self.rank.items()], np.int64).reshape(-1, 4)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], pairs[order, 2], pairs[order, 3]
        self.by_pair: dict[int, tuple[int, int]] | None = None
        self.inner = np.array([ids[self.letters[b]] for b in range(256)], np.int64)
        self.last = np.array([ids[self.letters[b] + self.end] for b in range(256)], np.int64)

    def _pairs(self, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and place of each pair of neighbours; pairs that do not merge have the rank of none."""
        want = signs[:, :-1] << 32 | signs[:, 1:]
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.ranks[at], len(self.rank)), at

    def one(self, word: bytes) -> list[int]:
        """The ids of a word of any length: its pairs by rank, then place, those that are gone skipped."""
        if self.by_pair is None:
            self.by_pair = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist(), strict=True), strict=True))
        signs = [*self.inner[list(word[:-1])].tolist(), int(self.last[word[-1]])]
        after, before, queue = list(range(1, len(signs) + 1)), list(range(-1, len(signs) - 1)), []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < len(signs):
                key = signs[at] << 32 | signs[after[at]]
                if hit := self.by_pair.get(key):
                    heapq.heappush(queue, (hit[0], at, key, hit[1]))

        for at in range(len(signs)):
            offer(at)
        while queue:
            _, at, key, made = heapq.heappop(queue)
            right = after[at]
            if signs[at] < 0 or right >= len(signs) or signs[at] << 32 | signs[right] != key:
                continue
            signs[at], signs[right] = made, -1
            after[at] = after[right]
            if after[at] < len(signs):
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [x for x in signs if x >= 0]

    def all(self, words: list[str]) -> list[list[int]]:
        """The ids of each word."""
        out: list[list[int]] = [[] for _ in words]
        by_length: dict[int, list[int]] = {}
        coded = [w.encode() for w in words]
        for i, word in enumerate(coded):
            by_length.setdefault(len(word), []).append(i)
        for length, places in by_length.items():
            if length > self.LONGEST or not len(self.keys):
                for i in places:
                    out[i] = self.one(coded[i])
                continue
            letters = np.frombuffer(b"".join([coded[i] for i in places]), np.uint8).reshape(len(places), length)
            signs = np.concatenate((self.inner[letters[:, :-1]], self.last[letters[:, -1:]]), axis=1)
            rows = np.array(places)
            while len(rows):
                if signs.shape[1] == 1:
                    done = np.ones(len(rows), bool)
                else:
                    ranks, at = self._pairs(signs)
                    first = ranks.argmin(axis=1)
                    here = np.arange(len(rows))
                    done = ranks[here, first] == len(self.rank)
                for i, found in zip(rows[done].tolist(), signs[done].tolist(), strict=True):
                    out[i] = found
                if done.all():
                    break
                left, rows = signs[~done], rows[~done]
                first, at = first[~done], at[~done]
                here = np.arange(len(rows))
                left[here, first] = self.made[at[here, first]]
                columns = np.arange(left.shape[1] - 1)
                signs = np.take_along_axis(left, columns + (columns > first[:, None]), axis=1)
        return out
