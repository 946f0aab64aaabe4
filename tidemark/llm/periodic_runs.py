"""Periodic runs of words, and texts with each run cut down to its first period.

A run is a stretch of words with smallest period q and at least two periods that cannot be made longer. Every run has a
Lyndon root: for one of the two orders of the alphabet, the longest Lyndon word that begins at some position of the run is as
long as its period. So it is enough to know the longest Lyndon word at every position under both orders, and to extend each
by longest common extensions to the left and right.

The Lyndon words come from phase one of Baier's suffix sorter (`lyndon_lengths`): suffixes are grouped by first symbol and
the groups are taken from the highest down; each group lengthens the contexts of the nearest lower suffixes before its
members. A group's context is, when the group's turn comes, the longest Lyndon word at each of its suffixes.

Before that, words that cannot lie in a run are set aside exactly: in a run of at least `min_length` words and two
periods, every word is covered by an n-gram of min_length // 2 words that occurs elsewhere in the document.

Rows are independent, so there is no shuffle; memory follows a batch of ROWS rows or the longest text.
Defined results: a null or blank text has no runs and an empty collapsed text. Repeated rows and null keys give a row each. Other
columns stay; n_words, runs and collapsed replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import schema_with
from tidemark.llm.kernels import shingles

MIN_LENGTH = 12
ROWS, WORDS = 2_000, 400_000


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each position. Symbols are 0 .. k - 1."""
    n = len(symbols)
    if not n:
        return []
    members: list[list[int]] = [[] for _ in range(max(symbols) + 1)]
    for i, s in enumerate(symbols):
        members[s].append(i)
    count = len(members)
    below, above = list(range(-1, count - 1)), [*range(1, count), -1]
    context = [1] * count
    group = list(symbols)
    left = list(range(-1, n))  # left[i + 1]: a position at or before i that may still be unfinished; itself while unfinished
    out = [0] * n
    now = count - 1
    while now >= 0:
        own = [i for i in members[now] if group[i] == now]
        members[now] = []
        length = context[now]
        for i in own:
            out[i] = length
            left[i + 1] = left[i]
        repeats: dict[int, int] = {}
        for i in own:
            at = i + 1
            while (to := left[at]) != at - 1:  # follow finished positions, halving the path
                left[at] = left[to + 1]
                at = to + 1
            if at:
                repeats[at - 1] = repeats.get(at - 1, 0) + 1
        if len(repeats) == 1:
            moves = [(next(iter(repeats.values())), *repeats)]
        else:
            moves = sorted(((times, i) for i, times in repeats.items()), reverse=True)
        fresh: dict[tuple[int, int], int] = {}
        for times, i in moves:  # more repeats sort higher, so they are put in first and pushed up by the others
            old = group[i]
            to = fresh.get((old, times))
            if to is None:
                to = fresh[old, times] = len(members)
                members.append([])
                context.append(context[old] + times * length)
                higher = above[old]
                below.append(old)
                above.append(higher)
                above[old] = to
                below[higher] = to
            group[i] = to
            members[to].append(i)
        now = below[now]
    return out


class Extensions:
    """Longest common extensions of pairs of positions, by names of blocks of 1, 2, 4, ... symbols."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self.names = [symbols]
        while (1 << len(self.names)) <= longest:
            last, half = self.names[-1], 1 << (len(self.names) - 1)
            if len(last) <= half:
                break
            both = last[:-half].astype(np.int64) * (int(last.max()) + 1) + last[half:]
            distinct, names = np.unique(both, return_inverse=True)
            self.names.append(names)
            if len(distinct) == len(names):
                break

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal symbols from a and b on, for a < b."""
        return self._extend(a, b, 1)

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal symbols that end at a and b, for a < b."""
        return self._extend(a, b, -1)

    def _extend(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        total = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.names))):
            names, size = self.names[k], 1 << k
            while True:  # only the largest blocks can match more than once
                first, second = (a + total, b + total) if step > 0 else (a - total - size + 1, b - total - size + 1)
                inside = (first >= 0) & (second < len(names))
                same = inside.copy()
                same[inside] = names[first[inside]] == names[second[inside]]
                total += size * same
                if k + 1 < len(self.names) or not same.any():
                    break
        return total


def _stretches(ids: np.ndarray, offsets: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, word after the last) of the stretches that can hold runs; words of different rows differ."""
    size = max(1, min_length // 2)
    grams, at = shingles(ids.astype(np.uint64), offsets, size)
    if not len(grams):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, name, times = np.unique(grams, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    begin = (np.arange(len(grams)) - at[row] + offsets[row])[times[name] > 1]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + size, -1)
    covered = np.cumsum(edge[:-1]) > 0
    fresh = np.zeros(len(ids) + 1, bool)
    fresh[offsets] = True
    start = np.flatnonzero(covered & (fresh[:-1] | ~np.concatenate([[False], covered[:-1]])))
    end = np.flatnonzero(covered & (fresh[1:] | ~np.concatenate([covered[1:], [False]]))) + 1
    long = end - start >= min_length
    return start[long], end[long]


def find_runs(ids: np.ndarray, offsets: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Runs (first word, length, period) of at least min_length words, ordered, in rows of word ids that no two rows share."""
    start, end = _stretches(ids, offsets, min_length)
    if not len(start):
        return np.zeros((0, 3), np.int64)
    size = end - start + 1  # with a symbol in front that is lower than all words, in both orders
    word = np.repeat(start - np.cumsum(size) + size - 1, size) + np.arange(size.sum())
    wall = np.zeros(len(word), bool)
    wall[np.cumsum(size) - size] = True
    _, rank = np.unique(ids[word], return_inverse=True)
    most = int(rank.max())
    lcs = Extensions(np.where(wall, most + 1 + np.cumsum(wall), rank), int(size.max()))
    found = []
    for up in (rank + 1, most + 1 - rank):
        period = np.array(lyndon_lengths(np.where(wall, 0, up).tolist()), np.int64)
        i = np.flatnonzero(~wall & (np.arange(len(word)) + period <= len(word)))
        q = period[i]
        front = np.minimum(i + q, len(word) - 1)
        live = ((i + q < len(word)) & (rank[front] == rank[i]) & ~wall[front]) | ((rank[i + q - 1] == rank[i - 1]) & ~wall[i - 1])
        i, q = i[live], q[live]
        ahead, behind = lcs.forward(i, i + q), lcs.backward(i - 1, i + q - 1)
        length = behind + q + ahead
        keep = length >= np.maximum(min_length, 2 * q)
        found.append(np.stack([word[i - behind], length, q], 1)[keep])
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _batches(texts: list[bytes], keys: list, rewrite: Callable | None, min_length: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """(words, runs) of every text, worked on a few hundred thousand words at a time."""
    pending: list[list[bytes]] = []
    ids: list[int] = []
    offsets = [0]

    def flush() -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
        at = np.array(offsets)
        runs = find_runs(np.array(ids, np.int64), at, min_length)
        row = np.searchsorted(at, runs[:, 0], side="right") - 1
        runs[:, 0] -= at[row]
        cut = np.searchsorted(row, np.arange(len(pending) + 1))
        listed = runs.tolist()
        for k, words in enumerate(pending):
            yield words, [tuple(r) for r in listed[cut[k] : cut[k + 1]]]
        pending.clear()
        ids.clear()
        offsets[1:] = []

    base = 0
    for key, text in zip(keys, texts, strict=True):
        words = text.split()  # bytes split at ASCII white space: 0x20, 0x09 to 0x0D
        if rewrite is not None and words:
            words = rewrite(key, words)
        names: dict[bytes, int] = {}
        ids += [names.setdefault(w, base + len(names)) for w in words]
        base += len(names)
        pending.append(words)
        offsets.append(len(ids))
        if len(ids) >= WORDS:
            yield from flush()
    yield from flush()


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return b" ".join([words[k] for k in np.flatnonzero(keep).tolist()])


def periodic_runs(
    docs: DataFrame, text: str = "text", key: str = "doc_id", min_length: int = MIN_LENGTH, rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """`docs` with n_words, runs and collapsed.

    Words are stretches without ASCII white space. `runs` lists every run of at least min_length words and two periods as
    (start, length, period) in words, by start and period. `collapsed` is the text of the words that no run
    holds after its first period, joined by one space. `rewrite(key, words)` may exchange a text's words before the search."""
    kept = docs.drop("n_words", "runs", "collapsed")
    columns = kept.columns
    of_text, of_key = columns.index(text), columns.index(key)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), ROWS):
                batch = whole.slice(begin, ROWS)
                texts = [t or b"" for t in batch.column(of_text).cast(pa.binary()).to_pylist()]
                n_words, runs, collapsed = [], [], []
                for words, own in _batches(texts, batch.column(of_key).to_pylist(), rewrite, min_length):
                    n_words.append(len(words))
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                    collapsed.append(_collapsed(words, own))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(n_words, pa.int64()), pa.array(runs, kind), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    [*columns, "n_words", "runs", "collapsed"],
                )

    return kept.mapInArrow(run, schema_with(kept, ("n_words", "long"), ("runs", "array<struct<start:long,length:long,period:long>>"), ("collapsed", "string")))
