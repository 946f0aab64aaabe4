"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages of PASSAGE_BLOCKS blocks of BLOCK_WORDS words, a new one at every block. Passages and benchmark
items are TF-IDF vectors over hashed words; a randomised SVD over all passages, its products with the data computed by Spark,
gives a latent basis. A passage is a candidate for an item if its cosine reaches SHARE of the cosine that a passage
holding the whole item would have. Candidates are verified on their words: the longest common subsequence must cover
enough of the item, or somewhat less if it covers the item's answer (its last quarter) as well."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import materialize, tidy
from tidemark.llm.kernels import text_bytes, word_hashes
from tidemark.llm.line_dedup import _soft
from tidemark.llm.shared_arrays import mapped_array, write_array
from tidemark.session import work_folder
from tidemark.sources.files import remove_folder

TERM_BITS = 14
BLOCK_WORDS, PASSAGE_BLOCKS = 32, 3
RANK, EXTRA, ROUNDS = 208, 16, 2
#: Blocks whose passages one row of the fit holds: a long text is many rows. Blocks that a task multiplies together.
ROW_BLOCKS, FIT_BLOCKS = 512, 8192
#: Weight of the items' own vectors in the fit, so that the basis spans them: this, and on many passages as much energy as
#: this share of the passages.
ITEM_WEIGHT, ITEM_SHARE = 10.0, 0.025
#: Words that make up more than this share of all words carry no weight.
COMMON = 0.01
#: Files of the basis in the shared folder.
PARTS = 32
SHARE = 0.5
#: Items of the query set; it goes to every task (a few kB each).
MAX_ITEMS = 20_000


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    hashes, at, _, _ = word_hashes(_soft[data], offsets)
    return hashes, at


def _terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TERM_BITS)).astype(np.int32)


def term_rows(docs: DataFrame, text: str) -> DataFrame:
    """(terms, words, passages) of the words of every text: hashed words as 16-bit numbers, in rows of ROW_BLOCKS blocks.

    A row of a longer text goes on to the end of the last passage that begins in it; `words` leaves out what the next row has too."""
    size, more = ROW_BLOCKS * BLOCK_WORDS, (PASSAGE_BLOCKS - 1) * BLOCK_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 1000):
                hashes, at = _words(batch.column(0).slice(first, 1000))
                terms, blobs, words, passages = _terms(hashes).astype("<u2"), [], [], []
                for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    for begin in range(a, max(min(a + 1, b), b - more), size):
                        end = min(b, begin + size + more)
                        blobs.append(terms[begin:end].tobytes())
                        words.append(size if begin + size < b - more else b - begin)
                        passages.append(max(1, -(-(end - begin) // BLOCK_WORDS) - PASSAGE_BLOCKS + 1))
                yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), pa.array(words, pa.int32()), pa.array(passages, pa.int32())], ["terms", "words", "passages"])

    return docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "terms binary, words int, passages int")


def term_counts(rows: DataFrame) -> tuple[np.ndarray, int]:
    """(occurrences of every hashed word in all texts, number of passages); one partial vector a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << TERM_BITS) + 1, np.int64)
        for batch in batches:
            for begin in range(0, len(batch), 500):
                part = batch.slice(begin, 500).to_pydict()
                own = [np.frombuffer(blob, "<u2")[:n] for blob, n in zip(part["terms"], part["words"], strict=True)]
                total += np.bincount(np.concatenate(own), minlength=len(total))
                total[-1] += sum(part["passages"])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["term", "n"])

    out = np.zeros((1 << TERM_BITS) + 1, np.int64)
    for r in rows.select("terms", "words", "passages").mapInArrow(run, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out[:-1], int(out[-1])


def term_weights(counts: np.ndarray) -> np.ndarray:
    total = max(1, int(counts.sum()))
    idf = np.log1p(total / BLOCK_WORDS / (1.0 + counts))
    return np.where(counts > COMMON * total, 0.0, idf).astype(np.float32)


@dataclass(frozen=True)
class Tall:
    """A matrix [term, column] that no process holds for long: PARTS files of rows in the shared folder, times a small matrix."""

    path: str
    width: int
    turn: np.ndarray

    def rows(self, part: int) -> np.ndarray:
        return np.asarray(mapped_array(f"{self.path}/{part}", "f4")).reshape(-1, self.width) @ self.turn.astype(np.float32)

    def whole(self) -> np.ndarray:
        return np.concatenate([self.rows(k) for k in range(PARTS)])


def _start(width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A random matrix [term, width] with one entry in a row, 1 or -1: (column, sign) of every term."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, width, 1 << TERM_BITS), rng.choice(np.array([-1.0, 1.0], np.float32), 1 << TERM_BITS)


def _batches(length: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first, stop, rows of the longest) of groups in descending order of length: about 1024 rows of a matrix at a time."""
    at = 0
    while at < len(length):
        most = max(1, int(length[at]))
        stop = min(len(length), at + max(1, 1024 // most))
        yield at, stop, most
        at = stop


def _grouped_sums(matrix: np.ndarray, index: np.ndarray, begin: np.ndarray, end: np.ndarray, batches: Iterable[tuple[int, int, int]]) -> np.ndarray:
    """Sums of matrix[index[begin:end]] for the groups of every batch; the matrix ends in a row of zeros."""
    out, taken = np.empty((len(begin), matrix.shape[1]), np.float32), np.zeros((0, matrix.shape[1]), np.float32)
    index, step = np.append(index, len(matrix) - 1).astype(np.intp), np.arange(1024)
    for a, b, most in batches:
        place = begin[a:b, None] + step[:most]
        rows = index[np.where(place < end[a:b, None], place, len(index) - 1)].ravel()
        if len(taken) < len(rows):
            taken = np.empty((len(rows), matrix.shape[1]), np.float32)
        np.take(matrix, rows, axis=0, out=taken[: len(rows)], mode="clip")  # the same memory each time
        np.add.reduce(taken[: len(rows)].reshape(b - a, most, -1), axis=1, out=out[a:b])
    return out


def _add_products(out: np.ndarray, v: np.ndarray | tuple[np.ndarray, np.ndarray], live: np.ndarray, blobs: list, scale: np.ndarray) -> None:
    """Add A'A V to `out` for the passages of some rows, but for the weights of the terms of `out`; `live` terms have one.

    V is weighted and ends in a row of zeros, or is (column, weighted sign) of every term. A row has the blocks of a passage at
    least, empty ones at its end, so sums of neighbouring blocks never mix two rows where a passage begins."""
    width = out.shape[1]
    count = np.array([len(b) // 2 for b in blobs])
    blocks = np.maximum(-(-count // BLOCK_WORDS), PASSAGE_BLOCKS)
    last, stop = np.cumsum(blocks), np.cumsum(count)
    row = np.repeat(np.arange(len(blobs)), blocks)
    place = np.arange(len(row)) - (last - blocks)[row]
    begin = np.minimum((stop - count)[row] + BLOCK_WORDS * place, stop[row])
    end = np.minimum(begin + BLOCK_WORDS, stop[row])
    terms = np.frombuffer(b"".join(blobs), "<u2")
    of = np.repeat(np.arange(len(row)), end - begin)
    if isinstance(v, tuple):
        sums = np.bincount(of * width + v[0][terms], v[1][terms], len(row) * width).astype(np.float32).reshape(-1, width)
    else:
        sums = _grouped_sums(v, terms, begin, end, ((a, min(a + 32, len(row)), BLOCK_WORDS) for a in range(0, len(row), 32)))
    whole = sums.copy()
    for k in range(1, PASSAGE_BLOCKS):
        whole[:-k] += sums[k:]
    begins = place + PASSAGE_BLOCKS <= blocks[row]  # a passage begins at this block
    whole *= (begins * scale[row] ** 2).astype(np.float32)[:, None]
    back = np.zeros((len(row) + 1, width), np.float32)
    back[:-1] = whole
    for k in range(1, PASSAGE_BLOCKS):
        back[k:-1] += whole[:-k]
    # the same sums the other way: of the blocks that have a term, 64 occurrences at a time and then the rest
    used = np.flatnonzero(live[terms])
    if not len(used):
        return
    order = used[np.argsort(terms[used], kind="stable")]
    block, ordered = of[order], terms[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    n = np.diff(np.append(first, len(ordered)))
    many = np.flatnonzero(n >= 64)
    if len(many):
        pieces = n[many] // 64
        start = np.cumsum(pieces) - pieces
        a = np.repeat(first[many] - 64 * start, pieces) + 64 * np.arange(pieces.sum())
        out[ordered[first[many]]] += np.add.reduceat(_grouped_sums(back, block, a, a + 64, _batches(np.full(len(a), 64))), start, axis=0)
    rest = n % 64
    few = np.argsort(-rest, kind="stable")[: np.count_nonzero(rest)]
    stop = (first + n)[few]
    out[ordered[first[few]]] += _grouped_sums(back, block, stop - rest[few], stop, _batches(rest[few]))


def _through(rows: DataFrame, weights: np.ndarray, basis: Tall | tuple[np.ndarray, np.ndarray], width: int) -> DataFrame:
    """Partial sums of A'A V by parts of its rows, for the TF-IDF matrix A of all passages of (terms, weight): one partial a task,
    so the tasks are twice as many as run at a time, whatever the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if isinstance(basis, tuple):
            v = basis[0], basis[1] * weights
        else:
            v = np.concatenate([basis.whole() * weights[:, None], np.zeros((1, width), np.float32)])
        live, out = weights != 0, np.zeros((1 << TERM_BITS, width), np.float32)
        for batch in batches:
            blobs, scale = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            group = np.cumsum([-(-len(b) // (2 * BLOCK_WORDS)) for b in blobs]) // FIT_BLOCKS
            edges = np.flatnonzero(np.concatenate([[True], np.diff(group) > 0, [True]])) if len(blobs) else []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                _add_products(out, v, live, blobs[a:b], scale[a:b])
        out *= weights[:, None]
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([p.tobytes() for p in np.split(out, PARTS)], pa.binary())], ["part", "sums"])

    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(tasks).mapInArrow(tidy(run), "part int, sums binary")


def _added(blobs: pd.Series, kind: type) -> np.ndarray:
    return sum(np.frombuffer(b, kind).astype(np.float64) for b in blobs)


def _next_basis(rows: DataFrame, weights: np.ndarray, basis: Tall | tuple[np.ndarray, np.ndarray], width: int) -> tuple[str, np.ndarray, np.ndarray]:
    """(folder of W, V'W, W'W) for W = A'A V. Tasks write W's parts; only the products of columns come to the driver.

    V'W is left at zero for the matrix of the start."""
    path = work_folder(rows.sparkSession, "basis")

    def add(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        own = _added(group["sums"], np.float32).astype(np.float32).reshape(-1, width)
        write_array(f"{path}/{part}", own)
        own = own.astype(np.float64)
        across = np.zeros((width, width)) if isinstance(basis, tuple) else basis.rows(part).astype(np.float64).T @ own
        return pd.DataFrame({"sums": [np.stack([across, own.T @ own]).tobytes()]})

    def total(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"sums": [_added(group["sums"], np.float64).tobytes()]})

    parts = _through(rows, weights, basis, width).groupBy("part").applyInPandas(add, "sums binary")
    across, own = np.frombuffer(parts.groupBy().applyInPandas(total, "sums binary").first()["sums"]).reshape(2, width, width)
    return path, across, own


def latent_basis(rows: DataFrame, weights: np.ndarray, seed: int = 5) -> Tall:
    """Leading right singular vectors [term, RANK] by randomised subspace iteration (Halko et al. 2011) over all rows.

    It starts from a sparse random matrix (Clarkson and Woodruff 2013), whose products cost little. The last product W = A'A V
    also gives the vectors, by the Nystroem approximation W (V'W)^-1 W' of A'A (Tropp et al. 2017), so that no further pass is
    needed. The products run in tasks; the driver sees matrices of RANK + EXTRA squared."""
    spark, width = rows.sparkSession, RANK + EXTRA
    basis, used = _start(width, seed), []
    for left in reversed(range(ROUNDS)):
        path, across, own = _next_basis(rows, weights, basis, width)
        used.append(path)
        if left:
            values, vectors = np.linalg.eigh(own)
            basis = Tall(path, width, vectors / np.sqrt(np.maximum(values, 1e-12 * max(values[-1], 1e-30))))
    values, vectors = np.linalg.eigh((across + across.T) / 2)
    root = vectors * np.where(values > 1e-7 * max(values[-1], 1e-30), 1 / np.sqrt(np.maximum(values, 1e-30)), 0.0)
    values, vectors = np.linalg.eigh(root.T @ own @ root)
    turn = root @ (vectors * np.where(values > 1e-9 * max(values[-1], 1e-30), 1 / np.sqrt(np.maximum(values, 1e-30)), 0.0))
    for path in used[:-1]:
        remove_folder(spark, path)
    return Tall(used[-1], width, turn[:, ::-1][:, :RANK])


@dataclass(frozen=True)
class Queries:
    """Items cut into parts of at most one passage less two blocks: item of each part, its word hashes, latent vector, and the
    matrix that turns terms into latent vectors."""

    items: list
    words: list[np.ndarray]
    latent: np.ndarray
    projection: np.ndarray


_latent: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _projected(basis: Tall, weights: np.ndarray, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(latent vectors of the parts, projection); made once a worker from the shared folder."""
    if basis.path not in _latent:
        projection = basis.whole() * weights[:, None]
        projection = np.concatenate([projection, np.zeros((1, projection.shape[1]), np.float32)])
        _latent.clear()
        _latent[basis.path] = (np.stack([projection[_terms(w)].sum(axis=0) for w in words]), projection)
    return _latent[basis.path]


def _item_parts(items: list[tuple]) -> list[tuple]:
    most = (PASSAGE_BLOCKS - 1) * BLOCK_WORDS
    parts = []
    for key, text in items:
        hashes, _ = _words(pa.array([text or ""]))
        count = max(1, -(-len(hashes) // most)) if len(hashes) else 0
        size = -(-len(hashes) // count) if count else 0
        parts += [(key, hashes[i * size : (i + 1) * size]) for i in range(count)]
    return parts


def lcs_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over a (Hyyro 2004)."""
    place: dict[int, int] = {}
    for i, x in enumerate(a):
        place[x] = place.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        match = place.get(x, 0)
        if match:
            hit = row & match
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _compare(item: list[int], tail: list[int], window: list[int]) -> tuple[float, float]:
    """(share of the item, share of its answer) in the best stretch of up to twice the item's length: words of a
    whole passage in order, far apart, are chance."""
    best = (0.0, 0.0)
    size = 2 * len(item)
    for at in range(0, max(1, len(window) - size // 2), max(1, len(item) // 2)):
        part = window[at : at + size]
        share = lcs_length(item, part) / len(item)
        if share > best[0]:
            best = (share, lcs_length(tail, part) / len(tail))
    return best


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    cover: float = 0.75, answered: tuple[float, float] = (0.6, 0.8), min_words: int = 8,
) -> DataFrame:
    """(key, item_key, cosine, lcs_share, answer_share): the documents that hold a benchmark item, and which.

    An item is held if the longest common subsequence of its words and those of a stretch of text covers `cover` of the item, or
    `answered[0]` of it and `answered[1]` of its answer. Items with fewer than min_words words after
    normalisation are not searched for; longer items than a passage are searched for in parts. Null and empty texts hold nothing;
    an empty table gives no rows. One row for each key and item, with the best values."""
    spark = docs.sparkSession
    rows = benchmark.select(item_key, item_text).orderBy(item_key, item_text).limit(MAX_ITEMS + 1).collect()
    if len(rows) > MAX_ITEMS:
        raise ValueError(f"more than {MAX_ITEMS} items: search for them in several calls")
    parts = [(k, w) for k, w in _item_parts([(r[0], r[1]) for r in rows]) if len(w) >= min_words]
    kinds = (dict(docs.dtypes)[key], dict(benchmark.dtypes)[item_key])
    schema = f"`{key}` {kinds[0]}, `{item_key}` {kinds[1]}, cosine double, lcs_share double, answer_share double"
    if not parts:
        return spark.createDataFrame([], schema)
    rows = materialize(term_rows(docs, text), "terms")
    counts, passages = term_counts(rows)
    weights = term_weights(counts)
    weight = max(ITEM_WEIGHT, math.sqrt(ITEM_SHARE * passages))
    own = spark.createDataFrame(pd.DataFrame({"terms": [_terms(w).astype("<u2").tobytes() for _, w in parts], "weight": np.full(len(parts), weight, np.float32)}), "terms binary, weight float")
    basis = latent_basis(rows.select("terms", F.lit(1.0).cast("float").alias("weight")).unionByName(own), weights)
    item_type = to_arrow_type(benchmark.schema[item_key].dataType)
    shared = spark.sparkContext.broadcast(([k for k, _ in parts], [w for _, w in parts], basis, weights))  # items, some kB each, and term weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, words, tall, idf = shared.value
        q = Queries(items, words, *_projected(tall, idf, words))
        energy = (q.latent**2).sum(axis=1)
        lists = [w.tolist() for w in q.words]
        tails = [w[-max(3, len(w) // 4) :] for w in lists]
        for whole in batches:
            for begin in range(0, len(whole), 200):
                batch = whole.slice(begin, 200)
                hashes, at = _words(batch.column(1))
                best = _search(hashes, at, q, energy, lists, tails, cover, answered)
                if best:
                    found = sorted(best)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([d for d, _ in found])), pa.array([q.items[p] for _, p in found], item_type), *(pa.array([best[f][i] for f in found], pa.float64()) for i in range(3))],
                        [key, item_key, "cosine", "lcs_share", "answer_share"],
                    )

    found = docs.select(key, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)
    return found.groupBy(key, item_key).agg(*[F.max(c).alias(c) for c in ("cosine", "lcs_share", "answer_share")])


def _search(hashes, at, q: Queries, energy, lists, tails, cover: float, answered: tuple[float, float]) -> dict:
    """(row, part) -> (cosine, share, answer share) of what is verified in some rows."""
    counts = np.diff(at)
    blocks = -(-counts // BLOCK_WORDS)
    row = np.repeat(np.arange(len(counts)), blocks)
    if not len(row):
        return {}
    begin = at[:-1][row] + BLOCK_WORDS * (np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    end = np.minimum(begin + BLOCK_WORDS, at[1:][row])
    sums = _grouped_sums(q.projection, _terms(hashes), begin, end, ((a, min(a + 32, len(row)), BLOCK_WORDS) for a in range(0, len(row), 32)))
    passage = sums.copy()
    for k in range(1, PASSAGE_BLOCKS):
        same = np.flatnonzero(row[k:] == row[:-k])
        passage[same] += sums[same + k]
    out: dict = {}
    for first in range(0, len(lists), 2048):
        part = slice(first, first + 2048)
        dot = passage @ q.latent[part].T
        last = -1
        for p, i in np.argwhere(dot >= SHARE * energy[part][None, :]).tolist():
            i += first
            if p != last:  # the items of a passage follow each other
                last, r = p, int(row[p])
                a = max(int(at[r]), int(begin[p]) - 16)
                b = min(int(at[r + 1]), int(begin[p]) + PASSAGE_BLOCKS * BLOCK_WORDS + 16)
                window = hashes[a:b].tolist()
                known = set(window)
            if sum(map(known.__contains__, lists[i])) < min(cover, answered[0]) * len(lists[i]):
                continue  # no common subsequence can be longer
            share, tail = _compare(lists[i], tails[i], window)
            if share >= cover or share >= answered[0] and tail >= answered[1]:
                cosine = float(dot[p, i - first] / math.sqrt(max(1e-12, energy[i] * float((passage[p] ** 2).sum()))))
                old = out.get((r, i))
                out[r, i] = (cosine, share, tail) if old is None else tuple(map(max, old, (cosine, share, tail)))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`docs` without the documents that hold a benchmark item; see find_leaks. Rows without a key stay."""
    leaks = materialize(find_leaks(docs, benchmark, key, text, **options), "leaks").select(key).distinct()
    return docs.join(leaks, key, "left_anti")
