"""Packing token streams into sequences of equal length under a target mixture of sources.

Every source is a queue of documents. Deficit round-robin serves the queues: in each round a source
earns `sequence length x its share` tokens, and is served in whole packets from what it has earned; the
rest (its deficit) is carried into the next round. As shares are integers over SHARE_UNIT, what a source was
served before round r is `packet * floor(r * earned per round / packet)`, at most all it has, so the
place of any token follows from its place in its own queue without going through earlier rounds: each task
computes its own pieces, and deficits carry over sequences and partitions alike. Rounds follow each other
without gaps, so every sequence but the last of all is full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize
from tidemark.llm.kernels import text_bytes
from tidemark.llm.token_ids import encoder

SHARE_UNIT = 1 << 20
#: Sources whose totals come to the driver; the mixture is a table of this many rows at most.
MAX_SOURCES = 100_000


def tokenize(docs: DataFrame, tokenizer: str, end: int | None = 1, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source, part, start, n_tokens, ids): ids as uint16 or uint32 bytes; start counts the tokens of the same
    source before the document in its task. A null text is empty; a null source is a queue of its own."""
    types = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind = encoder(tokenizer)
        width, part, before = np.dtype(kind).itemsize, TaskContext.get().partitionId(), {}
        tail = b"" if end is None else np.array([end], kind).tobytes()
        for batch in batches:
            for at in range(0, len(batch), 256):
                piece = batch.slice(at, 256)
                ids = [x + tail for x in encode([t or "" for t in piece.column(1).to_pylist()])]
                counts, starts = [len(x) // width for x in ids], []
                for name, n in zip(piece.column(2).to_pylist(), counts, strict=True):
                    starts.append(before.get(name, 0))
                    before[name] = starts[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(2), pa.array([part] * len(piece), pa.int32()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                    ["key", "queue", "part", "start", "n_tokens", "ids"],
                )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(source).cast("string").alias("queue"))
    return rows.mapInArrow(run, f"key {types[key]}, queue string, part int, start bigint, n_tokens bigint, ids binary")


class Schedule:
    """Deficit round-robin over queues of known totals, in closed form."""

    def __init__(self, totals: np.ndarray, shares: np.ndarray, length: int, packet: int):
        self.totals, self.length, self.packet = totals.astype(np.int64), length, packet
        self.earned = np.maximum(1, np.rint(shares / max(shares.sum(), 1e-300) * SHARE_UNIT).astype(np.int64)) * length

    def served(self, rounds: np.ndarray, queue: int) -> np.ndarray:
        """Tokens of the queue served before these rounds."""
        units = SHARE_UNIT * self.packet
        whole, rest = np.divmod(rounds, units)
        packets = whole * self.earned[queue] + rest * self.earned[queue] // units
        return np.minimum(packets * self.packet, self.totals[queue])

    def cut(self, queue: int, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, first token, tokens, place in the whole stream) of the pieces of some rows of a queue, which hold its
        tokens starts[i] to starts[i] + counts[i]."""
        starts, counts = starts.astype(np.int64), counts.astype(np.int64)
        low = starts // self.packet
        many = np.where(counts > 0, (starts + counts - 1) // self.packet - low + 1, 0)
        row = np.repeat(np.arange(len(starts)), many)
        if not len(row):
            return (row,) * 4
        k = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        # the round in which packet k is served: before the first r with r * earned >= (k + 1) * unit
        units = SHARE_UNIT * self.packet
        whole, rest = np.divmod(k + 1, self.earned[queue])
        rounds = whole * units + -(-rest * units // self.earned[queue]) - 1
        edges = k * self.packet
        place = edges - self.served(rounds, queue)  # earlier packets of the same round
        for other in range(len(self.totals)):
            place += self.served(rounds + (other < queue), other)
        first = np.maximum(edges, starts[row])
        size = np.minimum(edges + self.packet, starts[row] + counts[row]) - first
        place += first - edges
        # join packets that follow each other, then cut at the ends of sequences
        fresh = np.concatenate([[True], (place[1:] != place[:-1] + size[:-1]) | (row[1:] != row[:-1])])
        group = np.flatnonzero(fresh)
        row, first, place, size = row[group], first[group], place[group], np.add.reduceat(size, group)
        cuts = (place + size - 1) // self.length - place // self.length + 1
        of = np.repeat(np.arange(len(first)), cuts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        begin = np.maximum(place[of], (place[of] // self.length + nth) * self.length)
        stop = np.minimum(place[of] + size[of], (place[of] // self.length + nth + 1) * self.length)
        return row[of], first[of] + begin - place[of], stop - begin, begin


def pack(
    docs: DataFrame, tokenizer: str, length: int = 2048, end: int | None = 1, mixture: dict[str | None, float] | None = None,
    packet: int = 128, key: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """Pieces of sequences: key, source, start, length, ids (uint32 bytes), doc_tokens, sequence_id, offset.

    Every token of every row lies in one piece, `end` closes each row. Sequences have `length` tokens,
    filled without gaps; only the last one may be shorter. `mixture` gives target shares by source; None takes
    the shares of the corpus, so that all queues end together. A source without a target has the
    smallest one. When a queue is empty the others fill its place. Repeated keys are separate rows. An empty table,
    or only empty rows with end=None, gives no pieces. Sources are limited to MAX_SOURCES."""
    tokens = materialize(tokenize(docs, tokenizer, end, key, text, source), "tokens")
    name = F.struct(F.col("queue").isNull(), F.coalesce("queue", F.lit("")))
    parts = tokens.groupBy("queue", "part").agg(F.sum("n_tokens").alias("n"))
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = materialize(parts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "parts")
    rows = parts.groupBy("queue").agg(F.sum("n").alias("n")).orderBy(name).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    totals = np.array([r["n"] for r in rows], np.int64)
    if mixture is None:
        shares = totals.astype(float)
    else:
        given = [mixture.get(r["queue"]) for r in rows]
        least = min((g for g in given if g), default=1.0)
        shares = np.array([g or least for g in given], float)
    number = {r["queue"]: i for i, r in enumerate(rows)}
    plan = Schedule(totals, shares, length, packet)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                queue = np.array([number[q] for q in part.column(1).to_pylist()], np.int64)
                begins, counts = part.column(2).to_numpy(), part.column(3).to_numpy()
                found = []
                for q in np.unique(queue):
                    own = np.flatnonzero(queue == q)
                    row, first, size, place = plan.cut(int(q), begins[own], counts[own])
                    found.append((own[row], first, size, place))
                row, first, size, place = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.argsort(row, kind="stable")
                row, first, size, place = row[order], first[order] - begins[row[order]], size[order], place[order]
                data, offsets = _blobs(part.column(4), counts)
                where = offsets[row] + first
                at_out = np.concatenate([[0], np.cumsum(size)])
                ids = data[np.repeat(where - at_out[:-1], size) + np.arange(at_out[-1])].astype("<u4")
                blobs = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer((at_out * 4).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array(first), pa.array(size), blobs, part.column(3).take(pa.array(row)), pa.array(place // length), pa.array(place % length)],
                    [key, source, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

    placed = tokens.join(parts.select(F.col("queue").alias("_q"), F.col("part").alias("_p"), "base"), F.col("queue").eqNullSafe(F.col("_q")) & (F.col("part") == F.col("_p")))
    placed = placed.select("key", "queue", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids")
    return placed.mapInArrow(run, f"`{key}` {dict(tokens.dtypes)['key']}, `{source}` string, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")


def _blobs(column: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, of rows with so many ids, and where each row's begin. The bytes tell how wide an id is, so that only
    tasks that make ids load the tokenizer."""
    data, offsets = text_bytes(column)
    kind = "<u2" if len(data) == 2 * int(counts.sum()) else "<u4"
    return np.ascontiguousarray(data).view(kind), offsets[:-1] // np.dtype(kind).itemsize
