"""Removal of repeated byte strings with suffix arrays of shards.

A string of LENGTH bytes belongs to its anchor: the smallest hash among its GRAM-byte pieces, the first on ties. Equal strings have
equal anchors at equal places, so the strings of all texts are dealt to shards by anchor hash, as segments: the strings of
a text that share an anchor are one stretch of bytes. Equal segments are counted, not repeated. Shards
of different segments with one anchor build a suffix array by prefix doubling (Larsson and Sadakane:
only unsorted groups are refined, here up to LENGTH bytes) and compare the bytes of neighbours as far as they agree. An anchor with
more segments than a shard holds is spread over several; each sends the hashes of its strings as sorted runs, packed by range of
values, and the runs of a range are merged by binary search. Equality across shards is that of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_ids, materialize
from tidemark.llm.kernels import _powers, _values, mix, text_bytes

LENGTH, GRAM = 200, 32
#: Bytes hashed at a time; a text longer than this is cut into overlapping pieces.
PIECE = 1 << 21
#: Low bits of a hash that give way to a place in a piece.
ANCHOR_BITS = 22
#: Segments of one anchor that a shard holds; bytes of a suffix array.
SHARD_SEGMENTS, SHARD_BYTES = 4096, 2_000_000
#: Hashes that one merge holds, about.
MERGED = 250_000


def segments(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(first start, last start, anchor hash, place of the anchor, hash of all bytes) of the segments of one text."""
    none = (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) + (np.zeros(0, np.uint64),)
    if len(data) < length:
        return none
    up, down = _powers(max(2 * PIECE, 1 << int(len(data)).bit_length()))
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_values[data] * up[: len(data)], out=run[1:])
    grams = mix((run[gram:] - run[:-gram]) * down[: len(data) - gram + 1])
    width = length - gram + 1
    # smallest (hash, place) of every `width` pieces: minima to the left and right within blocks of that width
    bits = np.uint64(ANCHOR_BITS)  # the same for all texts, so that equal strings compare the same hashes
    keyed = (grams >> bits) << bits | np.arange(len(grams), dtype=np.uint64)
    blocks = -(-len(grams) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(grams)] = keyed
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = len(data) - length + 1
    anchor = (np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts]) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.concatenate([first[1:], [starts]]) - 1
    place = anchor[first]
    whole = mix(mix((run[last + length] - run[first]) * down[first]) + ((place - first) * 1024 + last - first).astype(np.uint64))
    return first, last, grams[place], place, whole


def _pieces(size: int, length: int) -> Iterator[tuple[int, int]]:
    """Stretches of a text that hold every string of `length` bytes once."""
    for at in range(0, max(1, size - length + 1), PIECE):
        yield at, min(size, at + PIECE + length - 1)


def segments_of(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """(doc, start, count, place, anchor, whole) of all segments; count starts from `start` on, anchor at start + place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "start", "count", "place", "anchor", "whole"]
        for whole in batches:
            for begin in range(0, len(whole), 500):
                batch = whole.slice(begin, 500)
                data, offsets = text_bytes(batch.column(1))
                rows, columns = [], []
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    if b - a < length:
                        continue
                    for p, q in _pieces(b - a, length):
                        first, last, anchor, place, full = segments(data[a + p : a + q], length)
                        rows += [i] * len(first)
                        columns.append((first + p, last - first + 1, place - first, anchor, full))
                if rows:
                    start, count, place, anchor, full = (np.concatenate(c) for c in zip(*columns, strict=True))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(start), pa.array(count.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(full.view(np.int64))], names)

    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, f"doc {dict(rows.dtypes)['doc']}, start bigint, count int, place int, anchor bigint, whole bigint")


def prefix_ranks(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array of `starts`, sorted by their first `length` bytes; length of the common prefix of each with the one before,
    at most `length`). Every start has at least `length` bytes after it."""
    size = len(data)
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)])
    key = np.zeros(size, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k : k + size]
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rank = np.empty(size, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(size), 0))
    depth = 8
    while depth < length:
        step = min(depth, length - depth)
        alone = np.concatenate([fresh[1:], [True]]) & fresh
        open_at = np.flatnonzero(~alone)  # slots of the order in groups of two or more
        if not len(open_at):
            break
        suffix = order[open_at]
        after = np.where(suffix + step < size, rank[np.minimum(suffix + step, size - 1)], -1)
        pair = rank[suffix] * np.int64(size + 1) + after + 1
        again = np.argsort(pair, kind="stable")
        order[open_at], pair = suffix[again], pair[again]
        fresh[open_at] |= np.concatenate([[True], pair[1:] != pair[:-1]])
        begin = np.maximum.accumulate(np.where(fresh, np.arange(size), 0))
        rank[order[open_at]] = begin[open_at]
        depth += step
    wanted = np.zeros(size, bool)
    wanted[starts] = True
    chosen = order[wanted[order]]
    return chosen, _common(padded, chosen, length)


def _common(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it, up to `length`; 0 for the first. All pairs that still agree are
    compared byte after byte together."""
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for at in range(length):
        if not len(live):
            break
        live = live[data[order[live] + at] == data[order[live - 1] + at]]
        out[live] += 1
    return out


def _spans(hit: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte ranges covered by strings that start where `hit` is true."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1 + length) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _shard_repeats(rows: list[tuple], length: int) -> Iterator[tuple]:
    """(anchor, whole, spans, unseen starts, their hashes) of every segment (anchor, whole, count, bytes) of one shard."""
    sizes = np.array([len(r[3]) for r in rows])
    at = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    counts = np.array([r[2] for r in rows])
    starts = np.concatenate([np.arange(c) + a for c, a in zip(counts, at[:-1], strict=True)])
    order, common = prefix_ranks(data, starts, length)
    same = common >= length
    repeated = np.zeros(len(data), bool)
    repeated[order[same]] = repeated[order[np.flatnonzero(same) - 1]] = True
    for i, row in enumerate(rows):
        yield row[0], row[1], repeated[at[i] : at[i] + counts[i]], data[at[i] : at[i + 1]]


def repeated_spans(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """(doc, spans): byte ranges [begin, end) of each text that are covered by repeated strings."""
    found = materialize(segments_of(docs, key, text, length), "segments")
    classes = materialize(found.groupBy("anchor", "whole").agg(F.count("*").alias("n"), F.min(F.struct("doc", "start", "count")).alias("one")), "classes")
    anchors = classes.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("n").alias("total")).where("total > 1")
    met = materialize(classes.join(anchors.select("anchor", "kinds"), "anchor"), "met")
    alike = met.where("n > 1").select("anchor", "whole", F.lit(None).cast("array<struct<a:int,b:int>>").alias("ranges"))

    # segments of one anchor that differ: their bytes go to shards
    mixed = met.where("kinds > 1")
    wanted = mixed.select("anchor", "whole", "kinds", "n", F.col("one.doc").alias("doc"), F.col("one.start").alias("start"), F.col("one.count").alias("count"))
    by_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "whole", "kinds", "n", "start", "count")).alias("wanted"))
    by_doc = materialize(by_doc, "wanted")
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc"), F.col(text).cast("string").alias("t"))
    texts = join_ids(rows, by_doc.select("doc"), "doc").groupBy("doc").agg(F.first("t").alias("t")).join(by_doc, "doc")
    raw = texts.select("t", F.explode("wanted").alias("w")).select("w.*", F.substring(F.col("t").cast("binary"), F.col("w.start").cast("int") + 1, F.col("w.count") + length - 1).alias("bytes"))
    split = F.ceil(F.col("kinds") / SHARD_SEGMENTS)
    shard = F.xxhash64("anchor", F.pmod(F.col("whole"), split))
    raw = raw.withColumn("shard", shard).withColumn("split", split > 1).select("shard", "split", "anchor", "whole", "n", "count", "bytes").repartition("shard").sortWithinPartitions("shard")

    ranges = 1 + int((mixed.where(F.col("kinds") > SHARD_SEGMENTS).agg(F.sum("one.count")).first()[0] or 0) // MERGED)
    spans_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def send() -> Iterator[pa.RecordBatch]:
            inner: list[tuple] = []
            runs: list[tuple[int, np.ndarray]] = []
            for k, ((anchor, whole, hit, data), row) in enumerate(zip(_shard_repeats([(r[2], r[3], r[5], r[6]) for r in held], length), held, strict=True)):
                if row[4] == 1 and hit.any():
                    inner.append((anchor, whole, [{"a": a, "b": b} for a, b in _spans(hit, length)]))
                if row[1]:  # other shards hold segments of this anchor
                    runs.append((k, _string_hashes(data, row[5], length)))
            columns = [pa.array([r[k] for r in inner], t) for k, t in enumerate((pa.int64(), pa.int64(), spans_type))]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(inner), pa.int32()), pa.nulls(len(inner), pa.binary())], names)
            if runs:
                blobs = list(_packed_runs(runs, [(r[2], r[3]) for r in held], ranges))
                blank = [pa.nulls(len(blobs), t) for t in (pa.int64(), pa.int64(), spans_type)]
                yield pa.RecordBatch.from_arrays([*blank, pa.array([k for k, _ in blobs], pa.int32()), pa.array([b for _, b in blobs], pa.binary())], names)
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[0] != last and size >= SHARD_BYTES:
                    yield from send()
                    size = 0
                held.append(row)
                size += len(row[6])
                last = row[0]
        if held:
            yield from send()

    names = ["anchor", "whole", "ranges", "part", "run"]
    built = materialize(raw.mapInArrow(build, "anchor bigint, whole bigint, ranges array<struct<a:int,b:int>>, part int, run binary"), "built")
    inner = built.where("run is null").select("anchor", "whole", "ranges")
    outer = _merge_runs(built.where("run is not null").select("part", "run"), length)
    parts = alike.unionByName(inner).unionByName(outer)
    parts = parts.groupBy("anchor", "whole").agg(F.max(F.col("ranges").isNull()).alias("all"), F.flatten(F.collect_list("ranges")).alias("ranges"))
    hit = found.join(parts, ["anchor", "whole"])
    full = F.array(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("count") + length - 1).alias("b")))
    some = F.transform("ranges", lambda r: F.struct((F.col("start") + r["a"]).alias("a"), (F.col("start") + r["b"]).alias("b")))
    return hit.select("doc", F.when(F.col("all"), full).otherwise(some).alias("s")).groupBy("doc").agg(F.flatten(F.collect_list("s")).alias("spans"))


def _string_hashes(data: np.ndarray, count: int, length: int) -> np.ndarray:
    """Hashes of the strings at the first `count` places."""
    up, down = _powers(max(2 * PIECE, 1 << int(len(data)).bit_length()))
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_values[data] * up[: len(data)], out=run[1:])
    return mix((run[length:] - run[:-length]) * down[: len(data) - length + 1])[:count]


def _packed_runs(runs: list[tuple[int, np.ndarray]], segments: list[tuple[int, int]], ranges: int) -> Iterator[tuple[int, bytes]]:
    """(range, packed run) of hashes by segment: sorted hashes, and the segment and place of each."""
    digest = np.concatenate([d for _, d in runs])
    owner = np.repeat([k for k, _ in runs], [len(d) for _, d in runs])
    place = np.concatenate([np.arange(len(d)) for _, d in runs])
    order = np.argsort(digest, kind="stable")
    digest, owner, place = digest[order], owner[order], place[order]
    names = np.array(segments, np.int64)
    cut = np.searchsorted(((digest >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64), np.arange(ranges + 1))
    for k in np.flatnonzero(np.diff(cut)).tolist():
        own = slice(cut[k], cut[k + 1])
        used, which = np.unique(owner[own], return_inverse=True)
        head = np.array([len(digest[own]), len(used)], np.int64)
        columns = [head, digest[own], names[used, 0], names[used, 1], which.astype(np.int32), place[own].astype(np.int32)]
        yield k, b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def _unpacked_run(blob: bytes) -> tuple[np.ndarray, ...]:
    """(hashes, anchors, wholes, segment of each hash, place of each hash)."""
    n, m = np.frombuffer(blob, np.int64, 2).tolist()
    sizes = [(np.uint64, n), (np.int64, m), (np.int64, m), (np.int32, n), (np.int32, n)]
    at, out = 16, []
    for kind, size in sizes:
        out.append(np.frombuffer(blob, kind, size, at))
        at += size * np.dtype(kind).itemsize
    return tuple(out)


def merged_repeats(runs: list[np.ndarray]) -> np.ndarray:
    """Values that occur twice or more in sorted runs: each run is searched for in the merged ones and then put in its places."""
    merged, twice = np.zeros(0, np.uint64), [np.zeros(0, np.uint64)]
    for run in runs:
        fresh = np.concatenate([[True], run[1:] != run[:-1]]) if len(run) else np.zeros(0, bool)
        twice.append(run[~fresh])
        own = run[fresh]
        at = np.searchsorted(merged, own)
        known = np.zeros(len(own), bool)
        inside = at < len(merged)
        known[inside] = merged[at[inside]] == own[inside]
        twice.append(own[known])
        merged = np.insert(merged, at[~known], own[~known])
    return np.unique(np.concatenate(twice))


def _merge_runs(runs: DataFrame, length: int) -> DataFrame:
    """(anchor, whole, ranges) of strings that occur in several shards, from packed runs (part, run).

    Runs are dealt by range of hashes, so a string's hashes meet whatever their anchor's size."""

    def merge(table: pa.Table) -> pa.Table:
        own = [_unpacked_run(b) for b in table["run"].to_pylist()]
        twice = merged_repeats([r[0] for r in own])
        columns: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 5]
        for digest, anchor, whole, which, place in own:
            at = np.minimum(np.searchsorted(twice, digest), max(len(twice) - 1, 0))
            hit = np.flatnonzero(twice[at] == digest) if len(twice) else np.zeros(0, np.int64)
            hit = hit[np.lexsort((place[hit], which[hit]))]
            segment, start = which[hit], place[hit]
            fresh = np.concatenate([[True], segment[1:] != segment[:-1]])[: len(hit)]
            first = np.flatnonzero(fresh | (np.diff(start, prepend=0) > 1))  # neighbouring places are one range
            last = np.concatenate([first[1:], [len(hit)]])[: len(first)] - 1
            held, sizes = np.unique(segment[first], return_counts=True)
            columns.append((anchor[held], whole[held], sizes, start[first], start[last] + length))
        anchors, wholes, sizes, begin, end = (np.concatenate(c) for c in zip(*columns, strict=True))
        spans = pa.StructArray.from_arrays([pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32))], ["a", "b"])
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        return pa.table([pa.array(anchors), pa.array(wholes), pa.ListArray.from_arrays(offsets, spans)], names=["anchor", "whole", "ranges"])

    return runs.groupBy("part").applyInArrow(merge, "anchor bigint, whole bigint, ranges array<struct<a:int,b:int>>")


def _cut(texts: pa.Array, spans: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(bytes, maximal removed ranges, what is left) of texts and the byte ranges, in any order, that cover what goes."""
    data, offsets = text_bytes(texts)
    row, flat = pc.list_parent_indices(spans).to_numpy(), pc.list_flatten(spans)
    begin, end = (flat.field(k).to_numpy(zero_copy_only=False) + offsets[row] for k in (0, 1))
    depth = np.bincount(begin, minlength=len(data) + 1) - np.bincount(end, minlength=len(data) + 1)
    gone = np.cumsum(depth)[: len(data)] > 0
    edge = np.zeros(len(data) + 1, bool)  # ranges end where a text ends
    edge[offsets] = True
    first = np.flatnonzero(gone & (edge[:-1] | ~np.concatenate([[False], gone[:-1]])))
    last = np.flatnonzero(gone & (edge[1:] | ~np.concatenate([gone[1:], [False]])))
    owner = np.searchsorted(offsets, first, side="right") - 1
    runs = pa.StructArray.from_arrays([pa.array(first - offsets[owner]), pa.array(last + 1 - offsets[owner])], ["begin", "end"])
    counts = np.bincount(owner, minlength=len(texts))
    left = np.concatenate([[0], np.cumsum(~gone)])[offsets].astype(np.int32)
    kept = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(left.tobytes()), pa.py_buffer(data[~gone].tobytes())])
    return pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), runs), kept


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(key, n_bytes, spans, kept) of every row: spans are the maximal byte ranges removed, kept is what is left (binary).

    A byte is removed if a string of `length` bytes over it also starts elsewhere, in the same or another text. Texts are UTF-8
    bytes, null is empty; shorter texts lose nothing; matches never cross texts. Every row of a key counts as a text
    of its own only if keys are unique: rows that share a key must be copies, and do not count as repeats of each other
    beyond one. Rows without a key lose nothing. An empty table gives an empty result."""
    spans = repeated_spans(docs, key, text, length).withColumnRenamed("doc", key)
    both = docs.select(key, F.col(text).cast("string").alias("_t")).join(spans, key, "left").select(key, "_t", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), 500):
                batch = whole.slice(begin, 500)
                yield pa.RecordBatch.from_arrays([batch.column(0), *_cut(batch.column(1), batch.column(2))], [key, "n_bytes", "spans", "kept"])

    return both.mapInArrow(run, f"`{key}` {dict(docs.dtypes)[key]}, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary")
