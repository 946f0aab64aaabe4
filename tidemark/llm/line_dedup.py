"""Fuzzy line deduplication: SimHash, pigeonhole blocks, edit similarity, one kept line for each connected group.

Lines are compared in normalised form: A-Z lower-cased, ASCII punctuation and white space as single blanks. Lines with
fewer than MIN_WORDS words stay out. Equal lines are one node, named by its first occurrence. Nodes whose 64-bit SimHashes differ in at
most DISTANCE bits agree in `agree` of `blocks` blocks for some choice of blocks, so they meet in one of the
tables keyed by such a choice; they are linked if the edit similarity of the lines is high enough. Every
group of linked lines keeps its first occurrence (smallest document, then line). Links are looked for twice: first each hash with
the smallest one near it, which joins a large group of near copies by a tree; then all near pairs of different trees."""

from __future__ import annotations

import itertools
import os.path
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, connected_components, join_ids, materialize, tidy
from tidemark.llm.kernels import mix, text_bytes, word_hashes

MIN_WORDS = 5
DISTANCE = 4
#: FIXED VALUES: (nodes up to, blocks, blocks that agree); 64 bits in `blocks` parts, DISTANCE of which may differ.
TABLES = ((8_000_000, 6, 2), (500_000_000, 7, 3), (float("inf"), 9, 5))

_soft = np.arange(256, dtype=np.uint8)
_soft[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = 32
_spread = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], np.uint64)


def simhashes(words: np.ndarray, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """64-bit SimHash over the words of every row, weighted by `weight` (1 to 15 each); 0 for a row without words."""
    counts = np.diff(at)
    out = np.zeros(len(counts), np.uint64)
    live = np.flatnonzero(counts)
    if not len(live):
        return out
    parts = -(-counts[live] // 17)  # byte counters hold 17 * 15
    row = np.repeat(np.arange(len(live)), parts)
    begin = at[:-1][live][row] + 17 * (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts))
    octets, factor = words.view(np.uint8).reshape(-1, 8), weight.astype(np.uint64)
    sums = np.stack([np.add.reduceat(_spread[octets[:, k]] * factor, begin) for k in range(8)], 1)
    ones = np.add.reduceat(sums.view(np.uint8).reshape(len(begin), 64).astype(np.int32), np.cumsum(parts) - parts, axis=0)
    total = np.add.reduceat(weight.astype(np.int64), at[:-1][live])
    bits = (2 * ones > total[:, None]).astype(np.uint8)
    out[live] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, line, d1, d2, sim, size) of every line with at least MIN_WORDS words; lines count from 0 at each newline.

    size: characters of the normalised line. Words weigh by their letters in the SimHash, up to 15."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), 500):
                batch = whole.slice(begin, 500)
                data, offsets = text_bytes(batch.column(1))
                breaks = np.flatnonzero(data == 10) + 1
                starts = np.sort(np.concatenate([offsets[:-1], breaks]), kind="stable")
                doc = np.searchsorted(offsets, starts, side="right") - 1
                # a break at the end of a text, or an empty text, gives an empty line that counts for the wrong row: it has no words
                edges = np.concatenate([starts, [len(data)]])
                hashes, at, first, last = word_hashes(_soft[data], edges)
                counts = np.diff(at)
                keep = np.flatnonzero(counts >= MIN_WORDS)
                if not len(keep):
                    continue
                before = np.searchsorted(breaks, starts[keep], side="right") - np.searchsorted(breaks, offsets[:-1][doc[keep]], side="right")
                place = np.arange(len(hashes)) - np.repeat(at[:-1], counts)
                one = mix(hashes + place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                run1 = np.concatenate([[np.uint64(0)], np.cumsum(one)])
                run2 = np.concatenate([[np.uint64(0)], np.cumsum(mix(one ^ np.uint64(0xA5A5A5A5A5A5A5A5)))])
                d1, d2 = run1[at[1:]] - run1[at[:-1]], run2[at[1:]] - run2[at[:-1]]
                letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                letters = letters[last] - letters[first]
                sim = simhashes(hashes, at, np.clip(letters, 1, 15))
                size = np.concatenate([[0], np.cumsum(letters + 1)])
                size = size[at[1:]] - size[at[:-1]] - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc[keep])), pa.array(before.astype(np.int32)), pa.array(d1[keep].view(np.int64)), pa.array(d2[keep].view(np.int64)), pa.array(sim[keep].view(np.int64)), pa.array(size[keep].astype(np.int32))],
                    ["doc", "line", "d1", "d2", "sim", "size"],
                )

    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), f"doc {dict(rows.dtypes)['doc']}, line int, d1 bigint, d2 bigint, sim bigint, size int")


def _keys(sims: np.ndarray, blocks: int, agree: int) -> Iterator[np.ndarray]:
    edge = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [np.uint64(((1 << (b - a)) - 1) << a) for a, b in itertools.pairwise(edge)]
    for chosen in itertools.combinations(masks, agree):
        yield sims & np.bitwise_or.reduce(np.array(chosen))


def similar_hashes(sims: DataFrame, count: int, every: bool) -> DataFrame:
    """Pairs (x, y) of different SimHashes within DISTANCE bits, from rows (sim, grp).

    every: all such pairs but those of one group; else, in each table, one row for a hash, with the smallest hash near it."""
    _, blocks, agree = next(t for t in TABLES if count <= t[0])
    tables = len(list(itertools.combinations(range(blocks), agree)))
    parts = max(1, -(-count * 8 // 4_000_000))  # of a table: about 4 MB each

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            group = batch.column(1).to_numpy() if every else values
            for t, key in enumerate(_keys(values, blocks, agree)):
                part = (mix(key) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                edges = np.searchsorted(part[order], np.arange(parts + 1))
                found = np.flatnonzero(np.diff(edges))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((found + t * parts).astype(np.int32)), *(pa.array([v[order[edges[p] : edges[p + 1]]].tobytes() if every or v is values else b"" for p in found], pa.binary()) for v in (values, group))], ["bucket", "sims", "groups"]
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[bytes, bytes]]] = defaultdict(list)
        for batch in batches:
            for bucket, blob, groups in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held[bucket].append((blob, groups))
        for bucket, blobs in sorted(held.items()):
            values = np.frombuffer(b"".join(b for b, _ in blobs), np.uint64)
            group = np.frombuffer(b"".join(g for _, g in blobs), np.int64) if every else None
            key = next(itertools.islice(_keys(values, blocks, agree), bucket // parts, None))
            order = np.lexsort((values, key))
            values, key = values[order], key[order]
            least = values.copy()
            live, gap = np.arange(len(values)), 1
            while len(live):
                live = live[live + gap < len(values)]
                live = live[key[live] == key[live + gap]]
                near = live[np.bitwise_count(values[live] ^ values[live + gap]) <= DISTANCE]
                if every:
                    near = near[group[order[near]] != group[order[near + gap]]]
                    yield pa.RecordBatch.from_arrays([pa.array(values[near].view(np.int64)), pa.array(values[near + gap].view(np.int64))], ["x", "y"])
                else:
                    least[near + gap] = np.minimum(least[near + gap], values[near])
                gap += 1
            if not every:
                near = np.flatnonzero(least != values)
                yield pa.RecordBatch.from_arrays([pa.array(values[near].view(np.int64)), pa.array(least[near].view(np.int64))], ["x", "y"])

    dealt = sims.select("sim", "grp").mapInArrow(tidy(deal), "bucket int, sims binary, groups binary")
    tasks = max(1, min(tables * parts, -(-tables * count * (16 if every else 8) // 16_000_000)))
    return dealt.repartition(tasks, "bucket").mapInArrow(tidy(meet), "x bigint, y bigint").distinct()


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, bit-parallel (Myers 1999) on what is left between the common ends."""
    start = len(os.path.commonprefix([a, b]))
    a, b = a[start:], b[start:]
    stop = len(os.path.commonprefix([a[::-1], b[::-1]]))
    a, b = a[: len(a) - stop], b[: len(b) - stop]
    if not a or not b:
        return len(a) + len(b)
    place: dict[str, int] = defaultdict(int)
    for i, c in enumerate(a):
        place[c] |= 1 << i
    full, top, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    plus, minus = full, 0
    for c in b:
        match = place.get(c, 0)
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        up, down = minus | (full & ~(diagonal | plus)), plus & diagonal
        score += 1 if up & top else -1 if down & top else 0
        up, down = ((up << 1) | 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(diagonal | up)), up & diagonal
    return score


def _normalise(line: str) -> str:
    return " ".join(_soft[np.frombuffer(line.encode(), np.uint8)].tobytes().decode().translate(_LOWER).split(" ")).strip() if line else ""


_LOWER = {c: c + 32 for c in range(65, 91)} | {c: 32 for c in (9, 10, 11, 12, 13)}


def linked_lines(pairs: DataFrame, docs: DataFrame, key: str, text: str, similarity: float) -> DataFrame:
    """The pairs (a, b) of occurrences (doc, line) whose normalised lines have edit similarity of at least the threshold, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = (" ".join(_normalise(s or "").split()) for s in (x, y))
                longest = max(len(x), len(y))
                keep.append(abs(len(x) - len(y)) <= (1 - similarity) * longest and edit_distance(x, y) <= (1 - similarity) * longest + 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = dict(pairs.dtypes)["a"]
    with Scratch() as scratch:
        spots = scratch.materialize(pairs.select(F.explode(F.array("a", "b")).alias("spot")).distinct(), "spots")
        wanted = spots.groupBy(F.col("spot.doc").alias("doc")).agg(F.collect_list("spot.line").alias("wanted"))
        rows = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text")).where(F.col("doc").isNotNull())
        ids = scratch.materialize(wanted.select("doc"), "ids")
        found = join_ids(rows, ids, "doc").groupBy("doc").agg(F.first("text").alias("text")).join(wanted, "doc")
        lines = found.select("doc", F.explode("wanted").alias("line"), F.split("text", "\n").alias("all")).select(F.struct("doc", "line").alias("spot"), F.get("all", F.col("line")).alias("own"))
        lines = scratch.materialize(lines, "texts")
        both = pairs.join(lines.select(F.col("spot").alias("a"), F.col("own").alias("ta")), "a").join(lines.select(F.col("spot").alias("b"), F.col("own").alias("tb")), "b").select("a", "b", "ta", "tb")
        return materialize(both.mapInArrow(tidy(run), f"a {kind}, b {kind}"), "links")


def _gone_lines(docs: DataFrame, key: str, text: str, similarity: float, scratch: Scratch) -> DataFrame:
    """(key, _gone) of the documents that lose lines, and the numbers of those lines."""
    lines = scratch.materialize(lines_of(docs, key, text), "lines")
    nodes = lines.groupBy("d1", "d2").agg(F.min(F.struct("doc", "line")).alias("first"), F.first("sim").alias("sim"), F.first("size").alias("size"), F.count("*").alias("n"))
    nodes = scratch.materialize(nodes, "nodes")
    sims = scratch.materialize(nodes.groupBy("sim").agg(F.count("*").alias("n"), F.min(F.struct("first", "size")).alias("one")), "sims")

    def spots(left: DataFrame, right: DataFrame, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) of nodes by pairs of SimHashes; only lines of similar length can have similar edits."""
        a = left.select(F.col("sim").alias("x"), F.col("first").alias("a"), F.col("size").alias("sa"), F.col("grp").alias("ga"))
        b = right.select(F.col("sim").alias("y"), F.col("first").alias("b"), F.col("size").alias("sb"), F.col("grp").alias("gb"))
        near = pairs.join(a, "x").join(b, "y").where(F.abs(F.col("sa") - F.col("sb")) <= (1 - similarity) * F.greatest("sa", "sb") + 1e-9)
        return near.where("a <> b and (ga is null or gb is null or ga <> gb)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    # first a tree: each hash with the smallest one near it, each line with the first of its hash
    none = F.lit(None).cast(dict(nodes.dtypes)["first"])
    plain = nodes.withColumn("grp", none)
    heads = sims.select("sim", F.col("one.first").alias("first"), F.col("one.size").alias("size")).withColumn("grp", none)
    count = sims.count()
    near = scratch.materialize(similar_hashes(sims.withColumn("grp", F.col("sim")), count, every=False), "near")
    equal = scratch.materialize(sims.where("n > 1").select(F.col("sim").alias("x"), F.col("sim").alias("y")), "equal")
    # two tables, as the driver's memory grows with the joins of a plan
    trees = [scratch.materialize(spots(left, heads, pairs), "spots") for left, pairs in ((heads, near), (plain, equal))]
    links = linked_lines(trees[0].unionByName(trees[1]), docs, key, text, similarity)
    forest = connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    # then every pair of near hashes, of those that have any, whose lines are in different trees
    busy = near.select(F.explode(F.array("x", "y")).alias("sim")).unionByName(equal.select(F.col("x").alias("sim"))).distinct()
    rest = nodes.join(busy, "sim").join(forest.withColumnRenamed("node", "first"), "first", "left")
    rest = scratch.materialize(rest.select("sim", "first", "size", F.coalesce("component", "first").alias("grp")), "rest")
    label = F.xxhash64(F.col("least"))
    busy = rest.groupBy("sim").agg(F.min("grp").alias("least"), F.max("grp").alias("most"))
    busy = scratch.materialize(busy.select("sim", F.when(F.col("least") == F.col("most"), label).otherwise(F.xxhash64("sim", F.lit(1))).alias("grp"), (F.col("least") != F.col("most")).alias("mixed")), "busy")
    pairs = similar_hashes(busy, count, every=True).unionByName(busy.where("mixed").select(F.col("sim").alias("x"), F.col("sim").alias("y")))
    more = linked_lines(scratch.materialize(spots(rest, rest, pairs), "spots"), docs, key, text, similarity)
    # the forest stands for the links that it was made of
    stars = forest.where("node <> component").select(F.col("node").alias("src"), F.col("component").alias("dst"))
    groups = connected_components(stars.unionByName(more.select(F.col("a").alias("src"), F.col("b").alias("dst"))))
    better = groups.where("node <> component").select(F.col("node").alias("first"), F.col("component").alias("kept"))
    judged = nodes.join(better, "first", "left").where("n > 1 or kept is not null").select("d1", "d2", F.coalesce("kept", "first").alias("kept"))
    gone = lines.join(judged, ["d1", "d2"]).where(F.struct("doc", "line") != F.col("kept"))
    return materialize(gone.groupBy(F.col("doc").alias(key)).agg(F.collect_set("line").alias("_gone")), "gone")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.9) -> DataFrame:
    """`docs` with every repeated or nearly repeated line removed from the text; adds n_lines_removed (long).

    All rows stay; a text may become empty. Null and empty texts, lines below MIN_WORDS words and rows without
    a key are left as they are. Rows that share a key must be copies of each other; they keep the same lines. Other columns
    stay; an empty table stays empty."""
    docs = docs.drop("n_lines_removed")
    with Scratch() as scratch:
        gone = _gone_lines(docs, key, text, similarity, scratch)
    # never broadcast: the list grows with the texts, and a plan that turns with its size shuffles more than in proportion
    out = docs.join(gone.hint("shuffle_hash"), key, "left")
    left_over = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda line, i: ~F.array_contains(F.col("_gone"), i)), "\n")
    out = out.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(left_over)).withColumn("n_lines_removed", F.greatest(F.size("_gone"), F.lit(0)).cast("long"))
    return out.select(*docs.columns, "n_lines_removed")
