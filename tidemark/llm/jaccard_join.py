"""Exact n-gram Jaccard join with signature trees, and the groups of linked documents.

1. Every text becomes a set of word-shingle hashes; texts with equal sets form one class.
2. A first forest: classes that agree in a band of minimum hashes are compared with the smallest class of the band. This only
   saves work later; it need not find all links.
3. Completion: two sets that link share k shingles among the first `n - ceil(t * n) + k` of both in any common order.
   Shingles that are frequent in some task come last in that order, so few classes meet in a frequent one. Of the
   shingles that meet in two groups or more of the first forest, each gets a signature tree over
   its classes: nodes hold OR-combined bitmaps of shingles and ranges of set sizes, and a dual traversal drops
   node pairs whose largest possible overlap is too small, or whose classes are in one group already.
4. Candidate pairs of classes are verified on their full sets. Pairs inside one group are never
   looked at again, so a large group of copies costs a star and not all its pairs."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, connected_components, join_ids, materialize, tidy
from tidemark.llm.kernels import mix, shingle_sets, text_bytes, word_hashes

BANDS, BAND_ROWS = 6, 2
BITS = 1024
LEAF = 32
#: Shingles put last in the order; any choice gives the same links, so this bound only matters for speed (4 MB).
FREQUENT = 500_000
#: Classes of one shingle and size band that share a tree; larger groups are cut into pairs of blocks.
TREE = 4096
#: Shingles or candidate pairs that a task gathers before it sorts and counts them.
HELD = 1_000_000
#: A shingle of more sets than this is set aside where a link shows without it; any number gives the same links.
HOT = 32
#: Sets of a shingle for each place that its lowest set's shingles are dealt to.
SPREAD = 64
_SEEDS = mix(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def _sets(column: pa.Array, words: int) -> list[np.ndarray]:
    data, offsets = text_bytes(column)
    hashes, at, _, _ = word_hashes(data, offsets)
    return shingle_sets(hashes, at, words)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def describe_sets(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(id, n, digest, bands, bits) of every row, and rows (n = -1, digest, bands = [count]) of shingles
    that are frequent within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held = [], 0
        names = ["id", "n", "digest", "bands", "bits"]

        def frequent(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            values, counts = np.unique(np.concatenate(parts), return_counts=True)
            return values[counts >= 8], counts[counts >= 8]

        kept: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in _slices(batches):
            sets = _sets(batch.column(1), words)
            digests, bands, bits = [], [], []
            for s in sets:
                digests.append(np.array([len(s), mix(s).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(s + np.uint64(77))) if len(s) else 0], np.uint64).tobytes())
                if len(s):
                    low = mix(s[None, :] ^ _SEEDS[:, None]).min(axis=1).reshape(BANDS, BAND_ROWS)
                    bands.append(mix(low[:, 0] * np.uint64(3) + low[:, 1] + np.arange(BANDS, dtype=np.uint64)).view(np.int64).tolist())
                else:
                    bands.append([])
                mask = np.zeros(BITS, np.uint8)
                mask[(s & np.uint64(BITS - 1)).astype(np.int64)] = 1
                bits.append(np.packbits(mask).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(bits, pa.binary())], names)
            seen += sets
            held += sum(map(len, sets))
            if held > HELD:
                kept.append(frequent(seen))
                seen, held = [], 0
        if held:
            kept.append(frequent(seen))
        for values, counts in kept:
            if len(values):
                n = len(values)
                yield pa.RecordBatch.from_arrays([pa.nulls(n, batch.schema.field(0).type), pa.array(np.full(n, -1)), pa.array([v.tobytes() for v in values], pa.binary()), pa.array([[c] for c in counts.tolist()], pa.list_(pa.int64())), pa.nulls(n, pa.binary())], names)

    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), f"id {dict(rows.dtypes)['id']}, n bigint, digest binary, bands array<bigint>, bits binary")


def verified_pairs(pairs: DataFrame, docs: DataFrame, key: str, text: str, words: int, threshold: float) -> DataFrame:
    """The pairs (a, b) of ids whose texts link, written. Only texts of ids in pairs are shuffled."""
    num, den = _ratio(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 200):
            right = batch.column(3).dictionary_encode()  # a star's centre is hashed once
            centres = _sets(right.dictionary, words)
            keep = []
            for s, c in zip(_sets(batch.column(2), words), right.indices.to_pylist(), strict=True):
                shared = len(np.intersect1d(s, centres[c], assume_unique=True))
                keep.append(shared > 0 and den * shared >= num * (len(s) + len(centres[c]) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = dict(pairs.dtypes)["a"]
    with Scratch() as scratch:
        ids = scratch.materialize(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "ids")
        texts = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("t"))
        texts = scratch.materialize(join_ids(texts, ids, "id").groupBy("id").agg(F.first("t").alias("t")), "texts")
        left = pairs.join(texts.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a")
        both = left.join(texts.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b").select("a", "b", "ta", "tb")
        return materialize(both.mapInArrow(tidy(run), f"a {kind}, b {kind}"), "links")


def shared_least(size):
    """How many leading shingles two linked sets share at least, the smaller having this size.

    Sets with an overlap of o share k among their first `size - o + k` shingles, for any k."""
    return 1 + (F.floor(size / 20) if isinstance(size, Column) else size // 20)


def _ratio(threshold: float) -> tuple[int, int]:
    whole = round(threshold * 10_000)
    return whole // math.gcd(whole, 10_000), 10_000 // math.gcd(whole, 10_000)


def first_shingles(docs: DataFrame, key: str, text: str, words: int, threshold: float, frequent: np.ndarray, total: int) -> DataFrame:
    """Rows (shingle, id) of the leading part of every set, for shingles that lead in two rows or more.

    A task sends each shingle once for all its rows, packed by ranges of hashes; ids of shingles that it has seen
    twice follow as rows of their own, so no shingle gathers more entries in one place than there are tasks."""
    num, den = _ratio(threshold)
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = shared.value
        near = np.zeros(1 << 22, bool)
        near[(late >> np.uint64(42)).astype(np.int64)] = True
        shingle, owner, held = [], [], 0

        def send() -> pa.RecordBatch:
            values, ids = np.concatenate(shingle), np.concatenate(owner)
            order = np.argsort(values, kind="stable")
            values, ids = values[order], ids[order]
            fresh = np.concatenate([[True], values[1:] != values[:-1]])
            again = ~fresh | np.concatenate([~fresh[1:], [False]])
            first = np.flatnonzero(fresh)
            twice = again[first]
            bucket = (values[first] >> np.uint64(52)).astype(np.int64)
            edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            stops = np.concatenate([edges[1:], [len(first)]])
            kinds = [int(bucket[e]) for e in edges]
            blobs = [values[first[a:b]].tobytes() for a, b in zip(edges, stops, strict=True)]
            owners = [ids[first[a:b]].tobytes() for a, b in zip(edges, stops, strict=True)]
            flags = [twice[a:b].tobytes() for a, b in zip(edges, stops, strict=True)]
            # further rows of shingles seen twice need no count: they may go anywhere, in packed pieces
            rest = np.flatnonzero(~fresh)
            for a in range(0, len(rest), 50_000):
                kinds.append(-1 - int(values[rest[a]] >> np.uint64(52)))
                blobs.append(values[rest[a : a + 50_000]].tobytes())
                owners.append(ids[rest[a : a + 50_000]].tobytes())
                flags.append(b"")
            return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary()), pa.array(owners, pa.binary()), pa.array(flags, pa.binary())], ["bucket", "shingles", "ids", "twice"])

        for batch in _slices(batches):
            ids = batch.column(0).to_pylist()
            for s, i in zip(_sets(batch.column(1), words), ids, strict=True):
                if not len(s) or i is None:
                    continue
                count = len(s) - -(-num * len(s) // den) + shared_least(len(s))
                if len(late):
                    odd = near[(s >> np.uint64(42)).astype(np.int64)]
                    if odd.any():
                        where = np.flatnonzero(odd)
                        at = np.minimum(np.searchsorted(late, s[where]), len(late) - 1)
                        odd[where] = late[at] == s[where]
                        s = np.concatenate([s[~odd], s[odd]])
                count = min(count, len(s))
                shingle.append(s[:count].copy())  # a view would hold the whole batch
                owner.append(np.full(count, i, np.int64))
                held += count
            if held > HELD:
                yield send()
                shingle, owner, held = [], [], 0
        if held:
            yield send()

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, parts = ["shingle", "id"], defaultdict(list)
        for b in batches:
            for kind, s, i, t in zip(*(b.column(c).to_pylist() for c in range(4)), strict=True):
                if kind < 0:
                    yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(s, np.int64)), pa.array(np.frombuffer(i, np.int64))], names)
                else:
                    parts[kind].append((s, i, t))
        for kind in sorted(parts):  # one bucket at a time
            rows = parts.pop(kind)
            values, ids, twice = (np.frombuffer(b"".join(r[k] for r in rows), t) for k, t in enumerate((np.uint64, np.int64, bool)))
            order = np.argsort(values, kind="stable")
            values, ids, twice = values[order], ids[order], twice[order]
            same = values[1:] == values[:-1]
            keep = twice | np.concatenate([[False], same]) | np.concatenate([same, [False]])
            yield pa.RecordBatch.from_arrays([pa.array(values[keep].view(np.int64)), pa.array(ids[keep])], names)

    # about 12 MB of shingles and ids a task; leading shingles are a fixed share of all
    tasks = max(1, min(4096, math.ceil((1 - threshold + 0.05) * total * 17 / 12e6)))
    packed = rows.mapInArrow(tidy(run), "bucket int, shingles binary, ids binary, twice binary").repartition(tasks, "bucket")
    return packed.mapInArrow(tidy(repeated), "shingle bigint, id bigint")


def tree_pairs(size: np.ndarray, group: np.ndarray, bits: np.ndarray, side: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs [k, 2] of rows that may link, found by dual traversal of one signature tree.

    size, group and bits (uint64 [m, BITS / 64]) describe m sets; rows of one group are not paired, nor are rows that are both of side 1."""
    order = np.argsort(size, kind="stable")
    size, group, bits, side = size[order], group[order], bits[order], side[order]
    excess = size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    levels = [(bits, size, size, excess, group, group, side, side)]
    for width in iter(lambda: LEAF if len(levels) == 1 else 4, None):
        b, lo, hi, ex, g0, g1, s0, s1 = levels[-1]
        if len(lo) == 1:
            break
        at = np.arange(0, len(lo), width)
        levels.append((np.bitwise_or.reduceat(b, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(ex, at), np.minimum.reduceat(g0, at), np.maximum.reduceat(g1, at), np.minimum.reduceat(s0, at), np.maximum.reduceat(s1, at)))
    need = threshold / (1 + threshold)

    def possible(level: tuple, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        b, lo, hi, ex, g0, g1, s0, s1 = level
        ok = (hi[x] >= threshold * lo[y] - 1e-9) & (hi[y] >= threshold * lo[x] - 1e-9)
        ok &= ~((g0[x] == g1[x]) & (g0[y] == g1[y]) & (g0[x] == g0[y])) & ~((s0[x] == 1) & (s0[y] == 1))
        live = np.flatnonzero(ok)
        for a in range(0, len(live), 100_000):
            k = live[a : a + 100_000]
            overlap = np.bitwise_count(b[x[k]] & b[y[k]]).sum(axis=1, dtype=np.int64) + np.minimum(ex[x[k]], ex[y[k]])
            ok[k] = overlap >= need * (lo[x[k]] + lo[y[k]]) - 1e-9
        return ok

    x = y = np.zeros(1, np.int64)
    for depth in range(len(levels) - 1, 0, -1):
        ok = possible(levels[depth], x, y)
        x, y = x[ok], y[ok]
        width, count = (LEAF if depth == 1 else 4), len(levels[depth - 1][1])
        step = np.arange(width)
        u = (x[:, None, None] * width + step[None, :, None]).repeat(width, 2).reshape(-1)
        v = (y[:, None, None] * width + step[None, None, :]).repeat(width, 1).reshape(-1)
        keep = (u < count) & (v < count) & (u < v if depth == 1 else u <= v)
        x, y = u[keep], v[keep]
    if len(levels) == 1:
        return np.zeros((0, 2), np.int64)
    ok = possible(levels[0], x, y)
    return np.stack([order[x[ok]], order[y[ok]]], 1)


def leaf_pairs(
    begin: np.ndarray, end: np.ndarray, size: np.ndarray, group: np.ndarray, bits: np.ndarray, side: np.ndarray, threshold: float,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row, row) that may link in many small shards [begin, end) at once: each is a tree of one leaf."""
    count = end - begin
    need, weight = threshold / (1 + threshold), count * (count - 1) // 2
    if not weight.sum():
        return
    stops = np.searchsorted(np.cumsum(weight), np.arange(200_000, int(weight.sum()) + 200_000, 200_000), side="left") + 1
    excess = size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True):
        first, m = begin[a:b], count[a:b]
        if not len(first):
            continue
        row = np.repeat(first, m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        after = np.repeat(first + m, m) - row - 1  # rows of the shard behind each row
        u = np.repeat(row, after)
        v = u + 1 + np.arange(after.sum()) - np.repeat(np.cumsum(after) - after, after)
        ok = (size[u] >= threshold * size[v] - 1e-9) & (size[v] >= threshold * size[u] - 1e-9) & (group[u] != group[v]) & ~((side[u] == 1) & (side[v] == 1))
        u, v = u[ok], v[ok]
        overlap = np.bitwise_count(bits[u] & bits[v]).sum(axis=1, dtype=np.int64) + np.minimum(excess[u], excess[v])
        ok = overlap >= need * (size[u] + size[v]) - 1e-9
        yield u[ok], v[ok]


def met_shingles(placed: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """(shingle, id, n, grp, lost) of the leading shingles that can show a link between two groups, from rows (shingle, id, grp)
    and (id, n, grp).

    A shingle of one group shows none. A set whose shingles with other groups are fewer than the least that a link takes has none.
    A shingle of more than HOT sets is left out of those sets that have fewer such shingles than a link takes: they then share
    others with whatever they link with. `lost` is the number left out; a pair needs so many fewer."""
    num, den = _ratio(threshold)
    mixed = placed.groupBy("shingle").agg(F.min("grp").alias("g0"), F.max("grp").alias("g1"), F.count("*").alias("m")).where("g0 <> g1").select("shingle", (F.col("m") > HOT).alias("hot"))
    met = placed.select("shingle", "id").join(mixed, "shingle")
    counts = met.groupBy("id").agg(F.count("*").alias("m"), F.count_if("hot").alias("h")).join(groups.select("id", "n", "grp"), "id")
    least = shared_least(F.expr(f"(n * {num} + {den - 1}) div {den}"))  # of a pair with the smallest set that may link
    live = counts.where(F.col("m") >= least).select("id", "n", "grp", F.when(F.col("h") < least, F.col("h")).otherwise(0).alias("lost"))
    return met.join(live, "id").where("not (hot and lost > 0)").select("shingle", "id", "n", "grp", "lost")


def candidate_pairs(members: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (a, b) of ids that may link, from rows (shingle, id, n, grp, lost) and (id, n, bits): those that the trees of
    enough shingles let through.

    Rows meet in shards of one shingle and one band of sizes: sizes of linked sets differ by at most the threshold, so a set
    also visits the next band, where it is only compared with that band's own. Shards beyond TREE rows are cut into blocks and each
    pair of blocks is a shard. Bitmaps are joined to the rows of the shards only."""
    base = math.log(1 / threshold)
    banded = members.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / base + 1e-9))
    visits = banded.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("band", F.col("band") + F.col("side"))
    counts = visits.groupBy("shingle", "band").agg(F.count("*").alias("m"), F.min("side").alias("own"), F.min("grp").alias("g0"), F.max("grp").alias("g1"), F.min("id").alias("lead")).where("m > 1 and own = 0 and g0 <> g1")
    visits = visits.join(counts.select("shingle", "band", "lead", F.ceil(F.col("m") / SPREAD).alias("spread"), F.ceil(F.col("m") / TREE).alias("blocks")), ["shingle", "band"])
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    cut = F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: F.least(j, block) * F.col("blocks") + F.greatest(j, block)))
    shards = visits.withColumn("pair", F.explode(cut)).withColumn("shard", F.xxhash64("shingle", "band", "pair"))
    # shingles of the same few sets meet in one task, which counts their pairs; those of many sets are spread
    shards = shards.select("shard", "id", "n", "grp", "side", "lost", F.xxhash64("lead", F.pmod(F.col("shard"), F.col("spread"))).alias("place"))
    shards = shards.join(sketches.select("id", "n", "bits"), ["id", "n"]).repartition("place").sortWithinPartitions("shard")
    shards = shards.select("shard", "id", "n", "grp", "bits", "side", "lost")
    kind = dict(members.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, ...]] = []
        held = 0
        rest: pa.Table | None = None

        def emit() -> pa.RecordBatch:
            a, b, k, c = (np.concatenate([f[j] for f in found]) if found else np.zeros(0, np.int64) for j in range(4))
            order = np.lexsort((b, a))
            a, b, k, c = a[order], b[order], k[order], c[order]
            first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
            out = [a[first], b[first], np.add.reduceat(c, first) if len(first) else c, k[first]]
            found[:] = [(out[0], out[1], out[3], out[2])] if len(first) else []
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b", "c", "k"])

        def keep(ids: np.ndarray, n: np.ndarray, lost: np.ndarray, u: np.ndarray, v: np.ndarray) -> int:
            different = ids[u] != ids[v]
            u, v = u[different], v[different]
            if len(u):
                found.append((np.minimum(ids[u], ids[v]), np.maximum(ids[u], ids[v]), shared_least(np.minimum(n[u], n[v])) - np.maximum(lost[u], lost[v]), np.ones(len(u), np.int64)))
            return len(u)

        def work(t: pa.Table) -> int:
            if not len(t):
                return 0
            shard, ids = t.column(0).to_numpy(), t.column(1).to_numpy()
            n, grp, side, lost = (t.column(c).to_numpy() for c in (2, 3, 5, 6))
            bits = np.frombuffer(b"".join(t.column(4).to_pylist()), np.uint64).reshape(len(t), BITS // 64)
            edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
            small = np.diff(edges) <= LEAF
            total = sum(keep(ids, n, lost, u, v) for u, v in leaf_pairs(edges[:-1][small], edges[1:][small], n, grp, bits, side, threshold))
            for a, b in zip(edges[:-1][~small].tolist(), edges[1:][~small].tolist(), strict=True):
                pairs = tree_pairs(n[a:b], grp[a:b], bits[a:b], side[a:b], threshold) + a
                total += keep(ids, n, lost, pairs[:, 0], pairs[:, 1])
            return total

        for batch in batches:
            whole = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            shard = whole.column(0).to_numpy()
            last = int(np.searchsorted(np.cumsum(np.concatenate([[0], shard[1:] != shard[:-1]])), (shard[1:] != shard[:-1]).sum())) if len(shard) else 0
            held += work(whole.slice(0, last))
            rest = whole.slice(last)
            if held > HELD:
                emit()  # adds up what is held
                held = sum(len(f[0]) for f in found)
                if held > 500_000:
                    yield emit()
                    found.clear()
                    held = 0
        if rest is not None:
            work(rest)
        yield emit()

    met = shards.mapInArrow(tidy(run), "a bigint, b bigint, c bigint, k bigint").groupBy("a", "b").agg(F.sum("c").alias("c"), F.max("k").alias("k"))
    return met.where("c >= k").select(F.col("a").cast(kind), F.col("b").cast(kind))


def jaccard_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, threshold: float = 0.75) -> DataFrame:
    """(key, n_shingles, component_id) of every row.

    Texts link when their sets of `words`-word shingles have Jaccard similarity of at least the threshold (A-Z lower-cased, words cut
    at ASCII white space). A text of fewer words has its whole sequence as its one shingle; null, empty
    and blank texts have none and link with nothing. component_id is the smallest key reachable by links, itself
    included. Keys are whole numbers; rows that share a key count as one document, rows without a key keep a null
    component. An empty table gives an empty result."""
    with Scratch() as scratch:
        return _joined(docs, key, text, words, threshold, scratch)


def _joined(docs: DataFrame, key: str, text: str, words: int, threshold: float, scratch: Scratch) -> DataFrame:
    sets = scratch.materialize(describe_sets(docs, key, text, words), "sets")
    rows = sets.where("n >= 0")
    late = sets.where("n = -1").groupBy("digest").agg(F.sum(F.element_at("bands", 1)).alias("c")).where("c >= 32").orderBy(F.desc("c"), "digest").limit(FREQUENT)
    frequent = np.sort(np.array([int.from_bytes(r["digest"], "little") for r in late.select("digest").collect()], np.uint64))
    known = rows.where("n > 0 and id is not null")
    classes = scratch.materialize(known.groupBy("digest").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("bits").alias("bits")), "classes")
    member = scratch.materialize(known.select("id", "digest").join(classes.select("digest", "rep"), "digest").select("id", "rep"), "members")
    sizes = materialize(rows.select("id", "n"), "sizes")  # the result reads these
    kind = dict(rows.dtypes)["id"]
    scratch.drop(sets)

    # the first forest
    band = classes.select("rep", F.explode("bands").alias("band"))
    centre = band.groupBy("band").agg(F.min("rep").alias("b"), F.count("*").alias("m")).where("m > 1").select("band", "b")
    stars = scratch.materialize(band.join(centre, "band").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct(), "stars")
    links = verified_pairs(stars, docs, key, text, words, threshold)
    same = member.where("id <> rep").select(F.col("id").alias("src"), F.col("rep").alias("dst"))
    edges = links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    forest = connected_components(edges.unionByName(same))

    # the links that it missed
    copies = scratch.materialize(member.where("id <> rep").select(F.col("id").alias(key)).distinct(), "copies")
    total = classes.agg(F.sum("n")).first()[0] or 0
    firsts = docs.where(F.col(key).isNotNull()).select(key, text)
    leading = first_shingles(join_ids(firsts, copies, key, "left_anti"), key, text, words, threshold, frequent, total)
    group = classes.join(forest.withColumnRenamed("node", "rep"), "rep", "left").select(F.col("rep").cast("bigint").alias("id"), F.coalesce("component", "rep").cast("bigint").alias("grp"), "n", "bits")
    group = scratch.materialize(group, "groups")
    scratch.drop(classes)
    placed = scratch.materialize(leading.join(group.select("id", "grp"), "id"), "placed")
    met = scratch.materialize(met_shingles(placed, group, threshold), "met")
    scratch.drop(placed)
    pairs = scratch.materialize(candidate_pairs(met, group, threshold), "pairs")
    scratch.drop(met)
    more = verified_pairs(pairs.select(F.col("a").cast(kind), F.col("b").cast(kind)), docs, key, text, words, threshold)
    stars = forest.where("node <> component").select(F.col("node").alias("src"), F.col("component").alias("dst"))  # stands for its links
    final = connected_components(stars.unionByName(more.select(F.col("a").alias("src"), F.col("b").alias("dst"))))
    out = sizes.join(final.withColumnRenamed("node", "id"), "id", "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
