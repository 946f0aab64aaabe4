"""Language identification by cross-parsing entropy.

For each language a suffix automaton of bounded sample text accepts exactly the substrings of that text. A document is
cut greedily into longest matches (phrases) of each language's text. By Ziv and Merhav's estimate, phrases
times log2(sample length) over text length approaches the cross entropy, so the language
needing the fewest normalised phrases wins. Documents are parsed in lockstep: one array step moves
all segments of a batch by one symbol."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import schema_with, unit_hash
from tidemark.llm.kernels import text_bytes

#: Bytes of sample text for each language: a fit on a bounded sample.
SAMPLE_BYTES = 48_000
#: Longer texts are not taken into a sample, so that none dominates it.
TEXT_BYTES = 4_000
#: Labelled rows looked at for each language, about.
SAMPLE_ROWS = 120
#: Segments of this many bytes are parsed side by side; a phrase ends where its segment does.
SEGMENT = 512
#: Symbols with transitions of their own; all others count as one.
SYMBOLS = 64
UNKNOWN = "und"

_automata: dict[tuple, tuple] = {}


def _fold(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased and everything ASCII that is no letter as a blank."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    plain = np.arange(128)
    table[plain[~((plain >= 97) & (plain <= 122) | (plain >= 65) & (plain <= 90))]] = 32
    return table[data]


def suffix_automaton(text: list[int], symbols: int) -> np.ndarray:
    """Transitions [state, symbol] -> state of the suffix automaton of the text; 0 is the root, -1 none.

    Blumer et al.'s online construction; at most twice as many states as symbols in the text."""
    limit = 2 * len(text) + 2
    step = [[-1] * symbols]
    link, longest, last = [-1], [0], 0
    for c in text:
        now = len(step)
        step.append([-1] * symbols)
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p != -1 and step[p][c] == -1:
            step[p][c] = now
            p = link[p]
        if p != -1:
            q = step[p][c]
            if longest[p] + 1 == longest[q]:
                link[now] = q
            else:
                twin = len(step)
                step.append(step[q][:])
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p != -1 and step[p][c] == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    assert len(step) <= limit
    return np.array(step, np.int32)


def _build(samples: tuple[tuple[str, bytes], ...]) -> tuple:
    """(symbol of each byte, one flat table of all automata, start of each, bits of each sample)."""
    if samples in _automata:
        return _automata[samples]
    folded = [_fold(np.frombuffer(text, np.uint8)) for _, text in samples]
    counts = np.bincount(np.concatenate(folded), minlength=256)
    used = [b for b in np.argsort(-counts, kind="stable")[: SYMBOLS - 1].tolist() if counts[b]]
    symbol = np.zeros(256, np.int64)
    symbol[used] = np.arange(1, len(used) + 1)
    symbols = len(used) + 1
    tables, starts, base = [], [], 0
    for text in folded:
        step = suffix_automaton(symbol[text].tolist(), symbols)
        step[:, 0] = -1  # the shared symbol never matches
        # the last row stands for no phrase at all: before the first symbol, and after one that the sample lacks
        start = len(step)
        step = np.vstack([step, np.full((1, symbols), -1, np.int32)])
        again = np.where(step[0] >= 0, step[0], start)
        # without a transition the phrase ends and the symbol begins the next one: negative marks it
        tables.append(np.where(step >= 0, (step + base) * symbols, ~((again[None, :] + base) * symbols)).astype(np.int32))
        starts.append((base + start) * symbols)
        base += len(step)
    out = (symbol.astype(np.int32), np.concatenate(tables).reshape(-1), np.array(starts, np.int32), np.array([np.log2(max(2, len(t))) for t in folded]))
    _automata.clear()
    _automata[samples] = out
    return out


def phrase_counts(data: np.ndarray, offsets: np.ndarray, samples: tuple[tuple[str, bytes], ...]) -> np.ndarray:
    """Phrases [row, language] of greedy longest matches; a symbol that the sample lacks is a phrase."""
    symbol, table, starts, _ = _build(samples)
    codes = symbol[_fold(data)]
    sizes = np.diff(offsets)
    parts = -(-sizes // SEGMENT)
    row = np.repeat(np.arange(len(sizes)), parts)
    begin = offsets[:-1][row] + SEGMENT * (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts))
    size = np.minimum(SEGMENT, offsets[1:][row] - begin)
    order = np.argsort(-size, kind="stable")
    row, begin, size = row[order], begin[order], size[order]
    total = np.zeros((len(sizes), len(samples)), np.int64)
    alive = np.searchsorted(-size, -np.arange(SEGMENT), side="left")  # segments longer than t
    for k in range(len(samples)):
        state = np.full(len(row), starts[k], np.int32)
        count = np.zeros(len(row), np.int32)
        for t in range(SEGMENT):
            n = alive[t]
            if not n:
                break
            to = table[state[:n] + codes[begin[:n] + t]]
            ended = to >> 31  # -1 where a phrase begins
            count[:n] -= ended
            state[:n] = to ^ ended
        np.add.at(total[:, k], row, count)
    return total


def learn_samples(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> tuple[tuple[str, bytes], ...]:
    """(language, sample text) in order of name, from whole texts in order of a hash of their key.

    A language's sample has about SAMPLE_ROWS texts of at most TEXT_BYTES, and at most SAMPLE_BYTES. Rows without a language or a
    letter are left out."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}") & (F.octet_length(text) <= TEXT_BYTES)).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).alias("key"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    limit = F.lit(0.0)
    for name, n in counts.items():
        limit = F.when(F.col("lang") == name, min(1.0, SAMPLE_ROWS / n)).otherwise(limit)
    samples: dict[str, bytes] = {}
    for r in rows.where(unit_hash("key") < limit).orderBy("lang", unit_hash("key"), "text").collect():
        own = samples.get(r["lang"], b"")
        if len(own) + len(r["text"].encode()) < SAMPLE_BYTES:
            samples[r["lang"]] = own + r["text"].encode() + b" "
    return tuple(sorted(samples.items()))


def identify(docs: DataFrame, samples: tuple[tuple[str, bytes], ...], text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score (0 to 1).

    lang_pred is the language with the fewest normalised phrases, the first by name on ties; `und` with score 0 for a null
    text, one without a letter, or if nothing was learned. The score is the winner's share 1 - best / second
    mapped to 0.5 .. 1 (1 if there is one language). Other columns stay; those two are replaced."""
    kept = docs.drop("lang_pred", "score")
    at, columns = kept.columns.index(text), kept.columns
    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        names = np.array([n for n, _ in learned] + [UNKNOWN], object)
        for whole in batches:
            for begin in range(0, len(whole), 2000):
                batch = whole.slice(begin, 2000)
                data, offsets = text_bytes(batch.column(at))
                found, score = np.full(len(batch), len(learned)), np.zeros(len(batch))
                if learned and len(batch):
                    cost = phrase_counts(data, offsets, learned) * _build(learned)[3]
                    order = np.argsort(cost, axis=1, kind="stable")
                    best = np.take_along_axis(cost, order[:, :1], 1)[:, 0]
                    second = np.take_along_axis(cost, order[:, 1:2], 1)[:, 0] if len(learned) > 1 else np.full(len(batch), np.inf)
                    letters = _has_letter(batch.column(at), data, offsets)
                    found = np.where(letters, order[:, 0], len(learned))
                    score = np.where(letters, 1 - 0.5 * best / np.maximum(second, 1e-9), 0.0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names[found].tolist(), pa.string()), pa.array(score)], [*columns, "lang_pred", "score"])

    return kept.mapInArrow(run, schema_with(kept, ("lang_pred", "string"), ("score", "double")))


def _has_letter(column: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letter = np.zeros(256, np.int64)
    ascii_letter[65:91] = ascii_letter[97:123] = 1
    run = np.concatenate([[0], np.cumsum(ascii_letter[data])])
    has = run[offsets[1:]] > run[offsets[:-1]]
    for i in np.flatnonzero(~has & (np.diff(offsets) > 0)).tolist():
        has[i] = any(c.isalpha() for c in column[i].as_py())
    return has
