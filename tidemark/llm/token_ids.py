"""Token ids of whole texts by a public vocabulary file.

Any file of the `tokenizers` library works. For vocabularies of one common shape (lower-cased words with an end mark,
byte symbols, no token across white space) the ids of a text are those of its white-space chunks, so
chunks are looked up and only new ones are encoded; words of Latin letters then go through a byte-pair
encoder of `tiktoken` that gets the same merges. Everything else is left to the `tokenizers` library."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable

#: FIXED VALUES: the pre-tokenizer pattern of that shape, and how it cuts a lower-cased Latin-1 chunk.
SHAPE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^\\sa-z\xaa\xb5\xba0-9\xb2\xb3\xb9\xbc-\xbe\xdf-\xf6\xf8-\xff]+")
#: Characters over which texts are not cut into chunks: unusual white space, and the start of special tokens.
ODD = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -‏    ⁠　﻿]|<\\|")
WORD = re.compile("[a-z\xdf-\xf6\xf8-\xff]+\\Z")
#: Chunks remembered by a worker (about 60 MB).
CACHED = 300_000
_loaded: dict[str, tuple] = {}


def encoder(path: str) -> tuple[Callable[[list[str]], list[bytes]], str]:
    """(texts -> ids as little-endian bytes, numpy type of an id): two bytes an id if the vocabulary allows."""
    if path not in _loaded:
        _loaded[path] = _load(path)
    return _loaded[path]


def _load(path: str) -> tuple:
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    whole = Tokenizer.from_file(path)
    kind, code = ("<u2", "H") if whole.get_vocab_size(with_added_tokens=True) <= 1 << 16 else ("<u4", "I")

    def plain(texts: list[str]) -> list[bytes]:
        return [array(code, e.ids).tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]

    spec = json.loads(open(path, encoding="utf-8").read())
    if not _has_shape(spec):
        return plain, kind
    word, chunks, pieces = _word_encoder(spec), {}, {}

    def encode_piece(piece: str) -> bytes:
        if word and WORD.match(piece):
            return array(code, word(piece)).tobytes()
        if piece not in pieces:
            if len(pieces) >= CACHED:
                pieces.clear()
            pieces[piece] = plain([piece])[0]
        return pieces[piece]

    def encode_chunk(chunk: str) -> bytes:
        if max(chunk) > "\xff":
            return plain([chunk])[0]
        return b"".join(map(encode_piece, PIECE.findall(chunk.lower())))

    def encode(texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if ODD.search(text):
                out += plain([text])
                continue
            own = text.split()
            try:
                out.append(b"".join(map(chunks.__getitem__, own)))
            except KeyError:
                fresh = set(own).difference(chunks)
                if len(chunks) + len(fresh) > CACHED:
                    chunks.clear()
                    fresh = set(own)
                chunks.update((c, encode_chunk(c)) for c in fresh)
                out.append(b"".join(map(chunks.__getitem__, own)))
        return out

    return encode, kind


def _has_shape(spec: dict) -> bool:
    steps = [s["type"] for s in (spec.get("normalizer") or {}).get("normalizers", [])]
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        steps == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0]["pattern"] == {"Regex": SHAPE} and cuts[0]["invert"] and not cuts[1]["add_prefix_space"]
        and spec["model"]["type"] == "BPE" and spec["model"]["end_of_word_suffix"] == "</w>" and not spec["model"]["dropout"] and spec["post_processor"] is None
    )


def _word_encoder(spec: dict) -> Callable[[str], list[int]] | None:
    """Words of a-z and U+00DF-U+00FF -> ids. The last byte of a word stands for `byte plus end mark`: letters become
    capitals, which lower-cased words lack, and continuation bytes lose their high bit."""
    import tiktoken

    vocab, merges = spec["model"]["vocab"], [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    first = vocab.get("".join(merges[0]), 0)
    if any(vocab.get(a + b) != first + i for i, (a, b) in enumerate(merges)):
        return None  # ids do not follow the order of merges
    printed = [*range(33, 127), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printed)}
    last = {b: b - 32 for b in range(97, 123)} | {b: b - 128 for b in range(128, 192)}
    ranks = {}
    for token, number in vocab.items():
        ends = token.endswith("</w>")
        own = [byte.get(c, 0) for c in (token[:-4] if ends else token)]
        if own and all(b in last or b == 0xC3 for b in own) and (not ends or own[-1] in last):
            ranks[bytes(own[:-1] + [last[own[-1]] if ends else own[-1]])] = number
    one = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
    marks = {b: bytes([e]) for b, e in last.items()}

    def encode(word: str) -> list[int]:
        own = word.encode()
        return one(own[:-1] + marks[own[-1]])

    return encode
