"""Byte-level BPE encoding by backtracking over longest matches, and decoding by an offset table.

A text is cut into pieces by the tokenizer's pattern. Each distinct piece of a slice is encoded once: an
Aho-Corasick automaton over all token byte strings finds the longest token at every position in one pass;
going left to right, the longest token is taken if it may stand beside the token before it, else a shorter
prefix of it, else the token before it is shortened. Two tokens may stand side by side if merging by rank
would keep the border between them; the answers are kept in a pair table. Since no position is left by the
same way twice, the work is linear in the piece and the result is exactly that of merging by rank.

Missing texts count as empty: no tokens, and the empty string when decoded. Special tokens of the
vocabulary that stand in a text are taken as such, as the tokenizers library does by default.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tideshift.llm.common import map_texts, utf8, with_fields

# How byte-level vocabularies cut texts before merging; white space is the Unicode property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
GAP = "Ā"  # no byte, so no token spans it
CACHED_PIECES = 300_000


def byte_names() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte, back to the byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by id, the parts and rank of each merge, and the special tokens."""

    tokens: list[bytes]
    parts: list[tuple[int, int]]
    ranks: list[int]
    special: dict[str, int]


def load_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE vocabulary file (JSON, with its merges in order of rank)."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    names, vocab = byte_names(), stored["model"]["vocab"]
    special = {t["content"]: t["id"] for t in stored.get("added_tokens", [])}
    size = max([*vocab.values(), *special.values()]) + 1
    tokens, parts, ranks = [b""] * size, [(i, i) for i in range(size)], [-1] * size
    for name, i in vocab.items():
        if name not in special:
            tokens[i] = bytes(names[c] for c in name)
    for name, i in special.items():
        tokens[i] = name.encode()
    for rank, merge in enumerate(stored["model"]["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        made = vocab[left + right]
        parts[made], ranks[made] = (vocab[left], vocab[right]), rank
    return Vocabulary(tokens, parts, ranks, special)


class Encoder:
    """Pieces to token ids; one per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.parts, self.ranks = vocabulary.parts, vocabulary.ranks
        special = set(vocabulary.special.values())
        names = {t.decode("latin-1"): i for i, t in enumerate(vocabulary.tokens) if t and i not in special}
        self.lengths = [len(t) for t in vocabulary.tokens]
        self.automaton = ahocorasick.Automaton()
        for name, i in names.items():
            self.automaton.add_word(name, (i, len(name)))
        self.automaton.make_automaton()
        # The next shorter token that starts a token.
        self.shorter = [-1] * len(vocabulary.tokens)
        for name, i in names.items():
            self.shorter[i] = next((names[name[:k]] for k in range(len(name) - 1, 0, -1) if name[:k] in names), -1)
        self.merged = {p: i for i, p in enumerate(self.parts) if self.ranks[i] >= 0}
        self.pairs: dict[tuple[int, int], bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging by rank keeps the border between two tokens.

        Undo the merges on both sides of the border from the last one back. The border falls if, at some
        moment, the two symbols at it merge earlier than the merges that come next on their sides.
        """
        known = self.pairs.get((left, right))
        if known is None:
            known = self.pairs[left, right] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        ranks, parts = self.ranks, self.parts
        # Rank of the merge that was undone last; in a tie of one rank the left one goes first.
        limit = len(ranks)
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and ranks[joined] < limit:
                return False
            a, b = ranks[left], ranks[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, parts[left][1]
            else:
                limit, right = b + 1, parts[right][0]

    def encode_all(self, pieces: Sequence[str]) -> list[bytes]:
        """Ids of each piece as packed little-endian unsigned 32-bit numbers."""
        raw = [p.encode().decode("latin-1") for p in pieces]
        joined = GAP.join(raw)
        longest = np.full(len(joined) + 1, -1, np.int32).tolist()
        for end, (token, length) in self.automaton.iter(joined):
            longest[end - length + 1] = token  # matches from one start come in order of length
        out, at = [], 0
        for text in raw:
            out.append(np.array(self._encode(longest, at, at + len(text)), "<u4").tobytes())
            at += len(text) + 1
        return out

    def _encode(self, longest: list[int], start: int, stop: int) -> list[int]:
        if start == stop:
            return []
        lengths, shorter, compatible = self.lengths, self.shorter, self.compatible
        token = longest[start]
        if start + lengths[token] == stop:
            return [token]
        taken: list[int] = []
        dead = bytearray(stop - start + 1)  # positions from which the rest can't be encoded
        at = start
        while at < stop:
            end = at + lengths[token]
            if not dead[end - start] and (not taken or compatible(taken[-1], token)):
                taken.append(token)
                at = end
                token = longest[at] if at < stop else -1
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead[at - start] = 1
                token = taken.pop()
                at -= lengths[token]
        return taken


class Decoder:
    """Token ids to bytes: all token bytes in one array, with the offset of each token."""

    def __init__(self, vocabulary: Vocabulary):
        self.data = np.frombuffer(b"".join(vocabulary.tokens), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in vocabulary.tokens])]).astype(np.int64)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and the bounds of each run of ids in them."""
        starts = self.offsets[ids]
        lengths = self.offsets[ids.astype(np.int64) + 1] - starts
        ends = np.concatenate([[0], np.cumsum(lengths)])
        places = np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])
        return self.data[places], ends[bounds]


class Pieces:
    """Texts to packed ids, each distinct piece encoded once while it is remembered."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.encoder = Encoder(vocabulary)
        self.cut = regex.compile(pattern).findall
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.special_ids = {n: np.array([i], "<u4").tobytes() for n, i in vocabulary.special.items()}
        self.known: dict[str, bytes] = {}

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        cut, whole = [], {}
        for i, text in enumerate(texts):
            if self.special and self.special.search(text):
                whole[i] = self._around_special(text)
                cut.append([p for part in whole[i] if isinstance(part, list) for p in part])
            else:
                cut.append(self.cut(text))
        needed = set().union(*cut) if cut else set()
        new = list(needed.difference(self.known))
        if len(self.known) + len(new) > CACHED_PIECES:
            self.known = {p: self.known[p] for p in needed if p in self.known}
        self.known.update(zip(new, self.encoder.encode_all(new)))
        look = self.known.__getitem__
        out = [b"".join(map(look, pieces)) for pieces in cut]
        for i, parts in whole.items():
            out[i] = b"".join(p if isinstance(p, bytes) else b"".join(map(look, p)) for p in parts)
        return out

    def _around_special(self, text: str) -> list:
        """Lists of pieces, and the packed id of each special token between them."""
        parts, at = [], 0
        for found in self.special.finditer(text):
            parts += [self.cut(text[at : found.start()]), self.special_ids[found.group()]]
            at = found.end()
        return [*parts, self.cut(text[at:])]


def packed_column(packed: Sequence[bytes]) -> pa.Array:
    return pa.array(packed, pa.binary())


def decoded_column(decoder: Decoder, packed: pa.Array) -> pa.Array:
    """Decoded texts; byte sequences that are no UTF-8 become replacement characters."""
    data, offsets = utf8(packed)
    raw, bounds = decoder.decode(np.frombuffer(data.tobytes(), "<u4"), offsets // 4)
    joined = raw.tobytes()
    texts = [joined[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    return pa.array(texts, pa.string())


def _steps(df, vocabulary, text, keep, pattern, encode, decode):
    made = [("n_tokens", T.LongType()), ("token_ids", T.BinaryType())] if encode else []
    made += [("decoded", T.StringType())] if decode else []
    schema = with_fields(df, keep, made)
    column = text if encode else "token_ids"
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by the tokenizer's size
    names = [n for n, _ in made]

    def work():
        pieces = Pieces(shared.value, pattern) if encode else None
        decoder = Decoder(shared.value) if decode else None

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = {}
            packed = batch.column(column)
            if encode:
                texts = packed.fill_null("").to_pylist()
                packed = packed_column(pieces.encode(texts))
                columns["token_ids"] = packed
                columns["n_tokens"] = pa.array(np.diff(utf8(packed)[1]) // 4, pa.int64())
            if decode:
                columns["decoded"] = decoded_column(decoder, packed)
            kept = {f.name: batch.column(f.name) for f in schema.fields if f.name not in names}
            return pa.RecordBatch.from_arrays(
                [kept[f.name] if f.name in kept else columns[f.name] for f in schema.fields], names=schema.names
            )

        return step

    inputs = list(dict.fromkeys([*[f.name for f in schema.fields if f.name not in names], column]))
    return map_texts(df.select(*inputs), work, schema, column)


def encode_texts(
    df: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: Sequence[str] = ("doc_id",), pattern: str = PATTERN
) -> DataFrame:
    """The kept columns with ``n_tokens`` and ``token_ids`` (packed little-endian unsigned 32-bit numbers)."""
    return _steps(df, vocabulary, text, keep, pattern, True, False)


def decode_tokens(df: DataFrame, vocabulary: Vocabulary, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns with ``decoded``, the text of ``token_ids``; missing ids give the empty text."""
    return _steps(df, vocabulary, "", keep, PATTERN, False, True)


def round_trip(
    df: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: Sequence[str] = ("doc_id",), pattern: str = PATTERN
) -> DataFrame:
    """Encode and decode in one pass: ``n_tokens``, ``token_ids`` and ``decoded`` beside the kept columns."""
    return _steps(df, vocabulary, text, keep, pattern, True, True)
