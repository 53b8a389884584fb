"""Byte-level BPE encoding and decoding.

``encode_words`` is the form in Spark functions alone: a higher-order fold over
the byte pieces of distinct words that merges the adjacent pair of least rank,
looked up in a literal rank map, until none is left. A literal map is searched
entry by entry, so this form suits small rank maps and word lists; see the
README for its figures on whole corpora.

``encode_documents`` runs the same fold in Python over each task's distinct
words: a text is split by the pattern, every piece not seen lately is merged by
rank, and the pieces' ids are joined. Decoding concatenates the tokens' bytes.
"""

from __future__ import annotations

import base64
import struct
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct pieces, and distinct words, whose ids a worker remembers, and as many of
#: those before them.
CACHE_PIECES = 200_000
#: Rank of a pair that has none.
_NONE = 1 << 40
#: Patterns under which a space between two characters that are not white begins a
#: piece, whatever else stands around it, so that a text may be cut there.
CUT_AT_SPACES = frozenset({r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"})


@cache
def load_ranks(raw: bytes) -> dict[bytes, int]:
    """Byte piece -> rank, from the lines of a rank file (base64, rank)."""
    return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, raw.splitlines())}


@cache
def token_bytes(raw: bytes) -> list[bytes]:
    """Rank -> byte piece; ranks that the file leaves out are empty."""
    ranks = load_ranks(raw)
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        out[rank] = piece
    return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: merge the adjacent pair of least rank (the first of
    equals) until no pair has a rank."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    get = ranks.get
    starts = list(range(len(piece) + 1))
    pair = [get(piece[i : i + 2], _NONE) for i in starts[:-2]]
    while pair and (low := min(pair)) < _NONE:
        i = pair.index(low)
        del starts[i + 1], pair[i]
        if i:
            pair[i - 1] = get(piece[starts[i - 1] : starts[i + 1]], _NONE)
        if i < len(pair):
            pair[i] = get(piece[starts[i] : starts[i + 2]], _NONE)
    return [ranks[piece[i:j]] for i, j in zip(starts, starts[1:], strict=False)]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """``merge`` for long pieces: a heap of pairs over a linked list, so that the
    time is not the square of the length."""
    import heapq

    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that starts at i
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else -1
        if j < 0 or end[j] != stop:
            continue  # one of the two parts has changed since
        end[i], alive[j], after[i] = end[j], False, after[j]
        if after[i] >= 0:
            before[after[i]] = i
            if (r := ranks.get(piece[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[after[i]]))
        if (h := before[i]) >= 0 and (r := ranks.get(piece[h : end[i]])) is not None:
            heapq.heappush(heap, (r, h, end[i]))
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


class Lately(dict):
    """A map that forgets what was not asked for lately: once it holds ``CACHE_PIECES``
    keys, it starts anew, and takes over from the former one what is missed."""

    def __init__(self):
        super().__init__()
        self.former: dict = {}

    def find(self, key):
        """The value of a key that ``get`` does not know, if the former map has it."""
        if (value := self.former.get(key)) is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= CACHE_PIECES:
            self.former = dict(self)
            self.clear()
        self[key] = value


class Encoder:
    """Encodes texts piece by piece and remembers the ids of pieces, and of words
    between single spaces where the pattern allows to cut there."""

    def __init__(self, raw: bytes, pattern: str):
        self.ranks, self.tokens = load_ranks(raw), np.array(token_bytes(raw), object)
        self.split, self.known = regex.compile(pattern), Lately()
        self.words, self.cuts = Lately(), pattern in CUT_AT_SPACES

    def _piece(self, piece: str) -> bytes:
        if (ids := self.known.find(piece)) is not None:
            return ids
        data = piece.encode("utf-8", "replace")
        found = (merge if len(data) < 200 else merge_long)(data, self.ranks)
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(piece) < 64:
            self.known.keep(piece, ids)
        return ids

    def _by_piece(self, text: str) -> bytes:
        known, own = self.known.get, self._piece
        return b"".join([known(p) or own(p) for p in self.split.findall(text)])

    def _word(self, word: str) -> bytes:
        """Ids of a word that neither starts nor ends white, and of the space before it."""
        if (ids := self.words.find(word)) is None:
            ids = self._by_piece(" " + word)
            if len(word) < 64:
                self.words.keep(word, ids)
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers. A text with other
        white characters beside a space is not cut into words."""
        first, *words = text.split(" ")
        if not self.cuts or not words or first[-1:].isspace():
            return self._by_piece(text)
        ids = list(map(self.words.get, words))
        if None in ids:
            new = [i for i, x in enumerate(ids) if x is None]
            if any(not w or w[0].isspace() or w[-1].isspace() for w in map(words.__getitem__, new)):
                return self._by_piece(text)
            for i in new:
                ids[i] = self._word(words[i])
        return self._by_piece(first) + b"".join(ids)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.tokens[np.frombuffer(ids, "<u4")])


_encoders: dict[tuple[int, str], Encoder] = {}


def encoder(raw: bytes, pattern: str) -> Encoder:
    """The worker's encoder for a rank file: built once, kept between tasks."""
    key = (hash(raw), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(raw, pattern)
    return _encoders[key]


def encode_documents(documents: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (binary: little-endian unsigned 32-bit
    integers), decoded (binary: the bytes of the decoded ids).

    A null text counts as empty and has no ids. Rows that repeat stay; other
    columns are passed over. No shuffle. The rank file (a fixed vocabulary, under
    1 MB) is read on the driver and broadcast, so executors need no copy of it.
    """
    with open(rank_file, "rb") as f:
        shared = documents.sparkSession.sparkContext.broadcast(f.read())

    def run(texts: pd.Series) -> pd.DataFrame:
        own = encoder(shared.value, pattern)
        ids = [own.encode(t) if isinstance(t, str) else b"" for t in texts]
        return pd.DataFrame({"ids": ids, "decoded": [own.decode(x) for x in ids]})

    codec = F.pandas_udf(run, "ids binary, decoded binary")
    return documents.select(F.col(id_col).alias("doc_id"), codec(F.col(text_col)).alias("r")).select("doc_id", "r.*")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of ``encode_documents``."""
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def encode_words(words: DataFrame, ranks: dict[bytes, int], word_col: str = "word") -> DataFrame:
    """(word, ids) of the distinct non-null words, with Spark functions alone.

    The fold's state is the array of a word's byte pieces in hex; each of its
    length - 1 steps merges the first adjacent pair of least rank, or keeps the
    state when no pair has one.
    """
    keys = F.array(*[F.lit(k.hex().upper()) for k in ranks])
    table = F.map_from_arrays(keys, F.array(*[F.lit(v) for v in ranks.values()]))

    def rank(piece: Column) -> Column:
        return F.coalesce(F.element_at(table, piece), F.lit(_NONE))

    def step(parts: Column, _: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: rank(F.concat(F.get(parts, i - 1), F.get(parts, i))))
        low = F.array_min(pairs)
        at = F.array_position(pairs, low).cast("int")
        merged = F.concat(
            F.slice(parts, 1, at - 1),
            F.array(F.concat(F.element_at(parts, at), F.element_at(parts, at + 1))),
            F.slice(parts, at + 2, F.size(parts)),
        )
        return F.when(F.size(parts) < 2, parts).when(low == _NONE, parts).otherwise(merged)

    digits = F.hex(F.encode(F.col(word_col), "UTF-8"))
    parts = F.transform(F.sequence(F.lit(1), F.length(digits), F.lit(2)), lambda i: F.substring(digits, i, F.lit(2)))
    folded = F.aggregate(F.sequence(F.lit(1), F.size(parts)), parts, step)
    return (
        words.select(word_col)
        .where(F.length(word_col) > 0)
        .distinct()
        .select(F.col(word_col).alias("word"), F.transform(folded, rank).alias("ids"))
    )
