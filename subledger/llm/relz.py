"""Exact removal of repeated passages by relative Lempel-Ziv parsing.

Every document is parsed against all others as the reference, in three steps.

*Index.* A text's words are hashed, and every window of ``window`` words (50) is
assigned to its anchor: the run of ``GRAM`` words of least hash inside it, the
leftmost of equals. A maximal run of windows with one anchor is a reference block.
Anchor and block follow from the words alone, so a passage that two documents share
is cut into the same blocks in both, up to its two ends. All blocks of all documents
are indexed under (anchor, fingerprint of their words), with the document of the
smallest id that holds them.

*Greedy factors.* A document is read block by block; a block that the index knows
from a document of a smaller id is copied whole, and the factor goes on as long as
the next windows continue it in that document.

*Factor boundaries.* Where a copied passage begins or ends inside a block, the whole
block is unknown, yet some of its windows may be known. Equal windows have equal
anchors, so only a block whose anchor stands in another, different block can hold
one: such blocks are looked up window by window, where the document is the first to hold them.

A window's words are thus compared through two 64-bit hashes at each level. The words
of all windows found in a document of a smaller id are the duplicate spans.

Bounds. Blocks are some 20 windows long, so the index has a twentieth of the rows that
single windows would make. A block that a third of the documents share is aggregated
to one row before it is shuffled; windows are looked up in a block's first document
only, so a group of copies gives no pairs. Texts are shuffled once, to meet their spans.

Defined results: a null or empty text has no word; a text of fewer than ``window``
words keeps all; a null id is no smaller id and keeps all its words; rows that repeat
an id are no reference for each other and are judged on their own text; other columns
are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import cut

#: Words of an anchor.
GRAM = 8
#: Bits of the fixed-size map of anchors that the second reading looks into (8 MB
#: however large the corpus: beyond it more blocks are read in vain, none is missed).
MAP_BITS = 1 << 26
#: Distinct words whose hashes a worker remembers.
CACHE_WORDS = 1_000_000

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
BLOCKS = "doc_id long, text_id long, place int, windows int, anchor long, print long"

# ------------------------------------------------------------- words and hashes


class _WordHashes(dict):
    """Word -> hash, filled as words come up."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


class Hasher:
    """Word hashes and, from them, hashes of runs of words."""

    def __init__(self):
        self.known = _WordHashes()
        self.powers: list[tuple[np.ndarray, np.ndarray]] = []
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        self.powers = []
        for base in _BASES:
            back = np.uint64(pow(int(base), -1, 1 << 64))
            self.powers.append(tuple(np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, b, np.uint64)))) for b in (base, back)))

    def words(self, text: str) -> np.ndarray:
        """64-bit hashes of a text's words in order."""
        words = text.encode("utf-8", "surrogatepass").split()
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def sums(self, hashes: np.ndarray, which: int) -> np.ndarray:
        """Running sums from which ``run`` gives the hash of any run of words."""
        if len(hashes) >= len(self.powers[0][0]):
            self._grow(2 * len(hashes))
        out = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.powers[which][0][: len(hashes)], out=out[1:])
        return out

    def run(self, sums: np.ndarray, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words in [start, end), the same wherever they stand."""
        return _mix((sums[end] - sums[start]) * self.powers[which][1][start])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_hashers: list[Hasher] = []


def hasher() -> Hasher:
    """The worker's hasher: kept between tasks."""
    if not _hashers:
        _hashers.append(Hasher())
    return _hashers[0]


class Parsed:
    """A text of at least ``window`` words, cut into blocks."""

    def __init__(self, own: Hasher, hashes: np.ndarray, window: int):
        self.own, self.window, n = own, window, len(hashes)
        gram = min(GRAM, window)
        self.first, self.second = own.sums(hashes, 0), own.sums(hashes, 1)
        at = np.arange(n - gram + 1)
        grams = own.run(self.first, 0, at, at + gram)
        span = window - gram + 1
        leftmost = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1) + np.arange(n - window + 1)
        self.place = np.flatnonzero(np.diff(leftmost, prepend=-1))
        self.windows = np.diff(self.place, append=len(leftmost))
        self.anchor = grams[leftmost[self.place]]

    def prints(self) -> np.ndarray:
        """Fingerprint of every block's words."""
        return self.own.run(self.second, 1, self.place, self.place + self.windows + self.window - 1)

    def window_prints(self, blocks: np.ndarray) -> list[np.ndarray]:
        """Fingerprints of the windows of each of these blocks."""
        counts = self.windows[blocks]
        ends = np.cumsum(counts)
        at = np.arange(ends[-1]) + np.repeat(self.place[blocks] - (ends - counts), counts)
        return np.split(self.own.run(self.second, 1, at, at + self.window).view(np.int64), ends[:-1])


def _parsed(texts: pd.Series, window: int) -> Iterator[tuple[int, Parsed]]:
    own = hasher()
    for i, text in enumerate(texts):
        hashes = own.words(text)
        if len(hashes) >= window:
            yield i, Parsed(own, hashes, window)


def _frame(columns: dict[str, list]) -> pd.DataFrame:
    return pd.DataFrame({c: np.concatenate(v) if v else np.empty(0, np.int64) for c, v in columns.items()})


# --------------------------------------------------------------------- the index


def reference_blocks(documents: DataFrame, window: int = 50) -> DataFrame:
    """Every block of every (doc_id, text_id, text): doc_id, text_id, place (its first
    word), windows, anchor, print."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: dict[str, list] = {c.split()[0]: [] for c in BLOCKS.split(", ")}
            ids, texts = frame["doc_id"].to_numpy(), frame["text_id"].to_numpy()
            for i, doc in _parsed(frame["text"], window):
                n = len(doc.place)
                out["doc_id"].append(np.full(n, ids[i]))
                out["text_id"].append(np.full(n, texts[i]))
                out["place"].append(doc.place.astype("int32"))
                out["windows"].append(doc.windows.astype("int32"))
                out["anchor"].append(doc.anchor.view(np.int64))
                out["print"].append(doc.prints().view(np.int64))
            yield _frame(out)

    return documents.mapInPandas(run, BLOCKS)


def _slot(anchor: Column) -> Column:
    """Place of an anchor in the map of anchors."""
    return F.pmod(F.shiftrightunsigned(anchor, 20), F.lit(MAP_BITS)).cast("int")


def anchor_map(anchors: DataFrame) -> bytes:
    """A bit for every anchor of the column, MAP_BITS in all: what is collected has
    MAP_BITS / 64 rows at most."""
    slot = _slot(F.col("anchor"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)))
    rows = anchors.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = rows.toArrow()
    words = np.zeros(MAP_BITS // 64, np.int64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return words.tobytes()


def boundary_windows(documents: DataFrame, anchors: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, text_id, place, anchor, prints) of the blocks whose anchor is, or by
    its place in the map may be, one of ``anchors``: prints has one 64-bit hash a
    window. A second reading of the documents, which shuffles no text."""
    shared = documents.sparkSession.sparkContext.broadcast(anchor_map(anchors))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = np.frombuffer(shared.value, np.uint64)
        for frame in frames:
            out: dict[str, list] = {c: [] for c in ("doc_id", "text_id", "place", "anchor")}
            prints: list[np.ndarray] = []
            ids, texts = frame["doc_id"].to_numpy(), frame["text_id"].to_numpy()
            for i, doc in _parsed(frame["text"], window):
                slot = (doc.anchor >> np.uint64(20)) % np.uint64(MAP_BITS)
                hit = np.flatnonzero((words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1))
                if len(hit):
                    out["doc_id"].append(np.full(len(hit), ids[i]))
                    out["text_id"].append(np.full(len(hit), texts[i]))
                    out["place"].append(doc.place[hit].astype("int32"))
                    out["anchor"].append(doc.anchor[hit].view(np.int64))
                    prints += doc.window_prints(hit)
            yield _frame(out).assign(prints=pd.Series(prints, dtype=object))

    return documents.mapInPandas(run, "doc_id long, text_id long, place int, anchor long, prints array<long>")


# --------------------------------------------------------------------- the parse


def known_windows(documents: DataFrame, window: int = 50) -> DataFrame:
    """Runs of windows that a document of a smaller id holds: (doc_id, text_id,
    place, windows, ref_doc, ref_text, ref_place), the reference the one of smallest
    id; ref_text is the text_id of its row."""
    blocks = cut(reference_blocks(documents, window), "relz-blocks")
    source = F.struct(F.col("doc_id").alias("ref_doc"), "text_id", "place", "windows")
    distinct = blocks.groupBy("anchor", "print").agg(F.min(source).alias("ref"), F.max("doc_id").alias("last"))
    # An anchor of one block in one document matters to no one else.
    by_anchor = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants"), F.min("ref.ref_doc").alias("a"), F.max("last").alias("b"))
    shared = by_anchor.where("a < b").select("anchor", "variants")
    index = distinct.join(shared, "anchor").where("last > ref.ref_doc or variants > 1")
    met = cut(blocks.join(index, ["anchor", "print"]).where("doc_id > ref.ref_doc or variants > 1"), "relz-met")
    copied = met.where("doc_id > ref.ref_doc").select("doc_id", "text_id", "place", "windows", "ref.ref_doc", F.col("ref.text_id").alias("ref_text"), F.col("ref.place").alias("ref_place"))
    # The boundaries: blocks new with their document, of an anchor that has others.
    opened = met.where("doc_id = ref.ref_doc").select("anchor", "doc_id", "text_id", "place")
    read = boundary_windows(documents, opened, window).join(opened, ["doc_id", "text_id", "place", "anchor"])
    each = cut(read.select("doc_id", "text_id", "place", "anchor", F.posexplode("prints").alias("i", "print")), "relz-windows")
    own = each.select("doc_id", "text_id", (F.col("place") + F.col("i")).alias("place"), "anchor", "print")
    firsts = own.groupBy("anchor", "print").agg(
        F.min(F.struct(F.col("doc_id").alias("ref_doc"), "text_id", "place")).alias("ref"), F.max("doc_id").alias("last")
    )
    single = (
        own.join(firsts.where("last > ref.ref_doc"), ["anchor", "print"])
        .where("doc_id > ref.ref_doc")
        .select("doc_id", "text_id", "place", F.lit(1).alias("windows"), "ref.ref_doc", F.col("ref.text_id").alias("ref_text"), F.col("ref.place").alias("ref_place"))
    )
    return copied.unionByName(single)


Run = tuple[int, int, int, int, int]


def greedy_factors(runs: list[Run], window: int) -> list[Run]:
    """Factors (place, length, ref_doc, ref_text, ref_place) in words from runs of known
    windows (place, windows, ref_doc, ref_text, ref_place): a factor goes on as long as
    the next window is known from the place that continues it."""
    out: list[list[int]] = []
    for place, windows, doc, text, at in sorted(runs):
        last = out[-1] if out else None
        if last and last[0] + last[1] == place and last[2:4] == [doc, text] and last[4] + last[1] == at:
            last[1] += windows
        else:
            out.append([place, windows, doc, text, at])
    return [(p, n + window - 1, d, t, a) for p, n, d, t, a in out]


def factors(documents: DataFrame, window: int = 50) -> DataFrame:
    """One row per (doc_id, text_id) that repeats something: factors, an array of
    (place, length, ref_doc, ref_text, ref_place) in words: [place, place + length)
    stands at ref_place of the text ref_text of ref_doc, whose id is smaller."""
    runs = known_windows(documents, window)

    asked = ("place", "windows", "ref_doc", "ref_text", "ref_place")

    @F.pandas_udf("array<struct<place: int, length: int, ref_doc: long, ref_text: long, ref_place: int>>")
    def parse(found: pd.Series) -> pd.Series:
        names = ("place", "length", *asked[2:])
        read = [[tuple(r[c] for c in asked) for r in rows] for rows in found]
        return pd.Series([[dict(zip(names, f, strict=True)) for f in greedy_factors(rows, window)] for rows in read])

    # One document's runs: a twentieth of its words or so.
    grouped = runs.groupBy("doc_id", "text_id").agg(F.collect_list(F.struct(*asked)).alias("runs"))
    return grouped.select("doc_id", "text_id", parse("runs").alias("factors"))


def identified(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_id, text): a null text is empty; text_id tells the texts of an
    id that several rows hold apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_id"), text.alias("text"))


def without_repeats(documents: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (text: the words that
    stay, joined by one blank), factors (null if none)."""
    rows = identified(documents, id_col, text_col)
    named = rows.where(F.col("doc_id").isNotNull())
    found = factors(named, window)

    @F.pandas_udf("n_words long, n_removed long, kept string")
    def cut_out(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for t, fs in zip(text, spans, strict=True):
            words = t.encode("utf-8", "surrogatepass").split()
            stay = np.ones(len(words), bool)
            for f in fs if fs is not None else ():
                stay[f["place"] : f["place"] + f["length"]] = False
            kept = words if stay.all() else [words[i] for i in np.flatnonzero(stay)]
            out.append((len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])

    none = F.lit(None).cast(found.schema["factors"].dataType)
    # Rows without an id stay out of the join, where they would all meet in one task.
    met = named.join(found, ["doc_id", "text_id"], "left").unionByName(rows.where(F.col("doc_id").isNull()).withColumn("factors", none))
    return met.select("doc_id", cut_out("text", "factors").alias("r"), "factors").select("doc_id", "r.*", "factors")
