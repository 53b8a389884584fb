"""SimHash near-duplicates: fingerprints and their components, found exactly.

A fingerprint sums up the hashes of a text's word shingles: bit k is set if it
is set in over half of them. Texts are linked when their fingerprints differ in
at most ``radius`` bits, and the links' connected components are returned.

The comparison is exact and runs on distinct fingerprints only, so thousands of
exact copies cost one row. They are packed into *tiles* of at most about
``TILE`` fingerprints with equal bit counts in each of four 16-bit blocks. The
differences of the block counts of two tiles add up to a lower bound of the
distance of any two of their members, so only tile pairs within the radius are
joined (an equi-join on the neighbouring counts); all others are skipped. A
tile pair is compared in numpy with exclusive-or and bit counts, and hands on a
spanning forest of the links it finds: fewer rows than fingerprints, however
dense a group of near copies is, with the same components.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import cut

#: Fingerprints in a tile, on average at most.
TILE = 4096
BLOCKS, BLOCK_BITS = 4, 16
#: Bytes of a text that are split into words at a time.
CHUNK = 1 << 20
#: Numbers compared at a time: rows times columns of one exclusive-or.
CELLS = 1 << 20
_COLUMN = (np.arange(8) * 256).astype(np.int64)
#: Bit k (from the lowest) of each byte value.
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def _chunks(data: bytes) -> Iterator[bytes]:
    """Pieces of a text that end at white space, each of about CHUNK bytes."""
    at = 0
    while at < len(data):
        end = at + CHUNK
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[at:end]
        at = end


def _add(counts: np.ndarray, shingles: list[bytes], seed: int) -> int:
    """Add the shingles' hashes to the per-byte histogram (8 x 256, flat)."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), np.uint64, len(shingles))
    of_byte = hashes.view(np.uint8).reshape(-1, 8) + _COLUMN
    counts += np.bincount(of_byte.ravel(), minlength=2048)
    return len(shingles)


def fingerprint(text: str | None, shingle: int, seed: int) -> int:
    """SimHash of one text, unsigned. Words are separated by ASCII white space, A-Z
    lower-cased; a text of fewer words than a shingle has one shingle, a text
    without words the fingerprint 0."""
    counts, n, carry, total_words = np.zeros(2048, np.int64), 0, [], 0
    for piece in _chunks((text or "").encode("utf-8", "replace").lower()):
        words = carry + piece.split()
        if len(words) >= shingle:
            n += _add(counts, [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)], seed)
        carry = words[-(shingle - 1) :] if shingle > 1 else []
    if n == 0 and carry:
        n = _add(counts, [b" ".join(carry)], seed)
    if n == 0:
        return 0
    ones = counts.reshape(8, 256) @ _BITS  # byte, bit
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(documents: DataFrame, shingle: int, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, fp): the SimHash of every row's whole text as a signed bigint,
    and a plain hash of the text to know the row by."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(
            np.array([fingerprint(t if isinstance(t, str) else None, shingle, seed) for t in texts], np.uint64).view(np.int64)
        )

    simhash = F.pandas_udf(run, "long")
    return documents.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"), simhash(F.col(text_col)).alias("fp"))


def _block_counts(fp: Column) -> list[Column]:
    mask = (1 << BLOCK_BITS) - 1
    return [F.bit_count(F.shiftrightunsigned(fp, BLOCK_BITS * k).bitwiseAND(F.lit(mask))).cast("int") for k in range(BLOCKS)]


def _signature(counts: list[Column]) -> Column:
    out = F.lit(0)
    for c in counts:
        out = out * (BLOCK_BITS + 1) + c
    return out


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Differences of block counts within the radius, one of each pair +d, -d."""
    every = itertools.product(range(-radius, radius + 1), repeat=BLOCKS)
    near = [d for d in every if sum(map(abs, d)) <= radius]
    return [d for d in near if d >= tuple(-x for x in d)]


def tile_links(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """Links that span the components of the fingerprints of two tiles (or of one
    with itself) under distance <= radius: at most one per merge."""
    label = np.arange(len(a) if same else len(a) + len(b))
    shift, out = 0 if same else len(a), []
    step = max(1, CELLS // len(b))
    for at in range(0, len(a), step):
        near = np.bitwise_count(a[at : at + step, None] ^ b[None, :]) <= radius
        if same:
            near[np.arange(len(near)), np.arange(at, at + len(near))] = False
        for i in np.flatnonzero(near.any(axis=1)):
            js = np.flatnonzero(near[i]) + shift
            roots, first = np.unique(label[js], return_index=True)
            fresh = roots != label[at + i]
            if fresh.any():
                out += [(int(a[at + i]), int(b[js[k] - shift])) for k in first[fresh]]
                merged = np.append(roots, label[at + i])
                label[np.isin(label, merged)] = merged.min()
    return out


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """(u, v): links between distinct fingerprints (column fp) that span every
    component of the graph 'distance <= radius'."""
    keyed = distinct.select("fp", *[c.alias(f"c{k}") for k, c in enumerate(_block_counts(F.col("fp")))])
    keyed = keyed.withColumn("sig", _signature([F.col(f"c{k}") for k in range(BLOCKS)]))
    # At most 17^4 = 83,521 signatures, whatever the input: a proven bound.
    sizes = keyed.groupBy("sig").agg(F.ceil(F.count("*") / TILE).cast("int").alias("n_tiles"))
    tiled = keyed.join(F.broadcast(sizes), "sig").withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("n_tiles")).cast("int"))
    counts = [f"c{k}" for k in range(BLOCKS)]
    tiles = cut(tiled.groupBy("sig", "tile", *counts).agg(F.sort_array(F.collect_list("fp")).alias("fps")), "simhash-tiles")
    moved = F.array(*[F.struct(*[F.lit(x).alias(f"d{k}") for k, x in enumerate(d)]) for d in _offsets(radius)])
    left = tiles.select("tile", "fps", *counts, F.explode(moved).alias("d"))
    to = [F.col(f"c{k}") + F.col(f"d.d{k}") for k in range(BLOCKS)]
    inside = [(t >= 0) & (t <= BLOCK_BITS) for t in to]
    left = left.where(inside[0] & inside[1] & inside[2] & inside[3]).select(
        _signature(to).alias("sig"),
        F.col("tile").alias("tile_a"),
        F.col("fps").alias("a"),
        F.greatest(*[F.abs(F.col(f"d.d{k}")) for k in range(BLOCKS)]).eqNullSafe(0).alias("same_sig"),
    )
    pairs = left.join(tiles.select("sig", F.col("tile").alias("tile_b"), F.col("fps").alias("b")), "sig").where(
        ~F.col("same_sig") | (F.col("tile_a") <= F.col("tile_b"))
    )
    work = pairs.select("a", "b", (F.col("same_sig") & (F.col("tile_a") == F.col("tile_b"))).alias("same"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            a, b, same = batch.column(0), batch.column(1), batch.column(2)
            for i in range(batch.num_rows):
                x = a[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                y = b[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                found += tile_links(x, y, same[i].as_py(), radius)
            ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.record_batch([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["u", "v"])

    return work.mapInArrow(compare, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component of every node that has a
    link; alternating large-star and small-star rounds, each of them aggregates
    and joins, until the stars no longer change."""
    found = cut(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    state = None
    while True:
        both = found.unionByName(found.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written first: the join then deals out both sides itself and can split a hub.
        low = cut(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "star-low")
        large = cut(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "star-large")
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")), "star-low")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        found = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "star-small")
        now = found.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return found.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def _rooted(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, first_id, root): every distinct fingerprint with its smallest doc_id
    and the smallest fingerprint of its component."""
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(links(distinct, radius))
    joined = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    return cut(joined.select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")


def near_duplicates(
    documents: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, fp (bigint), component_id.

    ``component_id`` is the smallest doc_id of the documents reachable over links
    of at most ``radius`` differing bits, the document's own included. Null,
    empty and blank texts have fingerprint 0 and are linked like any other. Rows
    that repeat stay; a null id is never the smallest, so a component of null
    ids only has component_id null. Other columns are passed over.
    """
    fps = cut(fingerprints(documents, shingle, seed, id_col, text_col), "fingerprints")
    rooted = _rooted(fps, radius)
    smallest = cut(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "component-ids")
    named = cut(rooted.join(smallest, "root").select("fp", "component_id"), "named-fingerprints")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def representatives(
    documents: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents, all their columns, with one row of each component: the one
    of the smallest doc_id (null ids last), then of the smallest fingerprint and
    text hash; of equal rows one stays. Null and empty texts have fingerprint 0 and
    are one group; an empty table gives an empty one; columns of any name pass
    through untouched."""
    fps = cut(fingerprints(documents, shingle, seed, id_col, text_col), "fingerprints")
    rooted = _rooted(fps, radius)
    # Per fingerprint first: an exact copy held by a third of all rows is reduced where it is read.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "h")).alias("k")
    per_fp = cut(fps.groupBy("fp").agg(least).select("fp", "k"), "first-of-fingerprint")
    chosen = per_fp.join(rooted.select("fp", "root"), "fp").groupBy("root").agg(F.min("k").alias("k"))
    keepers = cut(chosen.select(F.col("k.doc_id").alias("kid"), F.col("k.h").alias("kh")), "keepers")
    # The row's columns travel in one struct, where no name can clash with those used here.
    rows = documents.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))
    kept = rows.join(keepers, F.col("id").eqNullSafe(F.col("kid")) & (F.col("h") == F.col("kh")), "left_semi")
    return kept.dropDuplicates(["id", "h"]).select("row.*")


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hex digits of a fingerprint."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
