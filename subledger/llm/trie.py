"""Prefix trie of conversations: a z-fast trie in tables.

A conversation is its sequence of turns. Turn by turn it is reduced to a path of
128-bit prefix fingerprints (an exclusive-or of hashes of (depth, role, text), so a
prefix of any depth is known by its fingerprint alone); texts are read once and not
shuffled. Equal paths become one sequence.

Sequences are inserted in batches. A pending sequence hangs below a known place: a
sequence already in the trie (its owner) and a depth on it. A batch takes one
sequence, chosen by hash, of every child that some pending sequence needs: no two
members of a batch meet on a new edge, so all are inserted at once, each as one
compacted node whose edge reaches from its place to its end. The node is hashed
under its handle: the prefix whose depth is the two-fattest number of the edge, and
under the first turn of the edge. Every other pending sequence locates its exit node
by fat binary search between its place and its own end: the depths that the search
probes while it misses are known beforehand, so one join with the batch's handles
answers a whole run, and the deepest hit names the exit node and a depth that is
shared for sure; what lies behind it on that edge is compared. The sequence then
waits at the exit place for the next batch, or is done if it ends there. The members
of a batch are chosen by hash, so what waits behind one shrinks by halves on
average, however the conversations are skewed.

``nodes`` expands the edges: batch by batch from the last to the first every
inserted sequence turns its edge into one row a depth, with the sums that its own
end and all that hangs on it bring, and hands its totals to its owner's place.

Bounds. A row holds one sequence: 20 bytes a turn. Whatever many conversations share
(a first turn, a whole path, the root) is aggregated before it is shuffled; joins on
shared handles are plain joins whose large side the planner can split. The ids of
equal conversations are packed into texts of at most ``PACK`` ids before they meet,
and are hashed as a stream.

Defined results: null role or text counts as empty; a row without conv_id belongs to
no conversation; turns of equal number (or null, first) are ordered by fingerprint,
so repeated rows stay as repeated turns; an empty table has no node, not even a
root; other columns are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import cut

#: Conversation ids packed into one text: those of one range of so many integers.
PACK = 4096
#: Bytes of a fingerprint.
WIDTH = 16

NODE_SCHEMA = (
    "x long, top boolean, owner long, place int, depth int, conv_id long, parent_conv_id long, n_convs long,"
    " n_children long, n_leaves long, saved_tokens long, ends binary"
)


# ------------------------------------------------------------------ rebuilding


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): every conversation's turns in order, as fingerprints and
    code points; the texts end here."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        F.col("turn"), F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"), F.char_length(text).alias("n")
    )
    return conversations.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def shared_openings(turns: DataFrame, block: int, most: int) -> DataFrame:
    """Every conversation c with its first h turns replaced by those of conversation
    c - c % ``block``, h = crc32(decimal c) % (``most`` + 1)."""
    c = F.col("conv_id")
    head = (F.crc32(c.cast("string").cast("binary")) % (most + 1)).cast("int")
    donors = turns.where(c % block == 0).select(c.alias("donor"), F.slice("turns", 1, most).alias("opening"))
    own = turns.select(c, (c - c % block).alias("donor"), head.alias("h"), "turns")
    opening = F.coalesce(F.slice("opening", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(donors, "donor", "left").select("conv_id", F.concat(opening, rest).alias("turns"))


# ------------------------------------------------------------------- sequences


def _mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_path(a: np.ndarray, b: np.ndarray) -> bytes:
    """Fingerprints of all prefixes of a sequence of turn hashes, end to end."""
    depth = _mix(np.arange(1, len(a) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.empty((len(a), 2), np.uint64)
    out[:, 0] = np.bitwise_xor.accumulate(_mix(a.astype(np.int64).view(np.uint64) ^ depth))
    out[:, 1] = np.bitwise_xor.accumulate(_mix(b.astype(np.int64).view(np.uint64) + depth))
    return out.tobytes()


def _paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path, chars) with the turns as bytes: 16 and 4 a turn."""

    @F.pandas_udf("path binary, chars binary")
    def path(a: pd.Series, b: pd.Series, n: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            {"path": [prefix_path(x, y) for x, y in zip(a, b, strict=True)], "chars": [np.asarray(x, "<u4").tobytes() for x in n]}
        )

    made = turns.select("conv_id", path("turns.a", "turns.b", "turns.n").alias("p"))
    return made.select("conv_id", "p.path", "p.chars")


def sequences(turns: DataFrame) -> DataFrame:
    """Distinct sequences: (x, members, ends, path, chars). x is the smallest id of
    the conversations that are equal to it, ``ends`` the SHA-256 of their ids,
    ascending and comma-joined."""
    paths = _paths(turns).withColumns({"last": F.substring("path", -WIDTH, WIDTH), "pack": F.floor(F.col("conv_id") / PACK)})
    # Ids are distinct integers, so a pack holds PACK of them at most.
    packs = paths.groupBy("last", "pack").agg(
        F.min("conv_id").alias("x"),
        F.count(F.lit(1)).alias("members"),
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string"))).alias("ids"),
        F.first("path").alias("path"),
        F.first("chars").alias("chars"),
    )

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Packs in order of (last, pack): one hash runs over a sequence's packs."""
        last, held, digest = None, None, None
        for frame in frames:
            done = []
            for row in frame.itertuples(index=False):
                if held is None or row.last != last:
                    if held is not None:
                        done.append((*held[:2], digest.digest(), *held[2:]))
                    last, held, digest = row.last, [row.x, row.members, row.path, row.chars], hashlib.sha256(row.ids.encode())
                else:
                    held[1] += row.members
                    digest.update(b"," + row.ids.encode())
            yield _sequence_frame(done)
        if held is not None:
            yield _sequence_frame([(*held[:2], digest.digest(), *held[2:])])

    ordered = packs.repartition("last").sortWithinPartitions("last", "pack")
    return ordered.mapInPandas(stream, "x long, members long, ends binary, path binary, chars binary")


def _sequence_frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["x", "members", "ends", "path", "chars"]).astype({"x": "int64", "members": "int64"})


# ------------------------------------------------------------------- insertion


def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] that most powers of two divide (a < b)."""
    return b >> (n := (a ^ b).bit_length() - 1) << n


def miss_run(a: int, b: int) -> list[int]:
    """The depths that a fat binary search of (a, b] probes while it misses; the
    last one is a + 1."""
    run = []
    while b > a:
        run.append(two_fattest(a, b))
        b = run[-1] - 1
    return run


def _at(path: str, depth: Column) -> Column:
    """Fingerprint of a path's prefix of that depth."""
    return F.substring(F.col(path), ((depth - 1) * WIDTH + 1).cast("int"), F.lit(WIDTH))


def _probes(path: pd.Series, place: pd.Series) -> pd.Series:
    return pd.Series(
        [[{"depth": d, "print": p[(d - 1) * WIDTH : d * WIDTH]} for d in miss_run(int(a), len(p) // WIDTH)] for p, a in zip(path, place, strict=True)]
    )


def _handle_depth(place: pd.Series, length: pd.Series) -> pd.Series:
    return pd.Series([two_fattest(int(a), int(b)) for a, b in zip(place, length, strict=True)], dtype="int32")


def _shared(path: pd.Series, other: pd.Series, known: pd.Series) -> pd.Series:
    """Length of the common prefix of two paths, known to be ``known`` at least."""

    def one(p: bytes, q: bytes, k: int) -> int:
        n = min(len(p), len(q)) // WIDTH
        u, v = (np.frombuffer(x, np.uint64, (n - k) * 2, k * WIDTH).reshape(-1, 2) for x in (p, q))
        differ = np.flatnonzero((u != v).any(axis=1))
        return k + int(differ[0]) if len(differ) else n

    return pd.Series([one(p, q, int(k)) for p, q, k in zip(path, other, known, strict=True)], dtype="int32")


def handles(batch: DataFrame) -> DataFrame:
    """The hash table of a batch's compacted nodes: (print, depth, node), under the
    handle and under the first turn of the edge."""
    length = (F.octet_length("path") / WIDTH).cast("int")
    handle = F.pandas_udf(_handle_depth, "int")
    depths = F.array_distinct(F.array(handle("place", length), F.col("place") + 1))
    rows = batch.select(F.col("x").alias("node"), "path", F.explode(depths).alias("depth"))
    return rows.select("node", "depth", _at("path", F.col("depth")).alias("print"))


def locate(pending: DataFrame, batch: DataFrame) -> DataFrame:
    """Exit place of every pending sequence that is no member of ``batch`` itself:
    pending's columns with the new ``owner`` and ``place``."""
    probed = F.pandas_udf(_probes, "array<struct<depth: int, print: binary>>")
    shared = F.pandas_udf(_shared, "int")
    probes = pending.select("x", F.explode(probed("path", "place")).alias("p")).select("x", "p.depth", "p.print")
    exits = (
        probes.join(handles(batch), ["print", "depth"])
        .groupBy("x")
        .agg(F.max(F.struct("depth", "node")).alias("hit"))
        .select("x", F.col("hit.node").alias("node"), F.col("hit.depth").alias("known"))
        .where("x <> node")
    )
    labels = batch.select(F.col("x").alias("node"), F.col("path").alias("label"))
    kept = [c for c in pending.columns if c not in ("owner", "place")]
    return (
        pending.select(*kept)
        .join(exits, "x")
        .join(labels, "node")
        .select(*kept, F.col("node").alias("owner"), shared("path", "label", "known").alias("place"))
    )


def insert_all(found: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Insert all sequences; per batch its members and, per batch, the sequences
    that end at a place of its members' edges (those of the root first)."""
    length = (F.octet_length("path") / WIDTH).cast("int")
    waiting = found.withColumns({"owner": F.lit(None).cast("long"), "place": F.lit(0)})
    batches, ended = [], []
    while True:
        here = cut(waiting, "trie-waiting")
        ended.append(here.where(length == F.col("place")))
        pending = here.where(length > F.col("place"))
        if pending.isEmpty():
            return batches, ended
        whole = F.struct(*pending.columns)
        one = pending.groupBy(_at("path", F.col("place") + 1)).agg(F.min_by(whole, F.struct(F.xxhash64("x", F.lit(len(batches))), "x")).alias("m"))
        batches.append(cut(one.select("m.*"), "trie-batch"))
        waiting = locate(pending, batches[-1])


# ------------------------------------------------------------------- expansion


def _expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for every depth of a batch member's edge, from its end upwards."""
    for frame in frames:
        rows = []
        for r in frame.itertuples(index=False):
            chars = np.frombuffer(r.chars, "<u4")
            hung = {h["place"]: h for h in r.hung} if r.hung is not None else {}
            convs, least, leaves, saved, edge = int(r.members), int(r.x), 0, 0, []
            for depth in range(len(chars), r.place, -1):
                h, ends = hung.get(depth), r.ends if depth == len(chars) else None
                children = 0 if depth == len(chars) else 1
                if h is not None:
                    convs, least = convs + h["convs"], min(least, h["least"])
                    leaves, saved, children = leaves + h["leaves"], saved + h["saved"], children + h["children"]
                    ends = h["ends"] if h["ends"] is not None else ends
                leaves += children == 0
                saved += (convs - 1) * int(chars[depth - 1])
                edge.append([r.x, False, r.owner, r.place, depth, least, None, convs, children, leaves, saved, ends])
            for below, above in zip(edge, edge[1:], strict=False):
                below[6] = above[5]
            edge[-1][1] = True
            rows += edge
        out = pd.DataFrame(rows, columns=[field.split()[0] for field in NODE_SCHEMA.split(", ")], dtype=object)
        whole = {c: "Int64" for c in ("owner", "parent_conv_id")}
        sure = {c: "int64" for c in ("x", "place", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")}
        yield out.astype({**whole, **sure, "top": bool})


def _brought(made: DataFrame | None, ended: DataFrame) -> DataFrame:
    """What hangs at (owner, place): the tops of the next batch's edges and the
    sequences that end there."""
    ends = ended.select(
        "owner", "place", F.col("members").alias("convs"), F.col("x").alias("least"), *[F.lit(0).cast("long").alias(c) for c in ("leaves", "saved", "children")], "ends"
    )
    if made is not None:
        tops = made.where("top").select(
            "owner",
            "place",
            F.col("n_convs").alias("convs"),
            F.col("conv_id").alias("least"),
            F.col("n_leaves").alias("leaves"),
            F.col("saved_tokens").alias("saved"),
            F.lit(1).cast("long").alias("children"),
            F.lit(None).cast("binary").alias("ends"),
        )
        ends = ends.unionByName(tops)
    sums = [F.sum(c).alias(c) for c in ("convs", "leaves", "saved", "children")]
    return ends.groupBy("owner", "place").agg(F.min("least").alias("least"), F.max("ends").alias("ends"), *sums)


def nodes(turns: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of (conv_id, turns): conv_id (smallest
    member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves,
    saved_tokens, ends (SHA-256 of the ids that end here, null if none does)."""
    batches, ended = insert_all(cut(sequences(turns), "trie-sequences"))
    made: list[DataFrame] = []
    for batch, ends in zip(reversed(batches), reversed(ended[1:]), strict=True):
        hung = _brought(made[-1] if made else None, ends).groupBy("owner").agg(
            F.collect_list(F.struct("place", "convs", "least", "leaves", "saved", "children", "ends")).alias("hung")
        )
        joined = batch.join(hung.withColumnRenamed("owner", "x"), "x", "left")
        made.append(cut(joined.select("x", "owner", "place", "members", "ends", "chars", "hung").mapInPandas(_expand, NODE_SCHEMA), "trie-nodes"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    leaf = (F.col("children") == 0).cast("long")
    root = _brought(made[-1] if made else None, ended[0]).select(
        F.col("least").alias("conv_id"),
        F.lit(0).alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.col("convs").alias("n_convs"),
        F.col("children").alias("n_children"),
        (F.col("leaves") + leaf).alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        "ends",
    )
    out = root
    for i, level in enumerate(made):
        tops = level.where("top").drop("parent_conv_id")
        if i + 1 < len(made):
            above = made[i + 1].select(F.col("x").alias("owner"), F.col("depth").alias("place"), F.col("conv_id").alias("parent_conv_id"))
            tops = tops.join(above, ["owner", "place"])
        else:
            tops = tops.withColumn("parent_conv_id", root.select("conv_id").scalar())
        out = out.unionByName(level.where("not top").select(*columns)).unionByName(tops.select(*columns))
    return out


def conversation_trie(conversations: DataFrame, block: int = 100, most: int = 5) -> DataFrame:
    """``nodes`` of the conversations whose openings are shared by blocks of ids."""
    return nodes(shared_openings(conversation_turns(conversations), block, most))
