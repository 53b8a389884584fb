"""Exact top-k inner products by no-random-access aggregation.

The query set meets all rows in blocks: queries are dealt into ``n_q`` groups,
candidates into ``n_c``, and every pair of groups is one cell of a grid (each
row goes to one row or column of cells, so nothing is paired row by row). Both
numbers follow from the counts, a cell holds about QUERY_BLOCK queries and
CANDIDATE_BLOCK candidates at any input size.

Within a cell the candidates are lists, one per dimension, sorted by component:
from the top for a positive query weight, from the bottom for a negative one.
The lists are read in step, to growing depths. A candidate's score lies between
what was read of it plus the end of each list not yet read at it, and the same
plus the last value read there. A candidate whose upper bound is below the k-th
largest lower bound cannot qualify; reading stops for a query once few enough
are left, and their scores are resolved exactly. Numpy does all queries of a
block at a time: what was read is a masked matrix.

The best k of every cell meet in one ranking per query.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.llm.common import cut

QUERY_BLOCK, CANDIDATE_BLOCK = 4096, 2048
#: Queries whose bounds are held at a time.
STEP = 256
#: Shares of the lists that are read before the bounds are compared.
DEPTHS = (0.3, 0.6)
#: Share of a cell's candidates below which a query's survivors are resolved one
#: by one instead of reading on.
FEW = 0.05


def _read(c: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For lists sorted from the top: (mask of what the first ``depth`` entries of
    every list hold, last value read in each list)."""
    order = np.argsort(-c, axis=0, kind="stable")[:depth]
    mask = np.zeros(c.shape, bool)
    np.put_along_axis(mask, order, True, axis=0)
    return mask, np.take_along_axis(c, order[-1:], axis=0)[0]


class Lists:
    """The sorted lists of a cell's candidates, prepared at every depth."""

    def __init__(self, c: np.ndarray):
        self.c, self.low, self.high, self.rounds = c, c.min(axis=0), c.max(axis=0), []
        for share in DEPTHS:
            depth = max(1, int(len(c) * share))
            top, last_top = _read(c, depth)
            bottom, last_bottom = _read(-c, depth)
            self.rounds.append((c * top, ~top, last_top, c * bottom, ~bottom, -last_bottom))

    def bounds(self, q: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bounds of the scores of queries ``q`` after round ``i``."""
        top, not_top, last_top, bottom, not_bottom, last_bottom = self.rounds[i]
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        seen = up @ top.T + down @ bottom.T
        a, b = not_top.T.astype(q.dtype), not_bottom.T.astype(q.dtype)
        lower = seen + (up * self.low) @ a + (down * self.high) @ b
        upper = seen + (up * last_top) @ a + (down * last_bottom) @ b
        return lower, upper


def top_of_block(queries: np.ndarray, own: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query index, vec_id, score) of the k best candidates of each query, ties to
    the smaller vec_id. ``own[i]`` is the vec_id that query i leaves out."""
    size = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(1, queries.shape[1])
    if size >= 2.0**52:  # beyond what doubles hold exactly: plain integers, held within a long at the end
        most = 2**63 - 1
        exact = [
            [max(-most, min(most, sum(int(x) * int(y) for x, y in zip(q, c, strict=True)))) for c in candidates] for q in queries
        ]
        return [
            (i, v, s)
            for i, row in enumerate(exact)
            for s, v in sorted(((s, int(v)) for s, v in zip(row, ids, strict=True) if v != own[i]), key=lambda x: (-x[0], x[1]))[:k]
        ]
    kind = np.float32 if size < 2.0**23 else np.float64
    c, lists = candidates.astype(kind), Lists(candidates.astype(kind))
    out: list[tuple[int, int, int]] = []
    for at in range(0, len(queries), STEP):
        q = queries[at : at + STEP].astype(kind)
        alive = ids[None, :] != own[at : at + STEP, None]
        open_, few = np.ones(len(q), bool), max(k, int(FEW * len(c)))
        for i in range(len(DEPTHS)):
            rows = np.flatnonzero(open_)
            if not len(rows):
                break
            lower, upper = lists.bounds(q[rows], i)
            lower[~alive[rows]] = -np.inf
            if lower.shape[1] > k:
                least = np.partition(lower, -k, axis=1)[:, -k]
                alive[rows] &= upper >= least[:, None]
            open_[rows] = alive[rows].sum(axis=1) > few
        rest = np.flatnonzero(open_)
        scores = dict(zip(rest.tolist(), q[rest] @ c.T, strict=True)) if len(rest) else {}
        for i in range(len(q)):
            left = np.flatnonzero(alive[i])
            score = scores[i][left] if i in scores else c[left] @ q[i]
            if len(left) > 4 * k:  # keep every tie of the k-th score
                keep = score >= np.partition(score, -k)[-k]
                left, score = left[keep], score[keep]
            best = np.lexsort((ids[left], -score))[:k]
            out += [(at + i, int(ids[left[j]]), int(score[j])) for j in best]
    return out


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double, as array<bigint>."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def top_k(
    vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner
    products over all other rows, ties to the smaller vec_id.

    Rows with a null id, and vectors that are null, empty, or hold null or
    non-finite components, take no part; vectors meet only those of their own
    length. A query's own row is any with its vec_id; a repeated query row is
    answered as often, a repeated candidate may rank as often. Quantised components
    and scores beyond a long take the largest (smallest) one. Other columns are
    passed over.
    """
    usable = vectors.where(F.col(id_col).isNotNull() & _usable(F.col(vector_col)))
    rows = cut(
        usable.select(
            F.col(id_col).cast("long").alias("vec_id"),
            quantised(F.col(vector_col), scale).alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "quantised",
    )
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    n_c, n_q = max(1, -(-sizes["n"] // CANDIDATE_BLOCK)), max(1, -(-sizes["q"] // QUERY_BLOCK))

    def cells(n: int, other: int, own: str, far: str) -> Sequence[Column]:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(far)

    dim = F.size("v").alias("dim")
    asked = rows.where("asks").select("vec_id", "row", "v", dim, *cells(n_q, n_c, "gq", "gc"))
    offered = rows.select("vec_id", "v", dim, *cells(n_c, n_q, "gc", "gq"))
    key = ["dim", "gq", "gc"]

    def cell(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        if len(qs) == 0 or len(cs) == 0:
            return pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
        own, number = qs["vec_id"].to_numpy(), qs["row"].to_numpy()
        found = top_of_block(np.stack(qs["v"].to_numpy()), own, np.stack(cs["v"].to_numpy()), cs["vec_id"].to_numpy(), k)
        best = pd.DataFrame(found, columns=["i", "vec_id", "score"], dtype="int64")
        return best.assign(row=number[best["i"]], query_id=own[best["i"]])[["row", "query_id", "vec_id", "score"]]

    found = (
        asked.groupBy(*key).cogroup(offered.groupBy(*key)).applyInPandas(cell, "row long, query_id long, vec_id long, score long")
    )
    ranked = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
