"""Nearest neighbours by query-aware collision counting.

Vectors are projected on m random lines, each line's values kept as a sorted array.  A query's projections are the
centres of windows on these arrays, which widen by a constant factor from round to round (virtual rehashing: no
array is built anew).  A vector that lies within the windows of a share ``alpha`` of the lines collides often enough to
be verified by its exact inner product.

On one line two vectors at distance D differ by a normal number of deviation D.  Windows of half width
``reach`` * R hold a vector at distance R with probability 0.84 (reach 1.4) a line, well over alpha = 0.75, and the search
ends when the k-th best verified vector is no farther than R: what is nearer has collided often enough with high probability.

Largest inner products become smallest distances by one more coordinate: vectors are lifted to the length of the longest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcast.llm.common import stored
from fieldcast.session import send_with_tasks

send_with_tasks(__name__)

HITS = "query_row long, query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Not null, not empty, all components there and finite, and not all of them zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


class SortedLines:
    """The sorted projections of one block of vectors."""

    def __init__(self, vectors: np.ndarray, longest: float, lines: int, seed: int) -> None:
        self.vectors, self.longest = vectors, longest
        lift = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(1), 0.0))
        self.directions = np.random.default_rng(seed).standard_normal((vectors.shape[1] + 1, lines))
        spots = vectors @ self.directions[:-1] + lift[:, None] * self.directions[-1]
        self.order = np.argsort(spots, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(spots.T, self.order, axis=1)

    def search(self, queries: np.ndarray, k: int, alpha: float, reach: float, growth: float):
        """For each query the places of its verified vectors and their inner products; at least the k nearest, very likely."""
        n, lines = len(self.vectors), len(self.order)
        scale = self.longest / np.linalg.norm(queries, axis=1)
        centres = (queries * scale[:, None]) @ self.directions[:-1]
        need = int(np.ceil(alpha * lines))
        width = 2.0 * self.longest * reach
        widths = [width]
        while widths[-1] > 0.1 * width:
            widths.append(widths[-1] / growth)
        widths = widths[::-1]
        bounds = [self._bounds(centres, w) for w in widths]
        for q in range(len(queries)):
            count, product = np.zeros(n, np.int64), np.full(n, -np.inf)
            left = right = centre = (bounds[0][0][q] + bounds[0][1][q]) // 2
            for w, (low, high) in zip(widths, bounds, strict=True):
                now_left, now_right = np.minimum(low[q], centre), np.maximum(high[q], centre)
                fresh = (left - now_left).sum() + (now_right - right).sum()
                outside = lines * n - (now_right - now_left).sum()
                if fresh <= outside:
                    count += self._times(now_left, left, right, now_right)
                else:  # windows are wide: what lies outside is less
                    count = lines - self._times(np.zeros_like(now_left), now_left, now_right, np.full_like(now_left, n))
                left, right = now_left, now_right
                often = count >= need
                new = np.nonzero(often & (product == -np.inf))[0]
                product[new] = self.vectors[new] @ queries[q]
                verified = np.nonzero(often)[0]
                if len(verified) >= min(k, n):
                    got = product[verified]
                    kth = np.partition(got, len(got) - k)[len(got) - k] if len(got) > k else got.min()
                    # squared distance of the lifted vectors
                    distance = np.sqrt(max(0.0, 2 * self.longest**2 - 2 * kth * scale[q]))
                    if distance <= w / reach or len(verified) == n:
                        break
            else:
                # the widest windows hold every vector that can be at any distance; what is left collides rarely
                verified = np.arange(n) if len(verified) < min(k, n) else verified
                got = self.vectors[verified] @ queries[q]
            yield verified, got

    def _times(self, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
        """How often each vector lies at places a to b or c to d of the lines."""
        spans = ((self.order[j], *at) for j, at in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True)))
        parts = [x for line, a_, b_, c_, d_ in spans for x in (line[a_:b_], line[c_:d_]) if len(x)]
        n = len(self.vectors)
        return np.bincount(np.concatenate(parts), minlength=n) if parts else np.zeros(n, np.int64)

    def _bounds(self, centres: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
        low = [np.searchsorted(s, c - width, "left") for s, c in zip(self.sorted, centres.T, strict=True)]
        high = [np.searchsorted(s, c + width, "right") for s, c in zip(self.sorted, centres.T, strict=True)]
        return np.array(low).T, np.array(high).T


def nearest(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    lines: int = 48,
    alpha: float = 0.75,
    reach: float = 1.4,
    growth: float = 1.3,
    vector_block: int = 8192,
    query_block: int = 2048,
    seed: int = 42,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query with the other rows.

    Queries are the rows where ``is_query`` holds; every row is indexed.  Rows with the query's own id are not its
    candidates.  Ties go to the smaller id.  Scores are in double precision on the vectors as given.  Rows that are not
    :func:`usable`, or without id, take no part; a query meets vectors of its own number of components only.  A
    query has fewer than ``k`` rows if there are fewer candidates.  Of repeated rows each is a candidate, and a query
    of its own.  Other columns are left out; an empty table gives no rows.

    Vectors are dealt at random into blocks of about ``vector_block``, queries of about ``query_block``; each pair of blocks is
    one task's group, so a task holds one of each whatever the input.  Blocks' best ``k`` meet by query.
    """
    ready = vectors.where(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.size(vector).alias("size"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.monotonically_increasing_id().alias("row"),
    )
    table = stored(ready, "neighbours-vectors")
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    sums = stored(
        table.groupBy("size").agg(
            F.count("*").alias("n"), F.sum(F.col("asks").cast("long")).alias("queries"), F.sqrt(F.max(squares)).alias("longest")
        ),
        "neighbours-sizes",
    ).withColumnRenamed("size", "of size")
    sized = table.join(sums, table["size"] == F.col("of size"))
    blocks = F.ceil(F.col("n") / vector_block).cast("int")
    query_blocks = F.ceil(F.greatest(F.col("queries"), F.lit(1)) / query_block).cast("int")
    deal = F.xxhash64("row")
    columns = ("size", "vec_id", "row", "vector", "longest")
    kept = sized.where("queries > 0").select(
        *columns, F.pmod(deal, blocks).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), query_blocks - 1)).alias("query_block")
    )
    asked = sized.where("asks").select(
        *columns, F.pmod(deal, query_blocks).cast("int").alias("query_block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block")
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []}).astype(
                {"query_row": "int64", "query_id": "int64", "vec_id": "int64", "score": "float64"}
            )
        ids = left["vec_id"].to_numpy()
        index = SortedLines(np.stack(left["vector"].to_list()), float(left["longest"].iloc[0]) or 1.0, lines, seed)
        rows, names = right["row"].to_numpy(), right["vec_id"].to_numpy()
        out: list[tuple[np.ndarray, ...]] = []
        step = 256
        asked_ = np.stack(right["vector"].to_list())
        for at in range(0, len(asked_), step):
            # one more than k, so that the query's own row never takes a place
            for i, (found, scores) in enumerate(index.search(asked_[at : at + step], k + 1, alpha, reach, growth), at):
                other = ids[found] != names[i]
                found, scores = ids[found[other]], scores[other]
                best = np.lexsort((found, -scores))[:k]
                out.append((np.full(len(best), rows[i]), np.full(len(best), names[i]), found[best], scores[best]))
        made = [np.concatenate(column) for column in zip(*out, strict=True)]
        return pd.DataFrame(dict(zip(("query_row", "query_id", "vec_id", "score"), made, strict=True)))

    key = ("size", "block", "query_block")
    asked = asked.select(*(F.col(c).alias(c) for c in asked.columns))  # columns of its own, for the cogroup
    hits = kept.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(search, HITS)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
