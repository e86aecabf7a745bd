"""Exact top-k inner products by multi-resolution segment statistics.

A vector is cut into segments; of each, mean and deviation are kept. By Cauchy-Schwarz

    |x - y|^2  >=  sum over segments of n * ((mean_x - mean_y)^2 + (dev_x - dev_y)^2),

and as 2<x, y> = |x|^2 + |y|^2 - |x - y|^2 and |x|^2 = sum of n * (mean^2 + dev^2), the same
bound from above on the inner product is sum of n * (mean_x * mean_y + dev_x * dev_y). It is
taken with few segments first and with more for the survivors; what is left is computed.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketry.llm.common import cut

#: Segments of a vector, coarse to fine.
LEVELS = (4, 16)
#: Candidates and queries that are compared at a time.
CELL_ROWS, CELL_QUERIES = 1024, 1024
#: Bytes of the queries that go to all tasks at a time.
BLOCK_BYTES = 1 << 26

RESULT = "quid long, query_id long, uid long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Not null, and every component a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(n) * mean and sqrt(n) * deviation of each segment, side by side."""
    width = vectors.shape[1]
    edges = np.unique(np.linspace(0, width, min(segments, width) + 1).astype(int))
    sizes = np.diff(edges)
    means = np.add.reduceat(vectors, edges[:-1], axis=1) / sizes
    squares = np.add.reduceat((vectors - np.repeat(means, sizes, axis=1)) ** 2, edges[:-1], axis=1)
    return np.hstack([means * np.sqrt(sizes), np.sqrt(squares)])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[-k]
        keep = np.flatnonzero(scores >= edge)
        return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class _Search:
    """Queries of one width and the best that each has met so far."""

    def __init__(self, uid: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.uid, self.ids, self.exact, self.k = uid, ids, vectors, k
        real = vectors.astype(float)
        self.wide = vectors.shape[1] > 0
        self.levels = [_statistics(real, n) for n in LEVELS] if self.wide else []
        self.norms = np.linalg.norm(real, axis=1)
        none = np.empty(0, np.int64)
        self.found = [(none, none, none)] * len(uid)  # score, id, uid
        self.floor = np.full(len(uid), -np.inf)

    def meet(self, uid: np.ndarray, ids: np.ndarray, exact: np.ndarray) -> None:
        k, real = self.k, exact.astype(float)
        levels = [_statistics(real, n) for n in LEVELS] if self.wide else []
        # The rounding of the bounds, far above what 64-bit floats lose.
        slack = 1e-9 * self.norms * np.linalg.norm(real, axis=1).max() + 1e-6
        for low in range(0, len(self.uid), CELL_QUERIES):
            some = range(low, min(low + CELL_QUERIES, len(self.uid)))
            coarse = self.levels[0][some.start : some.stop] @ levels[0].T if self.wide else None
            for i in some:
                own, least = uid != self.uid[i], self.floor[i]
                if self.wide:
                    bound = np.where(own, coarse[i - low] + slack[i], -np.inf)
                    if least == -np.inf and len(bound) > k:
                        # The k most promising give a score that survivors have to reach.
                        first = np.argpartition(bound, len(bound) - k)[-k:]
                        first = first[own[first]]
                        if len(first) == k:
                            least = float((exact[first] @ self.exact[i]).min())
                    left = np.flatnonzero(own & (bound >= least))
                    for q, c in zip(self.levels[1:], levels[1:]):
                        left = left[c[left] @ q[i] + slack[i] >= least]
                else:
                    left = np.flatnonzero(own)
                if not len(left):
                    continue
                scores = exact[left] @ self.exact[i]
                before = self.found[i]
                scores, new_ids, new_uid = (
                    np.concatenate(x) for x in zip(before, (scores, ids[left], uid[left]))
                )
                best = _best(scores, new_ids, k)
                self.found[i] = scores[best], new_ids[best], new_uid[best]
                if len(best) == k:
                    self.floor[i] = scores[best].min()

    def rows(self):
        for low in range(0, len(self.uid), CELL_QUERIES):
            part = self.found[low : low + CELL_QUERIES]
            sizes = [len(f[0]) for f in part]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(x[low : low + CELL_QUERIES], sizes).astype(np.int64)) for x in (self.uid, self.ids)
                ]
                + [pa.array(np.concatenate([f[j] for f in part]).astype(np.int64)) for j in (2, 1, 0)],
                ["quid", "query_id", "uid", "vec_id", "score"],
            )


def _scan(sent, k: int):
    def run(batches):
        searches = {w: _Search(*asked, k) for w, asked in sent.value.items()}
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths).tolist():
                if width not in searches:
                    continue
                part = batch.filter(pa.array(widths == width))
                uid, ids = (part.column(c).to_numpy() for c in ("uid", "id"))
                vectors = _matrix(part.column("vec"), width)
                for low in range(0, len(uid), CELL_ROWS):
                    cell = slice(low, low + CELL_ROWS)
                    searches[width].meet(uid[cell], ids[cell], vectors[cell])
        for search in searches.values():
            yield from search.rows()

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """The k best rows of ``vectors`` for each row that ``is_query`` holds for.

    Components count as floor(scale * x). Returns query_id, rank (from 1), vec_id, score: the
    highest inner products over all rows but the query's own, ties to the smaller id. A row
    whose id is null or whose vector is null or holds a null or a non-finite component takes no
    part. Vectors are compared with those of their own width; empty ones score 0. Repeated rows
    are rows of their own. Scores have to fit 64 bits. An empty table gives an empty result.

    Queries go to all tasks in blocks of ``BLOCK_BYTES``; candidates stay where they are read. A task
    compares segment statistics first, against the k-th best score that each query has met in it so
    far, and computes the survivors. What is shuffled is k rows at most for each query and task.
    """
    rows = (
        vectors.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vec"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        )
        .where(F.col("id").isNotNull() & usable(F.col("vec")))
        .withColumn("vec", F.transform("vec", lambda x: F.floor(x.cast("double") * scale)))
        .withColumn("width", F.size("vec"))
    )
    rows = cut(rows)  # what a row is called must not change from block to block
    asked = rows.where("asks").select("uid", "id", "vec", "width")
    size = asked.agg(F.coalesce(F.sum(F.lit(16) + 8 * F.col("width")), F.lit(0)).alias("bytes")).first().bytes
    # A block is half as large on average, so that the uneven spread of a hash stays within.
    blocks = 1 if size <= BLOCK_BYTES else -(-2 * size // BLOCK_BYTES)
    place = Window.partitionBy("quid").orderBy(F.desc("score"), "vec_id", "uid")
    context, results = rows.sparkSession.sparkContext, []
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("uid"), F.lit(blocks)) == block
        table = asked.where(mine).toArrow()  # a block, see above
        sent = context.broadcast(_by_width(table))
        found = rows.select("uid", "id", "vec", "width").mapInArrow(_scan(sent, k), RESULT)
        ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        results.append(cut(ranked.select("query_id", "rank", "vec_id", "score")))
        sent.unpersist()
    return reduce(DataFrame.unionByName, results)


def _by_width(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(uid, id, vectors) of the queries of each width."""
    table = table.combine_chunks()
    widths = table["width"].to_numpy()
    out = {}
    for width in np.unique(widths).tolist():
        part = table.filter(pa.array(widths == width)).combine_chunks()
        vectors = _matrix(part["vec"].combine_chunks(), width)
        out[width] = (part["uid"].to_numpy(), part["id"].to_numpy(), vectors)
    return out
