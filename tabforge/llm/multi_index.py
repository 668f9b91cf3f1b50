"""Nearest neighbours with an inverted multi-index.

Each half of a vector is quantised by its own codebook, fitted on a bounded
sample; a pair of centroids is a cell, and every vector is indexed in its cell.  A
query walks the cells by the summed distance of its halves to the two centroids,
with a heap over the two sorted lists, until the cells seen hold ``share`` of all
vectors.  Cells are stored in blocks of bounded size; the probes of all queries
meet the blocks in one exchange, where exact distances leave at most k rows of
each (query, block); the k best of those are the answer.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import column, groups, materialize, small_batches

BLOCK = 256          # vectors of a cell that are compared in one go


def kmeans(x: np.ndarray, k: int, rounds: int = 15, seed: int = 3) -> np.ndarray:
    """Lloyd's algorithm from distinct random rows; at most ``k`` centroids."""
    rng = np.random.default_rng(seed)
    points = np.unique(x, axis=0)
    c = points[rng.permutation(len(points))[:k]].astype(np.float64)
    for _ in range(rounds):
        near = nearest(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(c))
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows of ``x`` to rows of ``c``."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(x[i:i + 4096], c).argmin(1) for i in range(0, len(x), 4096)])


def walk(d1: np.ndarray, d2: np.ndarray, sizes: np.ndarray, enough: float) -> list[int]:
    """Cells in ascending d1[i] + d2[j] until they hold ``enough`` vectors (multi-sequence traversal)."""
    o1, o2 = d1.argsort(kind="stable"), d2.argsort(kind="stable")
    heap, seen, out, got = [(d1[o1[0]] + d2[o2[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and got < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(o1[i]) * len(d2) + int(o2[j])
        if sizes[cell]:
            out.append(cell)
            got += int(sizes[cell])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(o1) and b < len(o2) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (d1[o1[a]] + d2[o2[b]], a, b))
    return out


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    vectors = column(batch, "v")
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.float64)


def _fitter(k: int):
    def run(batches):
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        x = np.concatenate([_matrix(b) for b in tables])
        x = x[np.lexsort(x.T)]                             # the order does not hang on the partitions
        half = x.shape[1] // 2
        out = io.BytesIO()
        np.savez(out, a=kmeans(x[:, :half], k), b=kmeans(x[:, half:], k))
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["books"])
    return run


def _assigner(books):
    def run(batches):
        a, b = books.value
        for batch in small_batches(batches, rows=8192):
            x = _matrix(batch)
            cell = nearest(x[:, :a.shape[1]], a) * len(b) + nearest(x[:, a.shape[1]:], b)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], [*batch.schema.names, "cell"])
    return run


def _prober(books, sizes, enough: float):
    def run(batches):
        (a, b), n = books.value, sizes.value
        blocks = -(-n // BLOCK)
        for batch in small_batches(batches, rows=64):
            x = _matrix(batch)
            d1, d2 = distances(x[:, :a.shape[1]], a), distances(x[:, a.shape[1]:], b)
            for i in range(batch.num_rows):
                cells = np.array(walk(d1[i], d2[i], n, enough), np.int64)
                m = blocks[cells]
                cell = np.repeat(cells, m)
                block = np.arange(len(cell)) - np.repeat(np.cumsum(m) - m, m)
                same = lambda name, t: pa.array(column(batch, name).slice(i, 1).to_pylist() * len(cell), t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(block.astype(np.int32)), pa.array([True] * len(cell)),
                     same("n", pa.int64()), same("id", pa.int64()), same("v", column(batch, "v").type)],
                    ["cell", "block", "query", "n", "id", "v"])
    return run


def _ranker(k: int):
    def run(batches):
        for _, t in groups(batches, ["cell", "block"]):
            t = t.combine_chunks()
            batch = t.to_batches()[0] if t.num_rows else None
            is_query = t["query"].to_numpy()
            if batch is None or not is_query.any() or is_query.all():
                continue
            x, n, ids = _matrix(batch), t["n"].to_numpy(), t["id"].to_numpy()
            v, vn, vid = x[~is_query], n[~is_query], ids[~is_query]
            order = vid.argsort(kind="stable")
            v, vn, vid = v[order], vn[order], vid[order]
            q, qn, qid = x[is_query], n[is_query], ids[is_query]
            out = []
            step = max(1, (1 << 21) // max(1, v.size))
            for lo in range(0, len(q), step):
                d = np.sqrt(((q[lo:lo + step, None, :] - v[None]) ** 2).sum(2))
                d[qn[lo:lo + step, None] == vn[None]] = np.inf            # the query's own row
                best = d.argsort(1, kind="stable")[:, :k]                 # ties: smaller id first
                dist = np.take_along_axis(d, best, 1)
                ok = np.isfinite(dist)
                row = np.repeat(np.arange(lo, lo + len(d)), ok.sum(1))
                out.append((qn[row], qid[row], vid[best[ok]], vn[best[ok]], dist[ok]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["qn", "query_id", "vec_id", "vn", "score"])
    return run


def neighbours(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding",
               centroids: int = 32, share: float = 0.6, sample: int = 20_000) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance in doubles), nearest first, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows
    but the query's own, so a repeated row finds its twin.  Vectors that are null,
    zero, hold null or non-finite components, have no id, or are not of the table's
    most frequent length (the smallest of equally frequent ones) take no part.  The
    codebooks are fitted on about ``sample`` rows drawn by hash (the one bounded
    step); every row is indexed.  ``share`` is the part of all vectors a query looks
    at: the data decide the recall for it, measured in the tests.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    good = rows.where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0))
    top = good.groupBy(F.size("v").alias("s")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "s").first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if top is None:
        return spark.createDataFrame([], schema)
    table = materialize(good.where(F.size("v") == top["s"]).withColumn("n", F.monotonically_increasing_id()), "mi-vectors")
    total = top["c"]
    drawn = table.where(F.shiftrightunsigned(F.xxhash64("id", "v"), 2) / F.lit(float(1 << 62)) * total < sample)
    fitted = drawn.select("v").repartition(1).mapInArrow(_fitter(centroids), "books binary").collect()
    if not fitted:                                          # a tiny draw can be empty
        fitted = table.limit(sample).select("v").repartition(1).mapInArrow(_fitter(centroids), "books binary").collect()
    with np.load(io.BytesIO(bytes(fitted[0]["books"]))) as f:
        books = spark.sparkContext.broadcast((f["a"], f["b"]))
    cells = len(books.value[0]) * len(books.value[1])
    vtype = table.schema["v"].dataType.simpleString()
    index = materialize(table.select("n", "id", "v").mapInArrow(_assigner(books), f"n bigint, id bigint, v {vtype}, cell int"), "mi-index")
    sizes = np.zeros(cells, np.int64)
    for r in index.groupBy("cell").agg(F.count("*").alias("c")).collect():      # at most centroids^2 rows
        sizes[r["cell"]] = r["c"]
    blocks = F.get(F.array(*[F.lit(int(-(-s // BLOCK)) or 1) for s in sizes]), F.col("cell"))
    stored = index.select(
        "cell", F.pmod(F.xxhash64("n"), blocks).cast("int").alias("block"), F.lit(False).alias("query"), "n", "id", "v")
    probes = (index.where(F.col("id") % every == 0).select("n", "id", "v").repartition(F.col("n"))
              .mapInArrow(_prober(books, spark.sparkContext.broadcast(sizes), max(4 * BLOCK, share * total)),
                          f"cell int, block int, query boolean, n bigint, id bigint, v {vtype}"))
    best = (stored.unionAll(probes).repartition("cell", "block").sortWithinPartitions("cell", "block")
            .mapInArrow(_ranker(k), "qn bigint, query_id bigint, vec_id bigint, vn bigint, score double"))
    w = Window.partitionBy("qn").orderBy("score", "vec_id", "vn")
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
