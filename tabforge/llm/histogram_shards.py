"""Sharding by histogram sort, with SQL functions only.

Rows are ordered by (text hash, id hash, row number), so equal texts lie side by
side and every row has its own place.  Byte splitters between shards, and row
splitters that cut each shard into cells of one task's size, are found together:
each round counts exactly the bytes and rows below some thousands of candidate
boundaries in one pre-aggregated pass, then puts new candidates only inside the
bins that still hold an unmet target.  When all targets are within tolerance the
rows are exchanged once, by cell; slots follow from the exact counts.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import materialize, unsigned_crc32

Key = tuple[int, int, int]
_LOW = -2**63


def _array(values: list[int]) -> Column:
    """One literal array of longs, whatever its length."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _bin(cuts: list[Key]) -> Column:
    """Number of ``cuts`` (sorted) at or below the row's key: a binary search."""
    if not cuts:
        return F.lit(0)
    parts = [_array([c[i] for c in cuts]) for i in range(3)]

    def step(state, _):
        mid = F.shiftright(state["lo"] + state["hi"], 1)
        h, d, r = (F.get(p, mid) for p in parts)
        above = (F.col("h") > h) | ((F.col("h") == h) & ((F.col("d") > d) | ((F.col("d") == d) & (F.col("r") >= r))))
        open_ = state["lo"] < state["hi"]
        return F.struct(F.when(open_ & above, mid + 1).otherwise(state["lo"]).alias("lo"),
                        F.when(open_ & ~above, mid).otherwise(state["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))
    rounds = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))
    return F.aggregate(rounds, start, step, lambda s: s["lo"])


def _between(low: Key, high: Key, n: int) -> list[Key]:
    """At most ``n`` candidates in (low, high], even on the first component in which the two differ."""
    level = next(i for i in range(3) if low[i] != high[i])
    a, b = low[level], high[level]
    n = min(n, b - a)
    values = {a + max(1, (b - a) * j // (n + 1)) for j in range(1, n + 1)} | ({b} if b - a <= n else set())
    return [low[:level] + (v,) + (_LOW,) * (2 - level) for v in values]


def find_cuts(keyed: DataFrame, targets: list[tuple[int, float, float]], low: Key, high: Key,
              probes: int = 4096) -> list[tuple[int, Key, tuple[int, int]]]:
    """For each target (0: bytes or 1: rows, amount below, tolerance): what it measures, a cut and the exact (bytes, rows) below."""
    out: list[tuple[int, Key, tuple[int, int]]] = []
    brackets: dict[tuple[Key, Key], list] = {(low, high): list(targets)} if low != high else {}
    edges: set[Key] = set()                  # cuts around the brackets, kept so that a bin never reaches past its bracket
    while brackets:
        each = max(2, probes // len(brackets))
        cuts = sorted(edges.union(*(_between(a, b, each) for a, b in brackets)))
        bins = {r["bin"]: r for r in keyed.groupBy(_bin(cuts).alias("bin")).agg(
            F.sum("size").alias("b"), F.count("*").alias("n"),
            F.min(F.struct("h", "d", "r")).alias("lo"), F.max(F.struct("h", "d", "r")).alias("hi")).collect()}
        below, at = [], (0, 0)
        for i in range(len(cuts)):
            if i in bins:
                at = (at[0] + bins[i]["b"], at[1] + bins[i]["n"])
            below.append(at)
        amounts = [[x[m] for x in below] for m in (0, 1)]
        nxt: dict[tuple[Key, Key], list] = {}
        edges = set()
        for target in (t for ts in brackets.values() for t in ts):
            measure, want, tol = target
            i = bisect.bisect_right(amounts[measure], want)                # the bin that holds the target
            around = [j for j in (i - 1, i) if 0 <= j < len(cuts)]
            near = min(around, key=lambda j: abs(amounts[measure][j] - want))
            row = bins.get(i)
            lo, hi = (tuple(row["lo"]), tuple(row["hi"])) if row else (low, low)
            if abs(amounts[measure][near] - want) <= tol or lo == hi:
                out.append((measure, cuts[near], below[near]))
            else:
                nxt.setdefault((lo, hi), []).append(target)
                edges.update(cuts[j] for j in around)
        brackets = nxt
    return out


def shard_by_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8,
                   tolerance: float = 0.001, cells: int | None = None, probes: int = 4096) -> DataFrame:
    """id, size (UTF-8 bytes + 1), text_crc32, law 'bytes', shard, slot (gapless from 0 in each shard), grown_shard null.

    Each splitter lies within ``tolerance`` of a shard's share, or at the nearest
    row boundary where one row is larger than that.  Equal texts are neighbours
    and part only where a splitter falls inside their group.  A null text counts 1
    byte and has a null text_crc32; null ids and repeated rows are placed like any
    other; an empty table gives an empty result.  ``cells`` (tasks of the one
    exchange) defaults to four per shuffle partition.  Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    keyed = materialize(docs.select(
        F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        unsigned_crc32(text).alias("crc"), F.xxhash64(text).alias("h"), F.xxhash64(F.col(id_col)).alias("d"),
        F.monotonically_increasing_id().alias("r")), "shard-keys")
    t = keyed.agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.min(F.struct("h", "d", "r")).alias("lo"),
                  F.max(F.struct("h", "d", "r")).alias("hi")).first()
    total, n = t["b"] or 0, t["n"]
    cells = cells or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = []
    if n:
        cells = min(cells, n)
        targets = [(0, total * j / shards, tolerance * total / shards) for j in range(1, shards)]
        targets += [(1, n * j / cells, n / cells / 2) for j in range(1, cells)]
        found = find_cuts(keyed, targets, tuple(t["lo"]), tuple(t["hi"]), max(probes, 4 * cells))
    splitters = sorted(cut for measure, cut, _ in found if measure == 0)       # equal ones leave a shard between them empty
    known = {cut: below for _, cut, below in found}
    cuts = sorted(known)
    shard_of, offset_of, start = [], [], 0
    for i in range(len(cuts) + 1):
        rows_before = known[cuts[i - 1]][1] if i else 0
        if i and cuts[i - 1] in splitters:
            start = rows_before
        shard_of.append(bisect.bisect_right(splitters, cuts[i - 1]) if i else 0)
        offset_of.append(rows_before - start)
    placed = keyed.withColumn("cell", _bin(cuts))
    w = Window.partitionBy("cell").orderBy("h", "d", "r")
    return (placed.withColumn("slot", F.row_number().over(w) - 1 + F.get(_array(offset_of), F.col("cell")))
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                    F.get(_array(shard_of), F.col("cell")).cast("int").alias("shard"), F.col("slot").cast("bigint").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
