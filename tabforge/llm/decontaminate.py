"""Benchmark decontamination by spaced-seed hashing.

Nineteen fixed masks over 13, 15, 20 and 25 tokens (``COVER``) each ignore other
positions, so that every run that verification accepts (13 tokens or more, four
fifths of them equal, wherever the others lie) leaves a mask that still matches.
Test seeds and test tokens fill a Bloom filter of fixed size; documents look up
their tokens there, then the seeds of the windows with enough known tokens, and
the token runs around their hits ("regions") are collapsed by content, so a
passage that many documents share is handled once.  The seeds of distinct regions
are joined with the test seeds, and each (region, item, diagonal) is verified
token by token, tolerating substitutions.
"""

from __future__ import annotations

import string
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import ascii_words, column, hash_strings, materialize, mix64, small_batches

SPAN = 13
PERIOD = 4
MASKS = [[j for j in range(SPAN) if j % PERIOD != k] for k in range(PERIOD)]      # one substitution only
#: (tokens of a window, least equal ones, masks).  A run that is four fifths equal holds 13 tokens with two
#: substitutions (any two residues mod 7 lie on one line of the Fano plane, which a mask drops), or else 15 with
#: three of them at 2..12 (any three residues mod 5), or else 20 with four of them at 5..14 or 25 with five at 5..19.
COVER = [(13, 11, [[j for j in range(13) if (j - k) % 7 not in (0, 1, 3)] for k in range(7)]),
         (15, 12, [[j for j in range(15) if not 2 <= j <= 12 or j % 5 in pair] for pair in combinations(range(5), 2)]),
         (20, 16, [[j for j in range(20) if not 5 <= j <= 14]]), (25, 20, [[j for j in range(25) if not 5 <= j <= 19]])]
SHORTEST = 5         # items with fewer tokens are too common to decide anything
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, offsets): ASCII words, A-Z lower-cased, punctuation off both ends, empty ones left out."""
    codes, words, offsets = ascii_words(texts)
    bare = [w.strip(string.punctuation) for w in words.to_pylist()]
    h = hash_strings(pa.array(bare, pa.large_string()))
    some = np.array([bool(w) for w in bare], bool)
    if not len(codes):
        return np.empty(0, np.uint64), offsets
    keep = some[codes]
    return h[codes][keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


_WEIGHT = _PRIME * np.arange(3, 2 * max(span for span, _, _ in COVER) + 3, 2, dtype=np.uint64)


def mask_seeds(h: np.ndarray, at: np.ndarray, masks: list[list[int]], first: int) -> list[np.ndarray]:
    """Seeds of the windows of ``h`` that start at ``at``, for each mask; ``first``: the number of the first mask."""
    terms = {j: (h[at + j] ^ _WEIGHT[j]) * _WEIGHT[j] for j in sorted(set().union(*masks))}
    out = []
    for k, mask in enumerate(masks):
        s = np.full(len(at), np.uint64(first + k), np.uint64)
        for j in mask:
            s += terms[j]
        out.append(mix64(s))
    return out


def short_seeds(h: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Seeds of whole windows of ``length`` tokens that start at ``at``."""
    s = np.full(len(at), np.uint64(1000 + length), np.uint64)
    for j in range(length):
        s = (s ^ h[at + j]) * _PRIME
        s ^= s >> np.uint64(31)
    return mix64(s)


def token_seeds(h: np.ndarray) -> np.ndarray:
    """Seeds of single tokens."""
    return mix64(h ^ _PRIME)


def spaced_seeds(h: np.ndarray, shorts: tuple[int, ...] = ()) -> list[tuple[int, np.ndarray]]:
    """(length, seeds by position) of one token sequence: the four masks, then whole windows of each short length."""
    n = len(h) - SPAN + 1
    out = [(SPAN, s) for s in mask_seeds(h, np.arange(n), MASKS, 1)] if n > 0 else []
    return out + [(m, short_seeds(h, np.arange(len(h) - m + 1), m)) for m in shorts if len(h) >= m]


def cover_seeds(h: np.ndarray, shorts: tuple[int, ...] = (), ends: np.ndarray | None = None, hit=None) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, starts, seeds) of the windows of ``COVER`` and of each short length.

    ``ends``: end of the text of each token, if ``h`` holds several texts; ``hit``: only
    windows with enough tokens that it accepts, as a run that is verified has them.
    """
    total = None if hit is None else np.concatenate([[0], np.cumsum(hit(token_seeds(h)))])
    out, first = [], 101

    def starts(length: int, least: int) -> np.ndarray:
        at = np.arange(max(0, len(h) - length + 1))
        if total is not None:
            at = np.flatnonzero(total[length:] - total[:len(at)] >= least)
        return at if ends is None else at[at + length <= ends[at]]

    for span, least, masks in COVER:
        at = starts(span, least)
        out += [(span, at, s) for s in mask_seeds(h, at, masks, first)]
        first += len(masks)
    for length in shorts:
        at = starts(length, length)
        out.append((length, at, short_seeds(h, at, length)))
    return out


def _probes(seeds: np.ndarray, bits: int) -> list[np.ndarray]:
    """Three bit positions of each seed in a filter of 2^bits bits."""
    m = np.uint64((1 << bits) - 1)
    return [(s & m).astype(np.int64) for s in (seeds, seeds >> np.uint64(21), mix64(seeds))]


def _item_seeds(bits: int):
    def run(batches):
        for b in small_batches(batches):
            h, off = token_hashes(column(b, "_text"))
            item, seed, pos, word, bit = [], [], [], [], []
            for i, key in enumerate(column(b, "_item").to_pylist()):
                own = h[off[i]:off[i + 1]]
                shorts = (len(own),) if SHORTEST <= len(own) < SPAN else ()
                for _, at, s in [*cover_seeds(own, shorts), (1, np.full(len(own), -1), token_seeds(own))]:
                    item += [key] * len(s)
                    seed.append(s)
                    pos.append(at)
            if not item:
                continue
            s = np.concatenate(seed)
            p = np.stack(_probes(s, bits), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.string()), pa.array(s.view(np.int64)), pa.array(np.concatenate(pos).astype(np.int32)),
                 pa.array(list(p), pa.list_(pa.int64()))], ["item", "seed", "ipos", "probes"])
    return run


def _item_tokens(batches):
    for b in small_batches(batches):
        h, off = token_hashes(column(b, "_text"))
        yield pa.RecordBatch.from_arrays(
            [column(b, "_item"), pa.array([h[off[i]:off[i + 1]].tobytes() for i in range(b.num_rows)], pa.binary()),
             pa.array(np.diff(off).astype(np.int32))], ["item", "tokens", "length"])


_REGION = pa.struct([("rhash", pa.binary()), ("tokens", pa.binary()), ("seeds", pa.list_(pa.int64())), ("at", pa.list_(pa.int32()))])
_REGION_SQL = "array<struct<rhash: binary, tokens: binary, seeds: array<bigint>, at: array<int>>>"


def regions_of(h: np.ndarray, at: np.ndarray, seed: np.ndarray, length: np.ndarray) -> list[dict]:
    """Token runs covered by the windows (start, seed, length; by start) of one text; runs less than a span apart are one."""
    import xxhash
    reach = np.maximum.accumulate(at + length)
    cuts = np.flatnonzero(at[1:] > reach[:-1] + SPAN) + 1
    out = []
    for lo, hi in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(at)]])):
        start, end = at[lo], reach[hi - 1]
        tokens = h[start:end].tobytes()
        out.append({"rhash": xxhash.xxh3_128_digest(tokens), "tokens": tokens,
                    "seeds": seed[lo:hi].view(np.int64), "at": (at[lo:hi] - start).astype(np.int32)})
    return out


def batch_regions(h: np.ndarray, off: np.ndarray, hit, shorts: tuple[int, ...]) -> list[list[dict]]:
    """Regions of each text around the windows whose seeds ``hit`` accepts."""
    at, seed, length = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for n, where, s in cover_seeds(h, shorts, np.repeat(off[1:], np.diff(off)), hit):
        ok = hit(s)
        at.append(where[ok])
        seed.append(s[ok])
        length.append(np.full(int(ok.sum()), n))
    at, seed, length = np.concatenate(at), np.concatenate(seed), np.concatenate(length)
    order = np.argsort(at, kind="stable")
    at, seed, length = at[order], seed[order], length[order]
    edge = np.searchsorted(at, off)
    return [regions_of(h, at[i:j], seed[i:j], length[i:j]) if i < j else [] for i, j in zip(edge[:-1], edge[1:])]


def _doc_regions(shared, bits: int, shorts: tuple[int, ...]):
    def run(batches):
        filter_ = shared.value

        def hit(s: np.ndarray) -> np.ndarray:
            where = np.arange(len(s))
            for k in range(3):
                p = _probes(s[where], bits)[k]
                where = where[(filter_[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1]
            ok = np.zeros(len(s), bool)
            ok[where] = True
            return ok

        for b in small_batches(batches):
            h, off = token_hashes(column(b, "_text"))
            found = batch_regions(h, off, hit, shorts)
            yield pa.RecordBatch.from_arrays([column(b, "_n"), column(b, "_id"), column(b, "_th"), pa.array(found, pa.list_(_REGION))],
                                             ["_n", "_id", "_th", "regions"])
    return run


def overlap(a: np.ndarray, b: np.ndarray, shift: int, least: int = SPAN) -> tuple[int, int]:
    """Best ungapped segment of a[i + shift] against b[i]: (length, equal tokens).

    Segments have ``least`` tokens or more, four fifths of them equal; (0, 0) without one.
    """
    lo, hi = max(0, -shift), min(len(b), len(a) - shift)
    if hi - lo < least:
        return 0, 0
    same = a[lo + shift:hi + shift] == b[lo:hi]
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -4))])
    low = np.minimum.accumulate(total[:len(total) - least])        # least total up to each possible start
    gain = total[least:] - low
    end = int(gain.argmax())
    if gain[end] < 0:
        return 0, 0
    start = int(np.flatnonzero(total[:end + 1] == low[end])[0])
    return end + least - start, int(same[start:end + least].sum())


def _verify(batches):
    for b in batches:
        rows = []
        for key, item, shift, region, tokens in zip(*(column(b, c).to_pylist() for c in ("rhash", "item", "shift", "region", "tokens"))):
            other = np.frombuffer(tokens, np.uint64)
            length, equal = overlap(np.frombuffer(region, np.uint64), other, shift, min(SPAN, len(other)))
            if length >= SPAN or (length and equal == len(other)):
                rows.append((key, item, length, equal))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.string(), pa.int32(), pa.int32()))],
                                             ["rhash", "item", "length", "equal"])


def bloom_bits(seeds: int) -> int:
    """Filter size: about 64 bits a seed, 2 MB at least and 16 MB at most (fuller filters only cost time)."""
    return int(np.clip(np.ceil(np.log2(max(1, seeds) * 64)), 24, 27))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: id, contaminated, item_ids (sorted, as text), overlap (tokens of the
    longest), text_hash (xxhash64 of the text).

    A document is contaminated by an item if they share an ungapped run of 13 tokens
    or more, four fifths of them equal; an item of 5 to 12 tokens must occur whole.  Shorter items and null texts match nothing; repeated
    rows are judged each by itself; without items nothing is contaminated.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    bench = items.select(F.col(item_id).cast("string").alias("_item"), F.col(item_text).alias("_text")).where("_text IS NOT NULL")
    sized = materialize(bench.select(F.coalesce("_item", F.lit("")).alias("_item"), "_text")
                        .mapInArrow(_item_tokens, "item string, tokens binary, length int"), "dc-items")
    shorts = tuple(sorted(r["length"] for r in sized.where(f"length BETWEEN {SHORTEST} AND {SPAN - 1}").select("length").distinct().collect()))
    bits = bloom_bits((1 + sum(len(masks) for _, _, masks in COVER)) * (sized.agg(F.sum("length")).first()[0] or 0))
    seeds = materialize(bench.select(F.coalesce("_item", F.lit("")).alias("_item"), "_text")
                        .mapInArrow(_item_seeds(bits), "item string, seed bigint, ipos int, probes array<bigint>"), "dc-seeds")
    words = (seeds.select(F.explode("probes").alias("p"))
             .groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("m")).toArrow())
    filter_ = np.zeros(1 << (bits - 6), np.int64)
    filter_[words["w"].to_numpy()] = words["m"].to_numpy()
    shared = spark.sparkContext.broadcast(filter_.view(np.uint8))

    rows = docs.select(F.monotonically_increasing_id().alias("_n"), F.col(id_col).alias("_id"),
                       F.xxhash64(text_col).alias("_th"), F.col(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    found = materialize(rows.mapInArrow(_doc_regions(shared, bits, shorts), f"_n bigint, _id {id_type}, _th bigint, regions {_REGION_SQL}"),
                        "dc-regions")
    held = found.select("_n", F.explode("regions").alias("r"))
    distinct = materialize(held.groupBy("r.rhash").agg(F.first("r").alias("r")).select("rhash", "r.tokens", "r.seeds", "r.at"), "dc-distinct")
    hits = (distinct.select("rhash", F.explode(F.arrays_zip("seeds", "at")).alias("h")).select("rhash", "h.seeds", "h.at")
            .join(seeds.where("ipos >= 0").select("seed", "item", "ipos"), F.col("seeds") == F.col("seed"))
            .select("rhash", "item", (F.col("at") - F.col("ipos")).alias("shift")).distinct())
    pairs = (hits.join(distinct.select("rhash", F.col("tokens").alias("region")), "rhash")
             .join(sized.select("item", "tokens"), "item"))
    sure = materialize(pairs.select("rhash", "item", "shift", "region", "tokens")
                       .mapInArrow(_verify, "rhash binary, item string, length int, equal int")
                       .groupBy("rhash").agg(F.collect_set("item").alias("items"), F.max("length").alias("length")), "dc-sure")
    marked = (held.select("_n", "r.rhash").distinct().join(sure, "rhash").groupBy("_n")
              .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("length").alias("length")))
    return (found.select("_n", "_id", "_th").join(marked, "_n", "left")
            .select(F.col("_id").alias(id_col), F.col("items").isNotNull().alias("contaminated"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("item_ids"),
                    F.coalesce("length", F.lit(0)).alias("overlap"), F.col("_th").alias("text_hash")))
