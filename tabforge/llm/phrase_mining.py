"""Phrase collocations by vertical partitioning of depth-truncated suffix trees.

1. Words are counted by language.  Only words of ``min_count`` occurrences can be part
   of a candidate, so a suffix ends before a rarer word (or at the end of its piece)
   and after ``max_words`` words at the latest.
2. Word prefixes are grouped by a memory budget.  A prefix with more occurrences than a
   32nd of the budget is heavy: the prefixes one word longer are counted for it,
   level by level, and its suffixes are grouped by those.  All suffixes below one
   prefix that is not heavy are in one group.
3. Each group is built by itself: its suffixes, already merged within a block of text,
   are sorted into a subtree whose leaves are distinct suffixes with their totals; the
   count of every phrase below the group's prefixes is the sum of the leaves below its
   node.  Counts of heavy prefixes come from step 2.
4. Scores, the drop rule and the ranking are joins and aggregates over phrases of
   ``min_count`` occurrences or more.

Words travel as keyed 64-bit hashes; the word table shows whether two frequent words
share one, and then another key is taken.  The sets of frequent words and of heavy
prefixes are bit tables of at most 16 MB: a stray bit makes a rare word travel or
splits a light prefix, and changes no count.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import Bits, bits_of, column, materialize, mix64, small_batches

BUDGET = 1 << 20           # suffixes of a group, about 40 MB while its subtree is built
HEAVY = 32                 # a prefix with a 32nd of the budget is split, so that groups dealt by hash fill evenly
BLOCK_BYTES = 8 << 20      # text merged before it is sent to groups
NO_LANG = "und"

_MARKS = b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)              # 0 word, 1 blank, 2 end of a piece
_KIND[list(b" \t")] = 1
_KIND[list(_MARKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def chunks(texts: list[bytes], size: int = BLOCK_BYTES):
    """Joined texts in byte strings of about ``size``, cut only where a piece ends."""
    held, total = [], 0
    for t in texts:
        while len(t) > size:
            cut = max(t.rfind(bytes([m]), 0, size) for m in _MARKS)
            if cut < 0:
                ends = [e for e in (t.find(bytes([m]), size) for m in _MARKS) if e >= 0]
                if not ends:
                    break
                cut = min(ends)
            if held:
                yield b"\n".join(held)
                held, total = [], 0
            yield t[:cut]
            t = t[cut + 1:]
        if held and total + len(t) > size:
            yield b"\n".join(held)
            held, total = [], 0
        held.append(t)
        total += len(t) + 1
    if held:
        yield b"\n".join(held)


def words_of(raw: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code of each word, distinct words, words that follow in the same piece)."""
    data = np.frombuffer(raw, np.uint8)
    kind = _KIND[data]
    inside = kind == 0
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    at = np.flatnonzero(start)
    if not len(at):
        return np.empty(0, np.int64), pa.array([], pa.large_binary()), np.empty(0, np.int64)
    place = np.cumsum(inside, dtype=np.int64)
    body = _LOWER[data[inside]]
    offsets = np.append(place[at] - 1, len(body)).astype(np.int64)
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).dictionary_encode()
    piece = np.cumsum(kind == 2, dtype=np.int32)[at]
    last = np.searchsorted(piece, piece, side="right") - 1
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, last - np.arange(len(at))


def word_hash(words: pa.Array, key: int) -> np.ndarray:
    """64-bit keyed hash of each word, never 0."""
    if not len(words):
        return np.empty(0, np.uint64)
    text = np.array([w.decode("utf-8", "replace") for w in words.to_pylist()], object)
    return np.maximum(mix64(pd.util.hash_array(text, hash_key=f"{key:016d}", categorize=False)), np.uint64(1))


def _lang_hash(lang: str) -> np.uint64:
    return mix64(pd.util.hash_array(np.array([lang], object), categorize=False))[0]


def _by_lang(batches):
    """(language, joined texts) of a stream of (_lang, _text)."""
    for b in small_batches(batches, rows=1 << 16, bytes_=BLOCK_BYTES):
        held: dict[str, list[bytes]] = {}
        for lang, t in zip(column(b, "_lang").to_pylist(), column(b, "_text").to_pylist()):
            if t:
                held.setdefault(lang, []).append(t.encode("utf-8", "replace"))
        for lang, texts in held.items():
            for raw in chunks(texts):
                yield lang, raw


def extend(prefix: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Hash of a prefix one word longer."""
    with np.errstate(over="ignore"):
        return mix64(prefix * np.uint64(0x9E3779B97F4A7C15) + nxt)


def _count_words(key: int):
    def run(batches):
        for lang, raw in _by_lang(batches):
            codes, words, _ = words_of(raw)
            if len(codes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words)), pa.array([w.decode("utf-8", "replace") for w in words.to_pylist()]),
                     pa.array(word_hash(words, key).view(np.int64)), pa.array(np.bincount(codes, minlength=len(words)).astype(np.int64))],
                    ["lang", "word", "h", "f"])
    return run


class _Scan:
    """Word hashes of a chunk with their valid suffixes, shared by the prefix counts and the groups."""

    def __init__(self, lang: str, raw: bytes, key: int, frequent: Bits) -> None:
        self.codes, words, follow = words_of(raw)
        self.hashes = word_hash(words, key)
        self.seed = _lang_hash(lang)
        n = len(self.codes)
        known = frequent.has(extend(np.full(len(words), self.seed), self.hashes))[self.codes] if n else np.empty(0, bool)
        # words from here to the next rare word, within the piece
        gap = np.where(known, n, np.arange(n))
        stop = np.minimum.accumulate(gap[::-1])[::-1] if n else gap
        self.length = np.where(known, np.minimum(follow + 1, stop - np.arange(n)), 0)

    def prefixes(self, at: np.ndarray, depth: int) -> np.ndarray:
        """Hash of the first ``depth`` words of the suffixes at ``at``."""
        h = np.full(len(at), self.seed)
        for j in range(depth):
            h = extend(h, self.hashes[self.codes[at + j]])
        return h


def _count_prefixes(key: int, frequent, heavy, depth: int):
    """Occurrences of the ``depth``-word prefixes whose shorter prefixes are all heavy."""
    def run(batches):
        for lang, raw in _by_lang(batches):
            s = _Scan(lang, raw, key, frequent.value)
            at = np.flatnonzero(s.length >= depth)
            for d in range(1, depth):
                at = at[heavy.value[d - 1].has(s.prefixes(at, d))]
            if not len(at):
                continue
            words = s.hashes[s.codes[at[:, None] + np.arange(depth)]]
            h, first, times = np.unique(s.prefixes(at, depth), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(h)), pa.array(h.view(np.int64)), pa.array(list(words[first].view(np.int64)), pa.list_(pa.int64())),
                 pa.array(times.astype(np.int64))], ["lang", "h", "words", "f"])
    return run


def _merged(cols: list[np.ndarray], times: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of ``cols`` in order, with their summed ``times``: the leaves of a suffix tree."""
    order = np.lexsort(cols[::-1])
    cols = [c[order] for c in cols]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    return [c[at] for c in cols], np.add.reduceat(times[order], at) if len(at) else times


def _send_suffixes(key: int, frequent, heavy, depth: int, n_groups: int):
    """Distinct suffixes of each block by group, packed by columns."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for lang, raw in _by_lang(batches):
            s = _Scan(lang, raw, key, frequent.value)
            at = np.flatnonzero(s.length >= 2)
            if not len(at):
                continue
            size = np.minimum(s.length[at], depth)
            # merge by the chunk's own word codes, 0 behind the end
            cols = [np.where(size > j, s.codes[np.minimum(at + j, len(s.codes) - 1)] + 1, 0) for j in range(depth)]
            cols, times = _merged(cols, np.ones(len(at), np.int64))
            hashed = np.append(np.zeros(1, np.uint64), s.hashes)
            cols = [hashed[c] for c in cols]
            prefix = extend(np.full(len(times), s.seed), cols[0])
            split = np.ones(len(times), bool)
            for d in range(1, depth):
                split &= heavy.value[d - 1].has(prefix)
                if d < len(cols):
                    prefix = np.where(split, extend(prefix, cols[d]), prefix)
            group = (mix64(prefix) % np.uint64(n_groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            edge = np.flatnonzero(np.diff(group[order], prepend=-1))
            blobs = [pack.compress(b"".join(c[order[i:j]].tobytes() for c in (*cols, times)))
                     for i, j in zip(edge, np.append(edge[1:], len(order)))]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(edge)), pa.array(group[order[edge]]), pa.array(blobs, pa.binary())],
                                             ["lang", "grp", "suffixes"])
    return run


def _build_groups(heavy, depth: int, min_count: int):
    """Phrases of a group from its subtree; those below heavy prefixes only where the group holds them whole."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for (lang, _), blobs in _streams(batches):
            cols, times, size = [[] for _ in range(depth)], [], 0
            for blob in blobs:
                a = np.frombuffer(unpack.decompress(blob), np.uint64).reshape(depth + 1, -1)
                for c, x in zip(cols, a):
                    c.append(x)
                times.append(a[-1].astype(np.int64))
                size += a.shape[1]
                if size > 2 * BUDGET:               # merge what has come so far
                    merged, total = _merged([np.concatenate(c) for c in cols], np.concatenate(times))
                    cols, times, size = [[c] for c in merged], [total], len(total)
            leaves, total = _merged([np.concatenate(c) for c in cols], np.concatenate(times))
            new = np.zeros(len(total), bool)
            new[:1] = True
            prefix, inner = np.full(len(total), _lang_hash(lang)), np.ones(len(total), bool)
            for d in range(1, depth + 1):
                c = leaves[d - 1]
                new[1:] |= c[1:] != c[:-1]
                prefix = extend(prefix, c)
                at = np.flatnonzero(new)
                node = np.add.reduceat(total, at)
                ok = (node >= min_count) & (c[at] > 0)
                if d < depth:
                    inner &= heavy.value[d - 1].has(prefix)
                    ok &= ~inner[at]               # a heavy prefix is spread over groups: counted before
                if d >= 2 and ok.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * int(ok.sum())),
                         pa.array(list(np.stack([leaves[j][at[ok]] for j in range(d)], 1).view(np.int64)), pa.list_(pa.int64())),
                         pa.array(node[ok])], ["lang", "words", "f"])
    return run


def _streams(batches):
    """((lang, group), its blobs as a stream) of rows sorted by both."""
    def rows():
        for b in batches:
            yield from zip(column(b, "lang").to_pylist(), column(b, "grp").to_pylist(), column(b, "suffixes").to_pylist())
    for key, run in itertools.groupby(rows(), lambda r: (r[0], r[1])):
        yield key, (r[2] for r in run)


def frequent_words(docs: DataFrame, min_count: int) -> tuple[int, DataFrame, DataFrame]:
    """(hash key, words of ``min_count`` occurrences: lang, word, h, f; n: words by language).

    The key is changed until no two frequent words of a language share a hash.
    """
    for key in range(8):
        words = materialize(docs.mapInArrow(_count_words(key), "lang string, word string, h bigint, f bigint")
                            .groupBy("lang", "word").agg(F.first("h").alias("h"), F.sum("f").alias("f")), "pm-words")
        often = words.where(F.col("f") >= min_count)
        if not often.groupBy("lang", "h").count().where("count > 1").limit(1).count():
            return key, often, words.groupBy("lang").agg(F.sum("f").alias("n"))
    raise RuntimeError("no key keeps the frequent words apart")


def _hash_column(col: str):
    """Marks a set of (lang, hash) rows with the prefix hash of one word."""
    def run(batches):
        for b in batches:
            langs, h = column(b, "lang").to_pylist(), column(b, col).to_numpy().view(np.uint64)
            seeds = {lang: _lang_hash(lang) for lang in set(langs)}
            yield pa.RecordBatch.from_arrays([pa.array(extend(np.array([seeds[x] for x in langs], np.uint64), h).view(np.int64)),
                                              column(b, "f")], ["h", "f"])
    return run


def phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = 3, min_count: int = 10,
            budget: int = BUDGET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (lang, word, h, f) and phrases (lang, words, f) of ``min_count`` occurrences or more, by language;
    and n, the words of each language.

    ``words`` are the words' hashes.  Words are ``[^\\x20\\x09]+`` with A-Z lower-cased,
    within the pieces between ``.,;:!?`` and line ends; occurrences overlap.  Null
    texts are empty, a null language is ``und``; repeated rows count again; very long
    texts are read in chunks that end with a piece.
    """
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("_lang"), F.col(text_col).alias("_text"))
    key, often, sizes = frequent_words(src, min_count)
    singles = materialize(often.select("lang", "h", "f").mapInArrow(_hash_column("h"), "h bigint, f bigint"), "pm-singles")
    row = singles.agg(F.count("*").alias("n"), F.sum("f").alias("f"), F.count_if(F.col("f") > budget // HEAVY).alias("heavy")).first()
    frequent = sc.broadcast(bits_of(singles, "h", row["n"]))
    heavy = [bits_of(singles.where(F.col("f") > budget // HEAVY), "h", row["heavy"])]
    counted = []
    for depth in range(2, max_words):
        if not heavy[-1].words.any():
            heavy.append(Bits(16, np.zeros(1 << 10, np.uint64)))
            continue
        known = materialize(src.mapInArrow(_count_prefixes(key, frequent, sc.broadcast(heavy), depth), "lang string, h bigint, words array<bigint>, f bigint")
                            .groupBy("lang", "h").agg(F.first("words").alias("words"), F.sum("f").alias("f")).where(F.col("f") >= min_count), "pm-prefixes")
        big = known.where(F.col("f") > budget // HEAVY)
        marks = bits_of(big, "h", big.count())
        heavy.append(marks)
        counted.append(known.mapInArrow(_kept(sc.broadcast(marks)), "lang string, words array<bigint>, f bigint"))
    shared = sc.broadcast(heavy)
    n_groups = max(1, -(-2 * (row["f"] or 0) // budget))
    sent = src.mapInArrow(_send_suffixes(key, frequent, shared, max_words, n_groups), "lang string, grp bigint, suffixes binary")
    built = (sent.repartition("lang", "grp").sortWithinPartitions("lang", "grp")
             .mapInArrow(_build_groups(shared, max_words, min_count), "lang string, words array<bigint>, f bigint"))
    for c in counted:
        built = built.unionByName(c)
    return often, materialize(built, "pm-phrases"), sizes


def _kept(marks):
    """Counted prefixes that are spread over groups (their bit is set), as phrases."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(marks.value.has(column(b, "h").to_numpy().view(np.uint64)))).select(["lang", "words", "f"])
    return run


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = 3, min_count: int = 10,
                 share: int = 50, top: int = 2000, budget: int = BUDGET) -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words of each language: lang, rank, phrase, a, l, r, n, score.

    a: occurrences of the phrase (``min_count`` at least); score: the least
    floor(1000000 * a * a / (l * r)) over the cuts of the phrase in two, l and r the
    occurrences of its parts, ties to the shortest first part; n: the language's
    words.  A phrase inside a longer one with 100 * f(longer) >= ``share`` * a is
    dropped.  Order: score and a descending, phrase ascending by bytes.  Arithmetic is
    exact for counts below 10^14.  See ``phrases`` for words, nulls and long texts;
    an empty table gives an empty result, other columns are ignored.
    """
    words, found, sizes = phrases(docs, lang_col, text_col, max_words, min_count, budget)
    counts = found.unionByName(words.select("lang", F.array("h").alias("words"), "f"))
    inside = found.where(F.size("words") > 2).select(
        "lang", F.expr("explode(flatten(transform(sequence(2, size(words) - 1), k -> "
                       "transform(sequence(1, size(words) - k + 1), i -> slice(words, i, k)))))").alias("words"), "f")
    longest = inside.groupBy("lang", "words").agg(F.max("f").alias("longer"))
    kept = (found.join(longest, ["lang", "words"], "left")
            .where(F.expr(f"longer IS NULL OR 100 * cast(longer AS decimal(14,0)) < {share} * cast(f AS decimal(14,0))")).drop("longer"))
    cuts = kept.select("lang", "words", F.col("f").alias("a"), F.expr("explode(sequence(1, size(words) - 1))").alias("k"))
    part = counts.select("lang", F.col("words").alias("part"), "f")
    cuts = (cuts.withColumn("part", F.expr("slice(words, 1, k)")).join(part.withColumnRenamed("f", "l"), ["lang", "part"])
            .withColumn("part", F.expr("slice(words, k + 1, size(words) - k)")).join(part.withColumnRenamed("f", "r"), ["lang", "part"]))
    exact = "cast({} AS decimal(14,0))"
    score = F.expr(f"(cast(1000000 AS decimal(7,0)) * ({exact.format('a')} * {exact.format('a')})) div ({exact.format('l')} * {exact.format('r')})")
    scored = materialize(cuts.withColumn("score", score).groupBy("lang", "words", "a")
                         .agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("best"))
                         .select("lang", "words", "a", "best.l", "best.r", "best.score"), "pm-scored")
    named = (scored.select("lang", "words", F.posexplode("words").alias("i", "h")).join(words.select("lang", "h", "word"), ["lang", "h"])
             .groupBy("lang", "words").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    ranked = scored.join(named, ["lang", "words"]).withColumn("rank", F.expr(
        "row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The whole job in DuckDB.
ORACLE = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
lists AS (SELECT p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
      SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lists, (VALUES (1), (2), (3)) AS ks(k)))
  GROUP BY ALL),
sizes AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE k >= 2 AND f >= 10),
longer AS (
  SELECT lang, part, max(f) AS longest FROM (
    SELECT lang, f, array_to_string(w[1:2], ' ') AS part FROM cand WHERE k = 3
    UNION ALL SELECT lang, f, array_to_string(w[2:3], ' ') FROM cand WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT c.* FROM cand c LEFT JOIN longer x ON c.lang = x.lang AND c.phrase = x.part
  WHERE x.longest IS NULL OR 100 * x.longest < 50 * c.f),
cuts AS (
  SELECT lang, phrase, f AS a, j, array_to_string(w[1:j], ' ') AS p1, array_to_string(w[j + 1:k], ' ') AS p2
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept)),
scored AS (
  SELECT c.lang, c.phrase, c.a, g1.f AS l, g2.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(g1.f AS HUGEINT) * g2.f) AS BIGINT) AS score, c.j
  FROM cuts c JOIN grams g1 ON c.lang = g1.lang AND c.p1 = g1.phrase JOIN grams g2 ON c.lang = g2.lang AND c.p2 = g2.phrase),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, score
FROM ranked JOIN sizes ON ranked.lang = sizes.lang WHERE rank <= 2000
"""
