"""Line dedup and sharding against plain Python."""

import hashlib
import zlib

from pyspark.sql import functions as F

from tabforge.llm.histogram_shards import shard_by_bytes
from tabforge.llm.line_dedup import ORACLE, line_dedup

SF = "/root/testdata/sf0.01"
WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line).strip(WHITE)


def test_lines_edge(edge):
    rows = [(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()]
    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(d)
    want = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if d is None or len(key(x)) < 10 or len(holders[key(x)]) < 2 or d == min(holders[key(x)])]
        want.append((-1 if d is None else d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    out = line_dedup(edge)
    assert out.columns == edge.columns + ["line_dedup"]
    got = [(-1 if r["doc_id"] is None else r["doc_id"], *r["line_dedup"]) for r in out.collect()]
    assert sorted(got) == sorted(want)


def test_lines_empty_and_clashing(no_docs, edge):
    assert line_dedup(no_docs).count() == 0
    again = line_dedup(line_dedup(edge))
    assert again.columns.count("line_dedup") == 1 and again.count() == edge.count()


def test_lines_threshold(spark):
    df = spark.createDataFrame([(i, "a line that repeats") for i in range(3)] + [(9, "another repeated line"), (10, "another repeated line")],
                               "doc_id bigint, text string")
    got = {r["doc_id"]: r["line_dedup"]["kept"] for r in line_dedup(df, min_docs=3).collect()}
    assert got == {0: "a line that repeats", 1: "", 2: "", 9: "another repeated line", 10: "another repeated line"}


def test_lines_oracle(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    out = line_dedup(spark.read.parquet(f"{SF}/documents.parquet"))
    got = {r["doc_id"]: (r["line_dedup"]["n_lines"], r["line_dedup"]["n_dropped"],
                         hashlib.sha256(r["line_dedup"]["kept"].encode()).hexdigest()) for r in out.collect()}
    assert got == {d: rest for d, *rest in con.execute(ORACLE).fetchall() for rest in [tuple(rest)]}


def check_shards(docs, shards, slack):
    rows = {}
    for r in docs.select("doc_id", "text").collect():
        rows.setdefault((r["doc_id"] is None, r["doc_id"], r["text"]), []).append(r)
    out = shard_by_bytes(docs, shards=shards).collect()
    assert len(out) == sum(map(len, rows.values()))
    sizes = [0] * shards
    slots = {}
    for r in out:
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((-1 if d is None else d, len((t or "").encode()) + 1, -1 if t is None else zlib.crc32(t.encode()))
                  for (_, d, t), same in rows.items() for _ in same)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["size"], -1 if r["text_crc32"] is None else r["text_crc32"]) for r in out) == want
    largest = max(r["size"] for r in out)
    assert max(sizes) - min(sizes) <= 2 * largest + slack
    return out


def test_shards_edge(edge, no_docs):
    check_shards(edge, 8, 10)
    assert shard_by_bytes(no_docs).count() == 0


def test_shards_one_hot_text(spark):
    """A third of the rows are one text, some of them whole repeated rows: shards stay even."""
    rows = [(i, f"text {i} " * (i % 7 + 1)) for i in range(400)] + [(1000 + i, "hot " * 5) for i in range(100)] + [(5, "hot " * 5)] * 100
    check_shards(spark.createDataFrame(rows, "doc_id bigint, text string"), 8, 20)


def test_shards_table(spark):
    out = check_shards(spark.read.parquet(f"{SF}/documents.parquet"), 8, 1000)
    by_text = {}
    for r in out:
        by_text.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in by_text.values()) <= 7        # only a splitter parts equal texts


def test_shards_fewer_rows_than_shards(spark):
    out = shard_by_bytes(spark.createDataFrame([(1, "a"), (2, None)], "doc_id bigint, text string"), shards=8)
    assert out.where(F.col("shard").between(0, 7)).count() == 2
