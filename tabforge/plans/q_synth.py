"""Registered queries: feature synthesis."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators import synth, wide
from tabforge.plans import views as V
from tabforge.plans.registry import register

synth.register_primitive("subtract_numeric", 2, lambda a, b: a - b,
                         label=lambda a, b: f"{a} - {b}", commutative=False)

_KEYS = ", ".join(V.KEYS)


def _pairs(names: list[str]) -> list[tuple[str, str]]:
    s = sorted(names)
    return [(s[i], s[j]) for i in range(len(s)) for j in range(i + 1, len(s))]


def _dfs_sql(base: list[str], add: bool, mul: bool) -> tuple[str, list[str]]:
    """Oracle select list: base, then add outputs, then multiply outputs."""
    exprs = {b: b for b in base}
    sel = [f'{b} AS "{b}"' for b in base]
    adds = []
    if add:
        for a, b in _pairs(base):
            n = f"{a} + {b}"
            exprs[n] = f"({exprs[a]} + {exprs[b]})"
            adds.append(n)
            sel.append(f'{exprs[n]} AS "{n}"')
    if mul:
        for a, b in _pairs(base + adds):
            n = f"{a} * {b}"
            sel.append(f'(({exprs[a]}) * ({exprs[b]})) AS "{n}"')
    return ", ".join(sel), [s.split(" AS ")[1].strip('"') for s in sel]


def _clf_dfs(base, add, mul):
    sel, _ = _dfs_sql(base, add, mul)
    return V.with_ctes(V.CLF_SQL) + f"SELECT {_KEYS}, y, {sel} FROM clf"


@register("dfs_add", _clf_dfs(V.FEATURES, True, False))
def q_dfs_add(spark, sf_dir):
    return synth.synthesize(V.clf(spark, sf_dir), ["add_numeric"], 1, V.FEATURES,
                            passthrough=V.KEYS + ["y"])


@register("dfs_multiply", _clf_dfs(V.FEATURES, False, True))
def q_dfs_multiply(spark, sf_dir):
    return synth.synthesize(V.clf(spark, sf_dir), None, 1, V.FEATURES,
                            passthrough=V.KEYS + ["y"])


@register("dfs_depth2", _clf_dfs(["f1", "f2", "f3"], True, True))
def q_dfs_depth2(spark, sf_dir):
    return synth.synthesize(V.clf(spark, sf_dir), ["add_numeric", "multiply_numeric"], 2,
                            ["f1", "f2", "f3"], passthrough=V.KEYS + ["y"])


@register("dfs_dates", f"""
SELECT {_KEYS}, CAST(day(l_shipdate) AS INTEGER) AS "DAY(l_shipdate)",
       CAST(month(l_shipdate) AS INTEGER) AS "MONTH(l_shipdate)",
       CAST(isodow(l_shipdate) - 1 AS INTEGER) AS "WEEKDAY(l_shipdate)",
       CAST(year(l_shipdate) AS INTEGER) AS "YEAR(l_shipdate)"
FROM lineitem""")
def q_dfs_dates(spark, sf_dir):
    li = V.table(spark, sf_dir, "lineitem").select(*V.KEYS, "l_shipdate")
    return synth.synthesize(li, ["day", "month", "year", "weekday"], 1, ["l_shipdate"],
                            passthrough=V.KEYS, keep_base=False)


@register("dfs_haversine", V.with_ctes(V.GEO_SQL) + """
SELECT c_custkey, (2 * 3958.8 * ASIN(SQRT(
         POW(SIN(RADIANS(lat2 - lat1) / 2), 2)
         + COS(RADIANS(lat1)) * COS(RADIANS(lat2)) * POW(SIN(RADIANS(lon2 - lon1) / 2), 2))))
       AS "HAVERSINE((lat1, lon1), (lat2, lon2))"
FROM geo""")
def q_dfs_haversine(spark, sf_dir):
    g = V.geo(spark, sf_dir)
    return synth.synthesize(g, ["haversine"], 1, [], passthrough=["c_custkey"],
                            latlong=[("lat1", "lon1"), ("lat2", "lon2")], keep_base=False)


@register("dfs_text", """
SELECT doc_id, CAST(LENGTH(text) AS INTEGER) AS "NUM_CHARACTERS(text)",
       CAST(LENGTH(text) - LENGTH(REPLACE(text, ' ', '')) + 1 AS INTEGER) AS "NUM_WORDS(text)"
FROM documents""")
def q_dfs_text(spark, sf_dir):
    d = V.table(spark, sf_dir, "documents").select("doc_id", "text")
    return synth.synthesize(d, ["num_characters", "num_words"], 1, ["text"],
                            passthrough=["doc_id"], keep_base=False)


@register("dfs_custom", V.with_ctes(V.CLF_SQL) + f"""
SELECT {_KEYS}, f1 AS f1, f2 AS f2, f3 AS f3,
       (f1 - f2) AS "f1 - f2", (f1 - f3) AS "f1 - f3",
       (f2 - f1) AS "f2 - f1", (f2 - f3) AS "f2 - f3",
       (f3 - f1) AS "f3 - f1", (f3 - f2) AS "f3 - f2"
FROM clf""")
def q_dfs_custom(spark, sf_dir):
    return synth.synthesize(V.clf(spark, sf_dir), ["subtract_numeric"], 1, ["f1", "f2", "f3"],
                            passthrough=V.KEYS)


@register("dfs_with_categorical", f"""
SELECT {_KEYS}, l_discount AS l_discount, l_quantity AS l_quantity,
       (l_discount * l_quantity) AS "l_discount * l_quantity",
       l_returnflag, l_linestatus
FROM lineitem""")
def q_dfs_with_categorical(spark, sf_dir):
    li = V.table(spark, sf_dir, "lineitem").select(*V.KEYS, "l_quantity", "l_discount",
                                                   "l_returnflag", "l_linestatus")
    return synth.synthesize(li, ["multiply_numeric"], 1, ["l_quantity", "l_discount"],
                            passthrough=V.KEYS + ["l_returnflag", "l_linestatus"])


@register("drop_correlated", V.with_ctes(V.CLF_SQL) + f"""
SELECT {_KEYS}, y, f1 AS f1, f2 AS f2, f3 AS f3 FROM clf""")
def q_drop_correlated(spark, sf_dir):
    fm = synth.synthesize(V.clf(spark, sf_dir), ["add_numeric"], 1, ["f1", "f2", "f3"],
                          passthrough=V.KEYS + ["y"])
    out, _ = synth.drop_correlated(fm, 0.8, keep=V.KEYS + ["y"])
    return out


@register("build_features", V.with_ctes(V.CLF_SQL) + """
SELECT f1 AS f1, f2 AS f2, f3 AS f3, y AS target FROM clf""")
def q_build_features(spark, sf_dir):
    d = V.clf(spark, sf_dir).select("f1", "f2", "f3", "y")
    return synth.build_features(d, "y", None, ["add_numeric"], 1, 0.8)


def _wide_sql(base: list[str]) -> str:
    sel, names = _dfs_sql(base, True, True)
    ranges = " UNION ALL ".join(f"""SELECT '{n}' AS feature, COUNT("{n}") AS n, MIN("{n}") AS smallest, MAX("{n}") AS largest FROM m""" for n in names)
    return V.with_ctes(V.CLF_SQL, f"m AS (SELECT {sel} FROM clf)") + ranges


@register("dfs_wide", _wide_sql(V.FEATURES))
def q_dfs_wide(spark, sf_dir):
    """D3: the range of every feature of the depth-2 matrix, read from its array column."""
    r = wide.recipe(V.FEATURES, ["add_numeric", "multiply_numeric"], 2)
    m = wide.matrix(V.clf(spark, sf_dir), r)
    names = F.array(*[F.lit(n) for n in r.names])
    return (m.select(F.posexplode("features").alias("place", "v")).where(~F.isnan("v"))
            .groupBy("place").agg(F.count("v").alias("n"), F.min("v").alias("smallest"), F.max("v").alias("largest"))
            .select(F.get(names, F.col("place")).alias("feature"), "n", "smallest", "largest"))


@register("build_wide_features", V.with_ctes(V.CLF_SQL) + """
SELECT f1 AS f1, f2 AS f2, f3 AS f3, y AS target FROM clf""")
def q_build_wide_features(spark, sf_dir):
    """D11 over the array form: each kept feature is a column of the result."""
    d = V.clf(spark, sf_dir).select("f1", "f2", "f3", "y")
    out, kept = wide.build_wide_features(d, "y", None, ["add_numeric"], 1, 0.8)
    return out.select(*[F.get("features", F.lit(i)).alias(n) for i, n in enumerate(kept)], "target")


# ------------------------------------------------------------------ aggregation primitives
_AGG_COLS = ["l_quantity", "l_extendedprice"]
_AGG_SQL = {
    "sum": "SUM({c})", "std": "STDDEV_SAMP({c})", "max": "MAX({c})", "min": "MIN({c})",
    "mean": "AVG({c})", "skew": "CASE WHEN COUNT({c}) >= 3 THEN SKEWNESS({c}) END",
}


def _agg_oracle(prim: str) -> str:
    if prim in _AGG_SQL:
        inner = ", ".join(f"{_AGG_SQL[prim].format(c=c)} AS {prim}_{c}" for c in _AGG_COLS)
        outer = ", ".join(f"(a.{prim}_{c}) AS {prim}_{c}" for c in _AGG_COLS)
    elif prim == "count":
        inner = "COUNT(*) AS count_rows"
        outer = "CAST(COALESCE(a.count_rows, 0) AS BIGINT) AS count_rows"
    elif prim == "percent_true":
        inner = "AVG(CASE WHEN l_returnflag = 'R' THEN 1e0 ELSE 0e0 END) AS percent_true_is_returned"
        outer = "a.percent_true_is_returned AS percent_true_is_returned"
    elif prim == "num_unique":
        inner = ("COUNT(DISTINCT l_returnflag) AS num_unique_l_returnflag, "
                 "COUNT(DISTINCT l_linestatus) AS num_unique_l_linestatus")
        outer = ("CAST(a.num_unique_l_returnflag AS BIGINT) AS num_unique_l_returnflag, "
                 "CAST(a.num_unique_l_linestatus AS BIGINT) AS num_unique_l_linestatus")
    else:  # mode: most frequent, ties -> smallest
        return """
WITH vc AS (SELECT l_orderkey, 'l_returnflag' AS c, l_returnflag AS v, COUNT(*) AS n
            FROM lineitem GROUP BY 1, 3
            UNION ALL
            SELECT l_orderkey, 'l_linestatus', l_linestatus, COUNT(*) FROM lineitem GROUP BY 1, 3),
m AS (SELECT l_orderkey, c, v FROM vc
      QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, c ORDER BY n DESC, v) = 1)
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice AS o_totalprice,
       MAX(CASE WHEN m.c = 'l_returnflag' THEN m.v END) AS mode_l_returnflag,
       MAX(CASE WHEN m.c = 'l_linestatus' THEN m.v END) AS mode_l_linestatus
FROM orders o LEFT JOIN m ON o.o_orderkey = m.l_orderkey GROUP BY 1, 2, 3"""
    return f"""
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice AS o_totalprice, {outer}
FROM orders o LEFT JOIN (SELECT l_orderkey, {inner} FROM lineitem GROUP BY l_orderkey) a
  ON o.o_orderkey = a.l_orderkey"""


def _agg_query(prim: str):
    def fn(spark, sf_dir):
        li = V.table(spark, sf_dir, "lineitem").select(
            "l_orderkey", *_AGG_COLS, "l_returnflag", "l_linestatus",
            (F.col("l_returnflag") == "R").alias("is_returned"))
        orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey",
                                                         "o_totalprice")
        cats = ["l_returnflag", "l_linestatus"] if prim in ("num_unique", "mode") else []
        return synth.aggregate_features(li, orders, "l_orderkey", "o_orderkey", [prim],
                                        numeric=_AGG_COLS, boolean=["is_returned"],
                                        categorical=cats)
    fn.__name__ = f"q_agg_{prim}"
    return fn


for _p in synth.AGGREGATIONS:
    register(f"agg_{_p}", _agg_oracle(_p))(_agg_query(_p))


@register("agg_events", """
SELECT u.user_id, CAST(COUNT(e.event_id) AS BIGINT) AS count_rows,
       SUM(e.value) AS sum_value, AVG(e.value) AS mean_value,
       STDDEV_SAMP(e.value) AS std_value, MAX(e.value) AS max_value,
       MIN(e.value) AS min_value,
       AVG(CASE WHEN e.event_type = 'purchase' THEN 1e0 ELSE 0e0 END) AS percent_true_is_purchase
FROM (SELECT DISTINCT user_id FROM events) u JOIN events e ON u.user_id = e.user_id
GROUP BY u.user_id""")
def q_agg_events(spark, sf_dir):
    """D7 on the second relation: events grouped by user (the parent = distinct users)."""
    ev = V.table(spark, sf_dir, "events").select(
        "user_id", "value", (F.col("event_type") == "purchase").alias("is_purchase"))
    users = ev.select("user_id").distinct()
    return synth.aggregate_features(ev, users, "user_id", "user_id",
                                    ["count", "sum", "mean", "std", "max", "min", "percent_true"],
                                    numeric=["value"], boolean=["is_purchase"])
