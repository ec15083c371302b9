"""Cleaning, binning, data quality and privacy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.catalog.frames import A, C, KEYS, customers, decisions, rounded, table
from equigauge.catalog.registry import registry
from equigauge.functions import bins, clean
from equigauge.operators import privacy, quality
from equigauge.operators.frames import bind_roles, drop_known, numeric_columns, reattach, side_by_side

QUERIES, ORACLES, registered = registry()


@registered(f"""WITH {C} SELECT (SELECT count(*) FROM c) AS n_rows,
  CAST(sum(CASE WHEN x IS NOT NULL AND trim(x) <> '' THEN 1 ELSE 0 END) AS BIGINT) AS filled, 4 * (SELECT count(*) FROM c) AS cells,
  round(sum(CASE WHEN x IS NOT NULL AND trim(x) <> '' THEN 1 ELSE 0 END) / (4 * (SELECT count(*) FROM c)), 6) AS completeness
FROM (SELECT unnest([c_mktsegment, r_name, CAST(c_acctbal AS VARCHAR), CAST(target AS VARCHAR)]) AS x FROM c)""")
def completeness(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.completeness(customers(spark, folder), ["c_mktsegment", "r_name", "c_acctbal", "target"]))


@registered(f"""WITH {C}, f AS (SELECT count(DISTINCT target) = 2 AS two FROM c)
SELECT 'column:target' AS check_name, true AS passed, CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'column:c_acctbal', true, 0 UNION ALL SELECT 'column:income', false, 1
UNION ALL SELECT 'binary:target', two, CASE WHEN two THEN 0 ELSE 1 END FROM f
UNION ALL SELECT 'filled:target', count(*) = 0, count(*) FROM c WHERE target IS NULL
UNION ALL SELECT 'filled:c_acctbal', count(*) = 0, count(*) FROM c WHERE c_acctbal IS NULL
UNION ALL SELECT 'range:c_acctbal', count(*) = 0, count(*) FROM c WHERE NOT (c_acctbal > 0)
UNION ALL SELECT 'range:o_totalprice', count(*) = 0, count(*) FROM c WHERE NOT (o_totalprice > 0)""")
def integrity_checks(spark: SparkSession, folder: str) -> DataFrame:
    return quality.integrity(
        customers(spark, folder), ["target", "c_acctbal", "income"], "target", {"c_acctbal": 0, "o_totalprice": 0}
    )


@registered(f"""WITH {C} SELECT count(*) AS n_rows, round(1 - 2 / 11, 6) AS data_minimization FROM c""")
def minimization(spark: SparkSession, folder: str) -> DataFrame:
    """The measure comes from the schema alone; the row count shows what it was taken over."""
    c = customers(spark, folder)
    share = privacy.data_minimization(c, ["c_acctbal", "o_totalprice", "income"])
    return rounded(c.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(share).alias("data_minimization")))


_K = ", ".join(KEYS)


@registered(f"""WITH {C}, g AS (SELECT count(*) AS n FROM c GROUP BY {_K})
SELECT min(n) AS k, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows FROM g""")
def k_anonymity(spark: SparkSession, folder: str) -> DataFrame:
    return privacy.k_anonymity(customers(spark, folder), KEYS)


@registered(f"""WITH {C}, g AS (SELECT count(DISTINCT r_name) AS l, count(*) AS n FROM c GROUP BY {_K})
SELECT min(l) AS l, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows FROM g""")
def l_diversity(spark: SparkSession, folder: str) -> DataFrame:
    return privacy.l_diversity(customers(spark, folder), KEYS, "r_name")


@registered(f"""WITH {C}, tot AS (SELECT r_name AS s, count(*) / (SELECT count(*) FROM c) AS q FROM c GROUP BY 1),
g AS (SELECT {_K}, count(*) AS n FROM c GROUP BY {_K}), x AS (SELECT {_K}, r_name AS s, count(*) AS m FROM c GROUP BY {_K}, r_name),
grid AS (SELECT g.*, tot.s, tot.q FROM g CROSS JOIN tot),
d AS (SELECT {', '.join('grid.' + k for k in KEYS)}, any_value(grid.n) AS n, 0.5 * sum(abs(coalesce(x.m, 0) / grid.n - grid.q)) AS dist
  FROM grid LEFT JOIN x ON {' AND '.join(f'x.{k} = grid.{k}' for k in KEYS)} AND x.s = grid.s GROUP BY {', '.join('grid.' + k for k in KEYS)})
SELECT round(max(dist), 6) AS t, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows FROM d""")
def t_closeness(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(privacy.t_closeness(customers(spark, folder), KEYS, "r_name"))


@registered(f"""WITH {C}, tot AS (SELECT n_nationkey AS s, count(*) / (SELECT count(*) FROM c) AS q FROM c GROUP BY 1),
g AS (SELECT {_K}, count(*) AS n FROM c GROUP BY {_K}), x AS (SELECT {_K}, n_nationkey AS s, count(*) AS m FROM c GROUP BY {_K}, n_nationkey),
grid AS (SELECT g.*, tot.s, tot.q FROM g CROSS JOIN tot),
j AS (SELECT {', '.join('grid.' + k for k in KEYS)}, grid.n, grid.s, sum(coalesce(x.m, 0) / grid.n - grid.q)
    OVER (PARTITION BY {', '.join('grid.' + k for k in KEYS)} ORDER BY grid.s) AS cum
  FROM grid LEFT JOIN x ON {' AND '.join(f'x.{k} = grid.{k}' for k in KEYS)} AND x.s = grid.s),
d AS (SELECT {_K}, any_value(n) AS n, sum(abs(cum)) / ((SELECT count(*) FROM tot) - 1) AS dist FROM j GROUP BY {_K})
SELECT round(max(dist), 6) AS t, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows FROM d""")
def t_closeness_ordered(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(privacy.t_closeness(customers(spark, folder), KEYS, "n_nationkey", ordered=True))


@registered("""SELECT c_custkey, CASE WHEN c_acctbal > -1000 AND c_acctbal <= 0 THEN 'debt' WHEN c_acctbal > 0 AND c_acctbal <= 5000 THEN 'middle'
  WHEN c_acctbal > 5000 AND c_acctbal <= 9000 THEN 'high' END AS band,
  CASE WHEN c_acctbal > -1000 AND c_acctbal <= 0 THEN 1 WHEN c_acctbal > 0 AND c_acctbal <= 5000 THEN 2
  WHEN c_acctbal > 5000 AND c_acctbal <= 9000 THEN 3 END AS band_no FROM customer""")
def bins_fixed(spark: SparkSession, folder: str) -> DataFrame:
    """Values above the last edge have no band."""
    edges = [-1000, 0, 5000, 9000]
    return table(spark, folder, "customer").select(
        "c_custkey", bins.cut("c_acctbal", edges, ["debt", "middle", "high"]).alias("band"),
        bins.cut_index("c_acctbal", edges).alias("band_no"),
    )


@registered("""SELECT c_custkey, CAST(least(greatest(ceil((c_acctbal - lo) / ((hi - lo) / 5.0)), 1), 5) AS INTEGER) AS bin
FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)""")
def bins_equal_width(spark: SparkSession, folder: str) -> DataFrame:
    return bins.equal_width(table(spark, folder, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 5).drop("c_acctbal")


@registered("""SELECT c_custkey, CASE WHEN c_acctbal <= e[2] THEN 1 WHEN c_acctbal <= e[3] THEN 2 WHEN c_acctbal <= e[4] THEN 3 ELSE 4 END AS bin
FROM customer, (SELECT quantile_cont(c_acctbal, [0, 0.25, 0.5, 0.75, 1]) AS e FROM customer) WHERE c_acctbal IS NOT NULL""")
def bins_quantile(spark: SparkSession, folder: str) -> DataFrame:
    return bins.equal_count(table(spark, folder, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 4).drop("c_acctbal")


@registered(f"""WITH {C}, e AS (SELECT quantile_cont(c_acctbal, [0, 0.25, 0.5, 0.75, 1]) AS e FROM c),
r AS (SELECT CASE WHEN c_acctbal <= e[2] THEN 1 WHEN c_acctbal <= e[3] THEN 2 WHEN c_acctbal <= e[4] THEN 3 ELSE 4 END AS bin, target FROM c, e)
SELECT round(min(rate), 6) AS value, CAST(sum(n) AS BIGINT) AS n_rows FROM (SELECT bin, count(*) AS n, count(*) FILTER (target = 1) / count(*) AS rate FROM r GROUP BY bin)""")
def quantile_group_min_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Least positive rate over quartile groups of a numeric dimension."""
    rates = quality.group_positive_rates(customers(spark, folder), "target", "c_acctbal", "quantiles", 4)
    return rounded(quality.smallest_positive_rate(rates))


@registered("""SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) AS k, CASE WHEN value = 0 THEN 0.0 ELSE coalesce(value, 0.0) END AS safe_value,
  CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS is_click, CASE WHEN event_type IN ('click', 'view') THEN 'light' ELSE 'heavy' END AS weight_class,
  CASE event_type WHEN 'click' THEN 'C' WHEN 'error' THEN 'E' ELSE 'Unknown' END AS code, CASE WHEN lower(trim(event_type)) = 'error' THEN 1 ELSE 0 END AS failed,
  lpad(CAST(user_id % 120 AS VARCHAR), 3, '0') || 'Y' AS age_text, CAST(user_id % 120 AS INTEGER) AS age,
  event_type || '_' || CAST(user_id % 3 AS VARCHAR) AS composite FROM events""")
def recode_clean(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaning expressions in one projection."""
    e = table(spark, folder, "events")
    text = F.concat(F.lpad((F.col("user_id") % 120).cast("string"), 3, "0"), F.lit("Y"))
    return e.select(
        "event_id",
        clean.to_number(F.get_json_object("props", "$.k")).alias("k"),
        clean.safe_float("value").alias("safe_value"),
        clean.binary_label("event_type", "click").alias("is_click"),
        clean.by_membership("event_type", ["click", "view"], "light", "heavy").alias("weight_class"),
        clean.by_mapping("event_type", {"click": "C", "error": "E"}).alias("code"),
        clean.equals_text("event_type", "error").alias("failed"),
        text.alias("age_text"), clean.age_in_years(text).alias("age"),
        clean.group_key("event_type", (F.col("user_id") % 3).cast("string")).alias("composite"),
    )


@registered("""SELECT doc_id, coalesce(nullif(trim(lang), ''), 'Unknown') AS lang_clean,
  CASE WHEN n_chars * 0.001 + 1 > 2.5 THEN 1 ELSE 0 END AS long_text, CAST(coalesce(n_chars * 0.5 + 10.0, 0.0) AS DOUBLE) AS scaled FROM documents""")
def text_defaults(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    return d.select(
        "doc_id", clean.trimmed_text("lang").alias("lang_clean"),
        clean.above(F.col("n_chars") * F.lit(0.001) + 1, 2.5).alias("long_text"),
        clean.rescaled("n_chars", 0.5, 10.0).alias("scaled"),
    )


@registered("""SELECT doc_id, lang, n_chars, quality AS target FROM documents JOIN labels USING (doc_id)""")
def features_with_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Features and labels side by side by key, under role names, the text dropped."""
    joined = side_by_side(table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id")
    return bind_roles(drop_known(joined, ["text", "absent"]), {"target": "quality"}, ["doc_id", "lang", "n_chars"])


@registered(f"""WITH {A}, p AS (SELECT row_key, prediction FROM a)
SELECT p.row_key, p.prediction, d.lang, d.source FROM p JOIN documents d ON d.doc_id = p.row_key""")
def reattach_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Protected attributes back on scored rows."""
    scored = decisions(spark, folder).select("row_key", "prediction")
    source = table(spark, folder, "documents").withColumnRenamed("doc_id", "row_key")
    return reattach(scored, source, "row_key", ["lang", "source"])


@registered("""SELECT n_rows, column_name, CAST(missing AS BIGINT) AS missing FROM (
SELECT count(*) AS n_rows, count(*) FILTER (o_custkey IS NULL) AS o_custkey, count(*) FILTER (o_totalprice IS NULL) AS o_totalprice,
  count(*) FILTER (o_orderkey IS NULL) AS o_orderkey FROM orders) UNPIVOT (missing FOR column_name IN (o_custkey, o_totalprice, o_orderkey))""")
def missing_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Empty cells of the numeric columns."""
    o = table(spark, folder, "orders")
    return quality.missing_by_column(o, numeric_columns(o))


@registered("""WITH l AS (SELECT unnest(['c_mktsegment', 'c_name']) AS column_name, unnest([c_mktsegment, c_name]) AS value FROM customer),
k AS (SELECT column_name, value, count(*) AS n FROM l WHERE value IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rn FROM k)
SELECT column_name, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_distinct, max(CASE WHEN rn = 1 THEN value END) AS top, max(CASE WHEN rn = 1 THEN n END) AS top_n
FROM r GROUP BY column_name""")
def describe_text(spark: SparkSession, folder: str) -> DataFrame:
    return quality.describe_columns(table(spark, folder, "customer"), ["c_mktsegment", "c_name"])
