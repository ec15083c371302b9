"""Cohort robustness and voxel tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.catalog.frames import A, SCORES, V, decisions, rounded, table, voxels
from equigauge.catalog.registry import registry
from equigauge.functions import clean
from equigauge.operators import cohort, quantiles, volumes
from equigauge.operators.frames import left_metadata, pending, register_absent
from equigauge.operators.volumes import LEVEL_INDEX

QUERIES, ORACLES, registered = registry()


def _scores(spark: SparkSession, folder: str) -> DataFrame:
    return volumes.overlap_scores(voxels(spark, folder), "patient", "pred", "truth", "prob")


@registered(f"""WITH {V}, {SCORES} SELECT patient, volume, round(confidence, 6) AS confidence, round(dice, 6) AS dice,
round(jaccard, 6) AS jaccard FROM s""")
def overlap_scores(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_scores(spark, folder))


def _cohort(spark: SparkSession, folder: str) -> DataFrame:
    """Scores with metadata: the label stands for the scanner and, by its remainders, for the other attributes."""
    meta = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("patient"), F.col("label").cast("string").alias("scanner"),
        F.when(F.col("vec_id") % 3 == 0, "F").otherwise("M").alias("sex"), (F.col("vec_id") % 90).cast("int").alias("age"),
        F.concat(F.lit("type_"), (F.col("vec_id") % 7).cast("string")).alias("diagnosis"),
        F.when(F.col("vec_id") % 2 == 0, "x").alias("lytic"), F.when(F.col("vec_id") % 5 == 0, "x").alias("blastic"),
    )
    return left_metadata(_scores(spark, folder), meta, "patient")


_COHORT = f"""{V}, {SCORES}, h AS (
  SELECT CAST(patient AS VARCHAR) AS patient, volume, confidence, dice, jaccard, CAST(label AS VARCHAR) AS scanner,
    CASE WHEN patient % 3 = 0 THEN 'F' ELSE 'M' END AS sex, CAST(patient % 90 AS INTEGER) AS age,
    'type_' || CAST(patient % 7 AS VARCHAR) AS diagnosis, CASE WHEN patient % 2 = 0 THEN 'x' END AS lytic,
    CASE WHEN patient % 5 = 0 THEN 'x' END AS blastic FROM s)"""

_NAMES = cohort.CohortColumns(
    score="dice", confidence="confidence", volume="volume", sex="sex", scanner="scanner", age="age",
    diagnosis="diagnosis", lesions=("lytic", "blastic"),
)

_KEYS = (
    "minority_sex_prop", "global_dice", "max_single_dice", "gender_gap", "min_scanner_dice", "small_vol_dice",
    "min_lesion_type_dice", "age_bias", "min_cancer_dice", "confidence_correlation",
)
METRICS_SQL = f"""g AS (SELECT avg(dice) AS d, max(dice) AS mx FROM h),
m AS (SELECT (SELECT min(n) / sum(n) FROM (SELECT count(*) AS n FROM h GROUP BY sex)) AS minority_sex_prop, g.d AS global_dice,
  g.mx AS max_single_dice,
  coalesce(abs((SELECT avg(dice) FROM h WHERE sex = 'M') - (SELECT avg(dice) FROM h WHERE sex = 'F')), 0.0) AS gender_gap,
  least(1.0, coalesce((SELECT min(x) FROM (SELECT avg(dice) AS x FROM h GROUP BY scanner HAVING count(*) > 5)), 1.0)) AS min_scanner_dice,
  (SELECT avg(dice) FROM h WHERE volume < (SELECT quantile_cont(volume, 0.25) FROM h)) AS small_vol_dice,
  least(1.0, (SELECT min(x) FROM (SELECT avg(dice) AS x FROM h WHERE lytic IS NOT NULL HAVING count(*) > 3 UNION ALL
     SELECT avg(dice) FROM h WHERE blastic IS NOT NULL HAVING count(*) > 3))) AS min_lesion_type_dice,
  coalesce((g.d - (SELECT avg(dice) FROM h WHERE age > 70 AND age <= 100)) / nullif(g.d, 0), 0.0) AS age_bias,
  least(1.0, (SELECT min(x) FROM (SELECT avg(dice) AS x, count(*) AS n, diagnosis FROM h GROUP BY diagnosis ORDER BY n DESC, diagnosis LIMIT 3))) AS min_cancer_dice,
  (SELECT corr(confidence, dice) FROM h) AS confidence_correlation FROM g)"""


def cohort_rows(spark: SparkSession, folder: str) -> DataFrame:
    return cohort.as_metric_rows(cohort.cohort_metrics(_cohort(spark, folder), _NAMES))


COHORT_SQL = f"""{_COHORT}, {METRICS_SQL}, u AS (
  SELECT metric_key, value FROM (SELECT {', '.join(f'CAST({k} AS DOUBLE) AS {k}' for k in _KEYS)} FROM m)
  UNPIVOT INCLUDE NULLS (value FOR metric_key IN ({', '.join(_KEYS)})))"""


@registered(f"WITH {COHORT_SQL} SELECT metric_key, round(value, 6) AS value FROM u")
def cohort_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cohort_rows(spark, folder))


@registered(f"""WITH {_COHORT} SELECT patient, volume, round(dice, 6) AS dice, scanner, sex, age FROM h""")
def cohort_with_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_cohort(spark, folder).select("patient", "volume", "dice", "scanner", "sex", "age"))


@registered(f"""WITH {_COHORT} SELECT round(least(1.0, coalesce(min(x), 1.0)), 6) AS floor, count(*) AS n_groups
FROM (SELECT avg(dice) AS x FROM h GROUP BY scanner HAVING count(*) > 5)""")
def group_floor(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cohort.group_floor(_cohort(spark, folder), "scanner", "dice"))


@registered("""SELECT count(*) AS n, count(DISTINCT source) AS n_sources FROM documents
WHERE source IN (SELECT source FROM documents GROUP BY source HAVING count(*) > 40)""")
def large_groups_only(spark: SparkSession, folder: str) -> DataFrame:
    return cohort.large_groups(table(spark, folder, "documents").select("doc_id", "source"), "source", 40).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("source").alias("n_sources")
    )


@registered(f"""WITH {_COHORT} SELECT diagnosis, count(*) AS n, round(avg(dice), 6) AS mean FROM h GROUP BY diagnosis
ORDER BY n DESC, diagnosis LIMIT 3""")
def top_groups(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cohort.top_groups(_cohort(spark, folder), "diagnosis", "dice"))


@registered(f"""WITH {_COHORT} SELECT flag, round(avg(dice), 6) AS mean, count(*) AS n FROM (SELECT 'lytic' AS flag, dice FROM h WHERE lytic IS NOT NULL
UNION ALL SELECT 'blastic', dice FROM h WHERE blastic IS NOT NULL) GROUP BY flag""")
def flag_means(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cohort.flag_means(_cohort(spark, folder), ["lytic", "blastic"], "dice"))


@registered(f"""WITH {_COHORT} SELECT coalesce((g - e) / nullif(g, 0) < 0.1, true) AS age_holds,
  (SELECT coalesce(bool_and(x >= 0.8), true) FROM (SELECT avg(dice) AS x, count(*) AS n, diagnosis FROM h GROUP BY diagnosis ORDER BY n DESC, diagnosis LIMIT 3)) AS types_hold
FROM (SELECT avg(dice) AS g, avg(CASE WHEN age > 70 AND age <= 100 THEN dice END) AS e FROM h)""")
def cohort_checks(spark: SparkSession, folder: str) -> DataFrame:
    rows = _cohort(spark, folder)
    types = cohort.top_groups_hold(rows, "diagnosis", "dice").scalar()
    return cohort.age_holds(rows, _NAMES).select(F.col("holds").alias("age_holds"), types.alias("types_hold"))


@registered(f"""WITH {_COHORT} SELECT round(regr_slope(dice, confidence), 6) AS slope, round(regr_intercept(dice, confidence), 6) AS intercept FROM h""")
def fit_line(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cohort.fit_line(_cohort(spark, folder), "confidence", "dice"))


_FIVE = """q AS (SELECT o_orderpriority, count(*) AS n, quantile_cont(o_totalprice, [0, 0.25, 0.5, 0.75, 1]) AS e FROM orders GROUP BY 1)"""


@registered(f"""WITH {_FIVE} SELECT q.o_orderpriority, any_value(q.n) AS n, round(any_value(e[1]), 4) AS lowest, round(any_value(e[2]), 4) AS q1,
  round(any_value(e[3]), 4) AS median, round(any_value(e[4]), 4) AS q3, round(any_value(e[5]), 4) AS highest,
  round(min(CASE WHEN o_totalprice >= e[2] - (e[4] - e[2]) * 1.5 THEN o_totalprice END), 4) AS whisker_low,
  round(max(CASE WHEN o_totalprice <= e[4] + (e[4] - e[2]) * 1.5 THEN o_totalprice END), 4) AS whisker_high
FROM q JOIN orders o ON o.o_orderpriority = q.o_orderpriority GROUP BY q.o_orderpriority""")
def five_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quantiles.five_numbers(table(spark, folder, "orders"), "o_orderpriority", "o_totalprice"), 4)


@registered("""SELECT count(*) AS n, round(quantile_cont(l_extendedprice, 0.1), 4) AS q_0, round(quantile_cont(l_extendedprice, 0.25), 4) AS q_1,
  round(quantile_cont(l_extendedprice, 0.5), 4) AS q_2, round(quantile_cont(l_extendedprice, 0.9), 4) AS q_3 FROM lineitem""")
def exact_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quantiles.exact_quantiles(table(spark, folder, "lineitem"), "l_extendedprice", [0.1, 0.25, 0.5, 0.9]), 4)


def _slices(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a series: one row per event, in the order of time."""
    return volumes.slice_index(
        table(spark, folder, "events").select(
            F.col("event_id").alias("uid"), F.col("user_id").alias("series"),
            (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).alias("position"),
        ),
        "series", "position", "uid",
    )


_SLICES = """sl AS (SELECT event_id AS uid, user_id AS series, epoch_us(ts) / 1000000 AS position,
  row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) / 1000000, event_id) - 1 AS slice FROM events)"""


@registered(f"WITH {_SLICES} SELECT uid, series, slice FROM sl")
def slice_index(spark: SparkSession, folder: str) -> DataFrame:
    return _slices(spark, folder).select("uid", "series", "slice")


@registered(f"""WITH {_SLICES}, mk AS (SELECT event_id + 1 AS uid, CAST(event_id % 4 AS INTEGER) AS x, CAST(event_id % 3 AS INTEGER) AS y, CASE WHEN value > 50 THEN 1 ELSE 0 END AS mask FROM events
  UNION ALL SELECT event_id, CAST(event_id % 4 AS INTEGER), CAST(event_id % 3 AS INTEGER), 1 FROM events WHERE value > 90)
SELECT series, mk.x, mk.y, slice AS z, max(mask) AS mask FROM mk JOIN sl ON sl.uid = mk.uid GROUP BY ALL""")
def mask_to_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Mask pixels that name their slice by its UID; one frame names a slice that does not exist."""
    e = table(spark, folder, "events")
    x, y = (F.col("event_id") % 4).cast("int").alias("x"), (F.col("event_id") % 3).cast("int").alias("y")
    first = e.select((F.col("event_id") + 1).alias("uid"), x, y, F.when(F.col("value") > 50, 1).otherwise(0).alias("mask"))
    second = e.filter("value > 90").select(F.col("event_id").alias("uid"), x, y, F.lit(1).alias("mask"))
    return volumes.mask_to_slices(first.unionByName(second), _slices(spark, folder), "uid", "series")


_GAPS = """p AS (SELECT user_id, epoch_us(ts) / 1000000 AS t FROM events),
z AS (SELECT user_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS gap, t FROM p)"""


@registered(f"""WITH {_GAPS}, g AS (SELECT user_id, count(*) AS n, (max(t) - min(t)) / nullif(count(*) - 1, 0) AS mean_gap, stddev_pop(gap) AS std_gap, min(gap) AS min_gap,
  max(gap) AS max_gap FROM z GROUP BY user_id HAVING count(*) > 1)
SELECT user_id, n, round(mean_gap, 3) AS mean_gap, round(std_gap, 3) AS std_gap, round(min_gap, 3) AS min_gap, round(max_gap, 3) AS max_gap,
  std_gap > 0.1 AS uneven, min_gap < 0.01 AS repeated FROM g""")
def gap_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(
        "user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).alias("t")
    )
    return rounded(volumes.spacing_stats(rows, "user_id", "t"), 3)


@registered("""SELECT user_id, count(*) AS n, round(coalesce(nullif(CASE WHEN count(*) > 1 THEN (max(epoch_us(ts)) - min(epoch_us(ts))) / 1000000 / (count(*) - 1) ELSE 1.0 END, 0), 1.0), 3) AS step
FROM events GROUP BY user_id""")
def mean_step(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(
        "user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).alias("t")
    )
    return rounded(volumes.mean_step(rows, "user_id", "t"), 3)


_FLIPS = """fl AS (SELECT * FROM (VALUES (0, 'original', false, false), (1, 'flip_y', false, true), (2, 'flip_x', true, false), (3, 'flip_xy', true, true)) t(flip_no, flip, fx, fy)),
k AS (SELECT m.patient, flip_no, flip, m.pos, CASE WHEN fx THEN 7 - m.x ELSE m.x END AS x, CASE WHEN fy THEN 7 - m.y ELSE m.y END AS y FROM v m CROSS JOIN fl WHERE m.truth = 1),
sc AS (SELECT k.patient, flip_no, any_value(flip) AS flip, count(d.patient) / count(*) AS score FROM k
  LEFT JOIN v d ON d.patient = k.patient AND d.x = k.x AND d.y = k.y AND d.prob * 1000 > 200 GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY patient ORDER BY score DESC, flip_no) AS rn FROM sc)"""


@registered(f"""WITH {V}, {_FLIPS} SELECT p.patient, coalesce(rk.flip_no, 0) AS flip_no, coalesce(rk.flip, 'original') AS flip, round(coalesce(rk.score, 0.0), 6) AS score,
  coalesce(rk.score, 0.0) < 0.3 AS low_overlap FROM (SELECT DISTINCT patient FROM v) p LEFT JOIN rk ON rk.patient = p.patient AND rk.rn = 1""")
def orient_best(spark: SparkSession, folder: str) -> DataFrame:
    """Dense tissue and mask packed in one read of the voxels."""
    masks = {"bone": F.col("prob") * 1000 > 200, "seg": F.col("truth") > 0}
    return rounded(volumes.flips_of(volumes.packed(voxels(spark, folder), "patient", masks), "patient"))


@registered(f"""WITH {V} SELECT round(avg((a.prob - b.prob) * (a.prob - b.prob)), 6) AS mse, count(*) AS n
FROM v a JOIN v b ON b.patient = a.patient - 1 AND b.pos = a.pos""")
def array_mse(spark: SparkSession, folder: str) -> DataFrame:
    """Each volume against its predecessor."""
    v = voxels(spark, folder)
    a = v.select("patient", "pos", F.col("prob").alias("value"))
    b = v.select((F.col("patient") + 1).alias("patient"), "pos", F.col("prob").alias("value"))
    return rounded(volumes.squared_difference(a, b, ["patient", "pos"]))


@registered(f"""WITH {V}, q AS (SELECT patient, pos, CASE WHEN pred = 1 THEN prob ELSE 0.0 END AS val FROM v),
st AS (SELECT patient, avg(CASE WHEN val <> 0 THEN val END) AS m, CASE WHEN stddev_pop(CASE WHEN val <> 0 THEN val END) = 0 THEN 1.0 ELSE stddev_pop(CASE WHEN val <> 0 THEN val END) END AS sd FROM q GROUP BY patient),
zz AS (SELECT q.patient, pos, CASE WHEN val <> 0 THEN (val - m) / sd ELSE 0.0 END AS z FROM q JOIN st USING (patient)),
ex AS (SELECT patient, min(z) AS lo, max(z) AS hi FROM zz GROUP BY patient)
SELECT zz.patient, pos, round(CASE WHEN hi = lo THEN -z + 0.0 ELSE (z - lo) / (hi - lo) * 2 - 1 END, 6) + 0.0 AS normalized FROM zz JOIN ex USING (patient)""")
def normalize_volume(spark: SparkSession, folder: str) -> DataFrame:
    v = voxels(spark, folder).select("patient", "pos", F.when(F.col("pred") == 1, F.col("prob")).otherwise(0.0).alias("val"))
    out = volumes.normalized(v, "patient", "val").select("patient", "pos", "normalized")
    return rounded(out).withColumn("normalized", F.col("normalized") + 0.0)


_LEVELS = ", ".join(f"({i}, '{k}', {v})" for i, (k, v) in enumerate(LEVEL_INDEX.items()))


@registered(f"""WITH lv AS (SELECT * FROM (VALUES {_LEVELS}) t(ord, name, idx)),
tx AS (SELECT vec_id, CASE vec_id % 4 WHEN 0 THEN 't' || (vec_id % 13) || ' vertebra' WHEN 1 THEN 'L' || (vec_id % 7) || ' level'
  WHEN 2 THEN 'sacrum' ELSE 'rib c' || (vec_id % 9) END AS label FROM embeddings)
SELECT vec_id, label, (SELECT idx FROM lv WHERE regexp_matches(upper(label), '\\b' || name || '\\b') ORDER BY ord LIMIT 1) AS class_index FROM tx""")
def label_index(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("vec_id")

    def text(*parts):
        return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])

    label = (
        F.when(i % 4 == 0, text("t", (i % 13).cast("string"), " vertebra"))
        .when(i % 4 == 1, text("L", (i % 7).cast("string"), " level"))
        .when(i % 4 == 2, F.lit("sacrum")).otherwise(text("rib c", (i % 9).cast("string")))
    )
    rows = table(spark, folder, "embeddings").select("vec_id", label.alias("label"))
    return rows.withColumn("class_index", volumes.label_index("label"))


@registered("""SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best,
  CASE WHEN list_position(embedding, list_max(embedding)) - 1 BETWEEN 18 AND 41 OR list_position(embedding, list_max(embedding)) - 1 = 92 THEN 1 ELSE 0 END AS in_spine FROM embeddings""")
def class_of_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Best class of each score vector, and whether it belongs to the spine."""
    rows = table(spark, folder, "embeddings").select("vec_id", clean.argmax_index("embedding").alias("best"))
    return rows.withColumn("in_spine", volumes.spine_mask("best"))


@registered(f"""WITH {V}, {SCORES}, done AS (SELECT patient FROM s WHERE dice > 0.65)
SELECT CAST(vec_id AS VARCHAR) AS patient, label FROM embeddings WHERE vec_id NOT IN (SELECT patient FROM done)""")
def resume_pending(spark: SparkSession, folder: str) -> DataFrame:
    """Patients without a stored result."""
    done = _scores(spark, folder).filter("dice > 0.65")
    todo = table(spark, folder, "embeddings").select(F.col("vec_id").alias("patient"), "label")
    return pending(todo, done, "patient")


@registered("""WITH ex AS (SELECT DISTINCT source AS name, 'SOURCE' AS kind FROM documents WHERE doc_id % 3 = 0)
SELECT name, kind FROM ex UNION ALL SELECT name, kind FROM (SELECT DISTINCT source AS name, 'NEW' AS kind FROM documents) n WHERE name NOT IN (SELECT name FROM ex)""")
def register_missing(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    known = d.filter("doc_id % 3 = 0").select(F.col("source").alias("name")).distinct().withColumn("kind", F.lit("SOURCE"))
    return register_absent(known, d.select(F.col("source").alias("name")).distinct().withColumn("kind", F.lit("NEW")))


@registered(f"""WITH {A} SELECT source AS patient, min(CAST(row_key AS VARCHAR)) AS first_path, count(*) AS n_files FROM a GROUP BY source""")
def first_file(spark: SparkSession, folder: str) -> DataFrame:
    files = decisions(spark, folder).select(F.col("source").alias("patient"), F.col("row_key").cast("string").alias("path"))
    return volumes.first_file(files, "patient", "path")
