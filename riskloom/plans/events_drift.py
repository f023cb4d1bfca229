"""Drift queries on the ``events`` flow: reference = first 70 % by ``(ts, event_id)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.stats import round6
from riskloom.operators.drift import CURRENT, REFERENCE, DriftAnalysis, long_values
from riskloom.operators.drift_state import DriftState
from riskloom.operators.splits import reference_current
from riskloom.session import scratch_path
from riskloom.sources.tables import event_features, table

EVENT_DRIFT_FEATURES = ["value", "k", "uid"]


def event_drift(spark: SparkSession, sf_dir: str, **kw) -> DriftAnalysis:
    ev = event_features(spark, sf_dir)
    sided = reference_current(ev, ["ts", "event_id"])
    # Their oracles state the series, at every size.
    return DriftAnalysis(long_values(sided, EVENT_DRIFT_FEATURES), ks_law="series", **kw)


def q_quantile_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_drift(spark, sf_dir).quantile_edges()
    return e.select(
        "feature", F.col("q_index").cast("long").alias("q_index"), round6(F.col("q")).alias("q"),
        round6(F.col("quantile")).alias("quantile"),
    )


def q_psi_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = event_drift(spark, sf_dir).psi_bins()
    return b.select("feature", F.col("bin").cast("long").alias("bin"), "n_ref", "n_cur")


def q_psi_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_drift(spark, sf_dir).psi().select("feature", round6(F.col("psi")).alias("psi"))


def q_ks_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = event_drift(spark, sf_dir).ks()
    return k.select(
        "feature", round6(F.col("ks_stat")).alias("ks_stat"), round6(F.col("ks_pvalue")).alias("ks_pvalue"),
        F.col("n_ref").cast("long").alias("n_ref"), F.col("n_cur").cast("long").alias("n_cur"),
    )


def q_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_drift(spark, sf_dir).report()
    return r.select(
        "feature", round6(F.col("psi")).alias("psi"), round6(F.col("ks_stat")).alias("ks_stat"),
        round6(F.col("ks_pvalue")).alias("ks_pvalue"), "drifted",
    )


def q_drift_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_drift(spark, sf_dir).rollup()
    return r.select(
        "any_drift", F.col("n_drifted").cast("long").alias("n_drifted"),
        F.col("n_features").cast("long").alias("n_features"), "drifted_features", "summary",
    )


def q_ks_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances of one market segment against all others, per nation: small samples, exact law."""
    side = F.when(F.col("c_mktsegment") == "BUILDING", REFERENCE).otherwise(CURRENT)
    long = table(spark, sf_dir, "customer").select(side.alias("side"), F.col("c_nationkey").cast("string").alias("feature"), F.col("c_acctbal").cast("double").alias("x"))
    k = DriftAnalysis(long.where("x IS NOT NULL")).ks()
    return k.select("feature", round6(F.col("ks_stat")).alias("ks_stat"), round6(F.col("ks_pvalue")).alias("ks_pvalue"), "n_ref", "n_cur")


DRIFT_DAYS = 0.7


def q_drift_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of the last 30 % of the days against the others, from kept counts: filled by two updates, the second with the newest days."""
    ev = event_features(spark, sf_dir).withColumn("day", F.to_date("ts"))
    days = [r["day"] for r in ev.select("day").where("day IS NOT NULL").distinct().orderBy("day").collect()]  # the calendar
    cut_day = days[min(int(len(days) * DRIFT_DAYS), len(days) - 1)] if days else None
    state = DriftState(spark, scratch_path(spark, "drift-state"))
    old = F.col("day") < F.lit(days[-1]) if days else F.lit(True)
    state.update(ev.where(old), "day", EVENT_DRIFT_FEATURES)
    state.update(ev.where(~old), "day", EVENT_DRIFT_FEATURES)
    r = state.analysis(F.col("batch") < F.lit(str(cut_day)), F.col("batch") >= F.lit(str(cut_day)), ks_law="series").report()
    return r.select(
        "feature", round6(F.col("psi")).alias("psi"), round6(F.col("ks_stat")).alias("ks_stat"),
        round6(F.col("ks_pvalue")).alias("ks_pvalue"), "drifted",
    )


# ---------------------------------------------------------------------------------------
# DuckDB oracles. Shared CTE: sides by position, long form, per-feature null drop.
EVENT_SIDES_SQL = """
base AS (
  SELECT value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, CAST(user_id AS DOUBLE) AS uid,
         row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, count(*) OVER () AS n
  FROM events
),
sided AS (
  SELECT *, CASE WHEN pos < CAST(floor(CAST(n AS DOUBLE) * CAST(0.7 AS DOUBLE)) AS BIGINT) THEN 0 ELSE 1 END AS side
  FROM base
),
vals AS (
  SELECT * FROM (
    SELECT side, 'value' AS feature, value AS x FROM sided
    UNION ALL SELECT side, 'k', k FROM sided
    UNION ALL SELECT side, 'uid', uid FROM sided
  ) WHERE x IS NOT NULL AND NOT isnan(x)
),
sizes AS (
  SELECT feature, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS n_ref, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS n_cur
  FROM vals GROUP BY feature
),
qs AS (
  SELECT feature, quantile_cont(x, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS qs
  FROM vals WHERE side = 0 GROUP BY feature
),
edges AS (
  SELECT feature, len(list_distinct(qs)) AS m,
         CASE WHEN len(list_distinct(qs)) >= 3
              THEN list_sort(list_distinct(qs))[2:len(list_distinct(qs)) - 1]
              ELSE CAST([] AS DOUBLE[]) END AS inner_edges
  FROM qs
),
binned AS (
  SELECT v.feature, v.side, len(list_filter(e.inner_edges, lambda b: b <= v.x)) AS bin
  FROM vals v JOIN edges e USING (feature)
),
grid AS (SELECT feature, unnest(range(0, m - 1)) AS bin FROM edges WHERE m >= 2),
cnt AS (
  SELECT feature, bin, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS n_ref, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS n_cur
  FROM binned GROUP BY feature, bin
),
pbins AS (
  SELECT g.feature, g.bin, coalesce(c.n_ref, 0) AS n_ref, coalesce(c.n_cur, 0) AS n_cur
  FROM grid g LEFT JOIN cnt c USING (feature, bin)
),
psi AS (
  SELECT s.feature,
         CASE WHEN s.n_ref = 0 OR s.n_cur = 0 THEN NULL ELSE coalesce(t.psi, 0.0) END AS psi
  FROM sizes s LEFT JOIN (
    SELECT p.feature,
           sum((greatest(p.n_cur / s2.n_cur, 1e-6) - greatest(p.n_ref / s2.n_ref, 1e-6))
               * ln(greatest(p.n_cur / s2.n_cur, 1e-6) / greatest(p.n_ref / s2.n_ref, 1e-6))) AS psi
    FROM pbins p JOIN sizes s2 USING (feature) GROUP BY p.feature
  ) t USING (feature)
),
cnts AS (
  SELECT feature, x, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS c_ref, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS c_cur
  FROM vals GROUP BY feature, x
),
cdf AS (
  SELECT feature,
         sum(c_ref) OVER (PARTITION BY feature ORDER BY x ROWS UNBOUNDED PRECEDING) AS cr,
         sum(c_cur) OVER (PARTITION BY feature ORDER BY x ROWS UNBOUNDED PRECEDING) AS cc
  FROM cnts
),
ks0 AS (
  SELECT s.feature, s.n_ref, s.n_cur, max(abs(c.cr / s.n_ref - c.cc / s.n_cur)) AS ks_stat
  FROM sizes s JOIN cdf c USING (feature) GROUP BY s.feature, s.n_ref, s.n_cur
),
ks AS (
  SELECT feature, n_ref, n_cur, ks_stat,
         (sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) + 0.12
          + 0.11 / sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur))) * ks_stat AS lam
  FROM ks0
),
ksp AS (
  SELECT feature, n_ref, n_cur, ks_stat,
         CASE WHEN lam < 0.2 THEN 1.0
              ELSE least(greatest(2.0 * list_sum(list_transform(range(1, 101),
                     lambda j: pow(-1.0, j - 1) * exp(-2.0 * j * j * lam * lam))), 0.0), 1.0) END AS ks_pvalue
  FROM ks
),
report AS (
  SELECT p.feature, p.psi, k.ks_stat, k.ks_pvalue, (p.psi > 0.2 OR k.ks_pvalue < 0.05) AS drifted
  FROM psi p JOIN ksp k USING (feature)
)
"""


def _with(select: str) -> str:
    return "WITH " + EVENT_DRIFT_CTE_BODY + "\n" + select


EVENT_DRIFT_CTE_BODY = EVENT_SIDES_SQL.strip()

#: The share of lattice paths that stay under the observed gap, diagonal by diagonal.
KS_EXACT_SQL = """WITH RECURSIVE
vals AS (SELECT CAST(c_nationkey AS VARCHAR) AS feature, c_mktsegment = 'BUILDING' AS ref, CAST(c_acctbal AS DOUBLE) AS x FROM customer WHERE c_acctbal IS NOT NULL),
sizes AS (SELECT feature, count(*) FILTER (ref) AS m, count(*) FILTER (NOT ref) AS n FROM vals GROUP BY feature),
steps AS (SELECT feature, x, count(*) FILTER (ref) AS a, count(*) FILTER (NOT ref) AS b FROM vals GROUP BY feature, x),
run AS (SELECT feature, sum(a) OVER w AS a, sum(b) OVER w AS b FROM steps WINDOW w AS (PARTITION BY feature ORDER BY x)),
stat AS (SELECT feature, m, n, max(abs(a / CAST(m AS DOUBLE) - b / CAST(n AS DOUBLE))) AS d FROM run JOIN sizes USING (feature) WHERE m > 0 AND n > 0 GROUP BY ALL),
par AS (SELECT *, m // gcd(m, n) AS ma, n // gcd(m, n) AS nb, CAST(round(d * (m // gcd(m, n)) * n) AS BIGINT) AS h FROM stat),
walk AS (
  SELECT feature, CAST(0 AS BIGINT) AS s, CAST(0 AS BIGINT) AS i, CAST(1 AS DOUBLE) AS u FROM par
  UNION ALL
  SELECT feature, s, i, sum(u) AS u FROM (
    SELECT w.feature, w.s + 1 AS s, w.i + t.t AS i, w.u * (CASE t.t WHEN 1 THEN w.i + 1 ELSE w.s + 1 - w.i END) / CAST(w.s + 1 AS DOUBLE) AS u, p.*EXCLUDE (feature)
    FROM walk w JOIN par p USING (feature), (VALUES (0), (1)) t(t) WHERE w.s < p.m + p.n)
  WHERE i <= m AND s - i <= n AND abs(i * nb - (s - i) * ma) < h GROUP BY feature, s, i)
SELECT s.feature, round(p.d, 6) AS ks_stat,
 round(CASE WHEN p.feature IS NULL THEN NULL WHEN p.h = 0 THEN 1.0 ELSE 1 - coalesce(w.u, 0) END, 6) AS ks_pvalue, s.m AS n_ref, s.n AS n_cur
FROM sizes s LEFT JOIN par p USING (feature) LEFT JOIN walk w ON w.feature = p.feature AND w.s = p.m + p.n AND w.i = p.m"""

#: The sides by day instead of by position.
DAY_SIDES_SQL = EVENT_DRIFT_CTE_BODY.replace(
    "row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, count(*) OVER () AS n", "CAST(ts AS DATE) AS day"
).replace(
    "CASE WHEN pos < CAST(floor(CAST(n AS DOUBLE) * CAST(0.7 AS DOUBLE)) AS BIGINT) THEN 0 ELSE 1 END AS side",
    "CASE WHEN day < (SELECT list_sort(list(DISTINCT day))[least(CAST(floor(count(DISTINCT day) * CAST(0.7 AS DOUBLE)) AS BIGINT), count(DISTINCT day) - 1) + 1] FROM base) THEN 0 ELSE 1 END AS side",
)

ORACLES = {
    "ks_exact": KS_EXACT_SQL,
    "drift_incremental": "WITH " + DAY_SIDES_SQL
    + " SELECT feature, round(psi, 6) AS psi, round(ks_stat, 6) AS ks_stat, round(ks_pvalue, 6) AS ks_pvalue, drifted FROM report",
    "quantile_edges": _with(
        "SELECT feature, CAST(i - 1 AS BIGINT) AS q_index, round((i - 1) / 10.0, 6) AS q, round(qs[i], 6) AS quantile "
        "FROM qs, range(1, 12) r(i)"
    ),
    "psi_bins": _with("SELECT feature, CAST(bin AS BIGINT) AS bin, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur FROM pbins"),
    "psi_report": _with("SELECT feature, round(psi, 6) AS psi FROM psi"),
    "ks_report": _with(
        "SELECT feature, round(ks_stat, 6) AS ks_stat, round(ks_pvalue, 6) AS ks_pvalue, "
        "CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur FROM ksp"
    ),
    "drift_report": _with(
        "SELECT feature, round(psi, 6) AS psi, round(ks_stat, 6) AS ks_stat, round(ks_pvalue, 6) AS ks_pvalue, drifted FROM report"
    ),
    "drift_rollup": _with(
        "SELECT any_drift, n_drifted, n_features, drifted_features, "
        "CASE WHEN any_drift THEN printf('DRIFT detected in %d/%d features: %s.', n_drifted, n_features, drifted_features) "
        "ELSE printf('No relevant drift in %d features.', n_features) END AS summary FROM ("
        "SELECT coalesce(bool_or(coalesce(drifted, false)), false) AS any_drift, "
        "CAST(sum(CASE WHEN coalesce(drifted, false) THEN 1 ELSE 0 END) AS BIGINT) AS n_drifted, "
        "CAST(count(*) AS BIGINT) AS n_features, "
        "coalesce(array_to_string(list_sort(list(feature) FILTER (WHERE coalesce(drifted, false))), ', '), '') AS drifted_features "
        "FROM report)"
    ),
}

QUERIES = {
    "ks_exact": q_ks_exact,
    "drift_incremental": q_drift_incremental,
    "quantile_edges": q_quantile_edges,
    "psi_bins": q_psi_bins,
    "psi_report": q_psi_report,
    "ks_report": q_ks_report,
    "drift_report": q_drift_report,
    "drift_rollup": q_drift_rollup,
}
