"""Metric queries: flattening, rollups, histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..operators import histograms as H
from ..operators import metrics as M
from ..operators import rollups as R
from . import adapters as A
from .book import cte, joined, query

SERIES = "name, service_name, metric_type"


def texts(*columns: str) -> dict:
    return {c: joined(c) for c in columns}


@query(
    "flatten_metrics",
    """SELECT name, 'demo metric' AS description, '1' AS unit, service_name, metric_timestamp, metric_type,
       round(value, 6) AS value, histogram_count, round(histogram_sum, 6) AS histogram_sum,
       round(histogram_min, 6) AS histogram_min, round(histogram_max, 6) AS histogram_max,
       array_to_string(histogram_buckets, ',') AS histogram_buckets,
       array_to_string(histogram_bounds, ',') AS histogram_bounds,
       exp_histogram_count, round(exp_histogram_sum, 6) AS exp_histogram_sum,
       round(exp_histogram_min, 6) AS exp_histogram_min, round(exp_histogram_max, 6) AS exp_histogram_max,
       CAST(exp_histogram_scale AS BIGINT) AS exp_histogram_scale, exp_histogram_zero_count,
       CASE WHEN metric_type = 'exponential_histogram' THEN ((l_suppkey % 7) - 3) || ':' || half || ',' || quarter END AS positive,
       CASE WHEN metric_type = 'exponential_histogram' THEN '-2:' || rest END AS negative,
       summary_count, round(summary_sum, 6) AS summary_sum,
       CAST(CASE WHEN metric_type = 'summary' THEN 2 END AS BIGINT) AS quantile_count,
       concat_ws('/', l_orderkey, l_partkey, l_linenumber) AS line
    FROM metrics""",
    uses=("metrics",),
)
def _(spark, d):
    def bucket(c):
        return F.concat(F.col(f"{c}.offset"), F.lit(":"), joined(f"{c}.bucket_counts"))

    return A.metrics(spark, d).select(
        "name", "description", "unit", "service_name", "metric_timestamp", "metric_type", "value",
        "histogram_count", "histogram_sum", "histogram_min", "histogram_max",
        joined("histogram_buckets").alias("histogram_buckets"),
        joined("histogram_bounds").alias("histogram_bounds"),
        "exp_histogram_count", "exp_histogram_sum", "exp_histogram_min", "exp_histogram_max",
        "exp_histogram_scale", "exp_histogram_zero_count",
        bucket("exp_histogram_positive_bucket").alias("positive"),
        bucket("exp_histogram_negative_bucket").alias("negative"),
        "summary_count", "summary_sum",
        F.when(F.col("summary_quantiles").isNotNull(), F.size("summary_quantiles")).alias("quantile_count"),
        F.col("attributes")["line"].alias("line"),
    )


@query(
    "flatten_metrics_by_type",
    """SELECT name, 'demo metric' AS description, '1' AS unit, service_name, metric_timestamp,
       round(CASE WHEN metric_type = 'histogram' THEN l_extendedprice / nullif(q, 0) ELSE value END, 8) AS value,
       metric_type AS metric_type_detail,
       CASE WHEN metric_type = 'sum' THEN l_linenumber > 1 END AS is_monotonic,
       CASE WHEN metric_type = 'sum' THEN 'CUMULATIVE' END AS aggregation_temporality,
       histogram_count, round(histogram_sum, 6) AS histogram_sum, round(histogram_min, 6) AS histogram_min,
       round(histogram_max, 6) AS histogram_max, array_to_string(histogram_buckets, ',') AS bucket_counts,
       array_to_string(histogram_bounds, ',') AS explicit_bounds
    FROM metrics WHERE metric_type IN ('gauge', 'sum', 'histogram')""",
    uses=("metrics",),
    digits={"value": 8},
)
def _(spark, d):
    flat = M.flatten_metrics_by_type(A.raw_metrics(spark, d))
    return flat.withColumns(texts("bucket_counts", "explicit_bounds")).drop("metric_attributes")


@query(
    "of_type",
    f"SELECT {SERIES}, metric_timestamp, round(value, 6) AS value FROM metrics WHERE metric_type IN ('gauge', 'sum')",
    uses=("metrics",),
)
def _(spark, d):
    return P.of_type(A.metrics(spark, d), "gauge", "sum").select(
        "name", "service_name", "metric_type", "metric_timestamp", "value"
    )


@query(
    "dedup_metrics",
    f"""SELECT DISTINCT {SERIES}, metric_timestamp,
       concat_ws('/', l_orderkey, l_partkey, l_linenumber) AS line, delay_s, round(value, 6) AS value, histogram_count,
       round(histogram_sum, 6) AS histogram_sum, array_to_string(histogram_buckets, ',') AS histogram_buckets, exp_histogram_count,
       exp_histogram_zero_count, summary_count, round(summary_sum, 6) AS summary_sum FROM metrics""",
    uses=("metrics",),
)
def _(spark, d):
    flat, a = A.metrics(spark, d), F.col("attributes")
    points = flat.withColumns({"line": a["line"], "delay_s": a["delay_s"].cast("bigint")})
    return M.dedup_metrics(points, order_by=M.point_order(flat)).select(
        "name", "service_name", "metric_type", "metric_timestamp", "line", "delay_s", "value", "histogram_count", "histogram_sum",
        F.array_join("histogram_buckets", ",").alias("histogram_buckets"), "exp_histogram_count", "exp_histogram_zero_count",
        "summary_count", "summary_sum",
    )


@query(
    "dedup_metrics_coarse",
    f"SELECT DISTINCT {SERIES}, metric_timestamp FROM metrics",
    uses=("metrics",),
)
def _(spark, d):
    return M.dedup_metrics(A.metrics(spark, d), by_attributes=False).select(*M.DEDUP_KEYS)


def rollup_sql(step: str, types: str = "'gauge', 'sum'", extra: str = "") -> str:
    return f"""SELECT {SERIES}, time_bucket(INTERVAL '{step}', metric_timestamp) AS window_start,
       time_bucket(INTERVAL '{step}', metric_timestamp) + INTERVAL '{step}' AS window_end,
       count(*) AS sample_count, avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value,
       sum(value) AS sum_value{extra}
    FROM metrics WHERE metric_type IN ({types}) GROUP BY 1, 2, 3, 4, 5"""


cte("rollup1", rollup_sql("1 minute"), ("metrics",))
for _step, _name in (("5 minutes", "rollup5"), ("1 hour", "rollup60")):
    cte(
        _name,
        f"""SELECT {SERIES}, time_bucket(INTERVAL '{_step}', window_start) AS window_start,
           time_bucket(INTERVAL '{_step}', window_start) + INTERVAL '{_step}' AS window_end,
           CAST(sum(sample_count) AS BIGINT) AS sample_count, avg(avg_value) AS avg_value,
           min(min_value) AS min_value, max(max_value) AS max_value, sum(sum_value) AS sum_value
        FROM rollup1 GROUP BY 1, 2, 3, 4, 5""",
        ("rollup1",),
    )

ROLLUP_COLUMNS = f"""{SERIES}, window_start, window_end, sample_count, round(avg_value, 6) AS avg_value,
       round(min_value, 6) AS min_value, round(max_value, 6) AS max_value, round(sum_value, 6) AS sum_value"""


def rollup1(spark, d):
    return R.metrics_rollup(A.metrics(spark, d), "1 minute")


@query("metrics_rollup", f"SELECT {ROLLUP_COLUMNS} FROM rollup1", uses=("rollup1",))
def _(spark, d):
    return rollup1(spark, d)


for _step, _name in (("5 minutes", "5min"), ("1 hour", "hourly")):

    @query(
        f"metrics_rollup_{_name}_percentiles",
        f"""SELECT {ROLLUP_COLUMNS}, round(p50, 6) AS p50_value, round(p95, 6) AS p95_value, round(p99, 6) AS p99_value
        FROM ({rollup_sql(_step, "'gauge', 'sum'", ''', quantile_disc(value, 0.5) AS p50,
        quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99''')})""",
        uses=("metrics",),
    )
    def _(spark, d, step=_step):
        return R.metrics_rollup(A.metrics(spark, d), step, percentiles=True)


for _step, _name, _key in (("5 minutes", "rollup5", "rerollup"), ("1 hour", "rollup60", "rerollup_hourly")):

    @query(
        _key,
        f"SELECT {ROLLUP_COLUMNS}, round(sum_value / sample_count, 6) AS weighted_avg_value FROM {_name}",
        uses=(_name,),
    )
    def _(spark, d, step=_step):
        return R.rerollup(rollup1(spark, d), step)


@query("register_rollup_views", f"SELECT {ROLLUP_COLUMNS} FROM rollup5", uses=("rollup5",))
def _(spark, d):
    from ..sinks import register_rollup_views

    register_rollup_views(spark, rollup1(spark, d))
    return spark.table("metrics_5min_rollup_view").drop("weighted_avg_value")


@query(
    "latest_windows",
    f"SELECT {ROLLUP_COLUMNS} FROM rollup5 ORDER BY window_start DESC, name, service_name, metric_type LIMIT 100",
    uses=("rollup5",),
)
def _(spark, d):
    return R.latest_windows(R.rerollup(rollup1(spark, d), "5 minutes").drop("weighted_avg_value"))


@query(
    "metric_rollups_hourly",
    """SELECT name, service_name, date_trunc('hour', metric_timestamp) AS hour, round(avg(value), 6) AS avg_value,
       round(min(value), 6) AS min_value, round(max(value), 6) AS max_value,
       round(stddev_samp(value), 6) AS stddev_value, count(*) AS sample_count
    FROM metrics GROUP BY 1, 2, 3""",
    uses=("metrics",),
)
def _(spark, d):
    return R.metric_rollups_hourly(A.metrics(spark, d), None)


DISTRIBUTION_SQL = f"""SELECT {SERIES}, time_bucket(INTERVAL '1 minute', metric_timestamp) AS window_start,
       time_bucket(INTERVAL '1 minute', metric_timestamp) + INTERVAL '1 minute' AS window_end,
       CAST(sum(q) AS BIGINT) AS total_count, sum(l_extendedprice) AS total_sum,
       sum(l_extendedprice) / nullif(sum(q), 0) AS avg_value,
       min(coalesce(histogram_min, exp_histogram_min)) AS min_value,
       max(coalesce(histogram_max, exp_histogram_max)) AS max_value,
       min(histogram_bounds) AS histogram_bounds,
       min(histogram_bounds) <> max(histogram_bounds) AS bounds_mismatch,
       CAST(min(exp_histogram_scale) AS BIGINT) AS exp_histogram_scale,
       CAST(sum(exp_histogram_zero_count) AS BIGINT) AS exp_histogram_zero_count_sum,
       coalesce(list_sort(list(array_to_string(histogram_buckets, ',')) FILTER (histogram_buckets IS NOT NULL)), []) AS bucket_texts,
       count(*) FILTER (metric_type = 'exponential_histogram') AS exp_samples,
       count(*) FILTER (metric_type = 'summary') AS quantile_samples_count
    FROM metrics WHERE metric_type IN ('histogram', 'exponential_histogram', 'summary') GROUP BY 1, 2, 3, 4, 5"""
cte("distributions", DISTRIBUTION_SQL, ("metrics",))

DISTRIBUTION_COLUMNS = f"""{SERIES}, window_start, window_end, total_count, round(total_sum, 6) AS total_sum,
       round(avg_value, 9) AS avg_value, round(min_value, 6) AS min_value, round(max_value, 6) AS max_value,
       array_to_string(histogram_bounds, ',') AS histogram_bounds, bounds_mismatch, exp_histogram_scale,
       exp_histogram_zero_count_sum, array_to_string(bucket_texts, ';') AS buckets,
       exp_samples AS positive_samples, exp_samples AS negative_samples, quantile_samples_count"""


def distributions(spark, d, **options):
    return R.histogram_rollup(A.metrics(spark, d), "1 minute", **options)


def _distribution_texts(rollup):
    lists = F.transform("histogram_buckets_list", lambda b: F.array_join(F.transform(b, lambda n: n.cast("string")), ","))
    return rollup.select(
        "name", "service_name", "metric_type", "window_start", "window_end", "total_count", "total_sum", "avg_value",
        "min_value", "max_value", joined("histogram_bounds").alias("histogram_bounds"), "bounds_mismatch",
        "exp_histogram_scale", "exp_histogram_zero_count_sum", lists.alias("_buckets"),
        F.size("exp_histogram_positive_bucket_list").alias("positive_samples"),
        F.size("exp_histogram_negative_bucket_list").alias("negative_samples"),
        F.size("summary_quantiles_list").alias("quantile_samples_count"),
    )


@query("histogram_rollup", f"SELECT {DISTRIBUTION_COLUMNS} FROM distributions", uses=("distributions",), digits={"avg_value": 9})
def _(spark, d):
    out = _distribution_texts(distributions(spark, d))
    return out.withColumn("buckets", F.array_join(F.array_sort("_buckets"), ";")).drop("_buckets")


# Two rows for every group, put together again.
@query("histogram_rollup_in_parts", f"SELECT {DISTRIBUTION_COLUMNS} FROM distributions", uses=("distributions",), digits={"avg_value": 9})
def _(spark, d):
    out = _distribution_texts(distributions(spark, d, parts=2))
    lists = ["_buckets", "positive_samples", "negative_samples", "quantile_samples_count"]
    return out.groupBy(*[c for c in out.columns if c not in lists]).agg(
        F.array_join(F.array_sort(F.flatten(F.collect_list("_buckets"))), ";").alias("buckets"),
        *[F.sum(c).alias(c) for c in lists[1:]],
    )


@query(
    "histogram_rollup_profile",
    f"""SELECT {SERIES}, window_start, CAST(0 AS BIGINT) AS part, total_count, round(avg_value, 9) AS avg_value,
       CAST(len(bucket_texts) AS BIGINT) AS bucket_samples_count, quantile_samples_count FROM distributions""",
    uses=("distributions",),
    digits={"avg_value": 9},
)
def _(spark, d):
    return R.histogram_rollup_profile(distributions(spark, d))


MERGED_SQL = """SELECT name, service_name, date_trunc('hour', metric_timestamp) AS window_start,
       histogram_bounds AS bounds, count(*) AS point_count, CAST(sum(q) AS BIGINT) AS total_count,
       sum(l_extendedprice) AS total_sum, min(histogram_min) AS min_value, max(histogram_max) AS max_value,
       CAST(sum(half) FILTER (histogram_buckets IS NOT NULL) AS BIGINT) AS b0,
       CAST(sum(quarter) FILTER (histogram_buckets IS NOT NULL) AS BIGINT) AS b1,
       CAST(sum(rest) FILTER (histogram_buckets IS NOT NULL) AS BIGINT) AS b2
    FROM metrics WHERE metric_type = 'histogram' GROUP BY 1, 2, 3, 4"""
cte("merged", MERGED_SQL, ("metrics",))


@query(
    "merge_histograms",
    """SELECT name, service_name, window_start, array_to_string(bounds, ',') AS bounds, point_count, total_count,
       round(total_sum, 6) AS total_sum, round(min_value, 6) AS min_value, round(max_value, 6) AS max_value,
       CASE WHEN b0 IS NULL THEN '' ELSE b0 || ',' || b1 || ',' || b2 END AS buckets FROM merged""",
    uses=("merged",),
)
def _(spark, d):
    return H.merge_histograms(A.metrics(spark, d)).withColumns(texts("bounds", "buckets"))


def _quantile_sql(q: float, name: str) -> str:
    # Three buckets over two bounds: [min, 10], (10, 50], (50, max].
    r = f"({q} * (b0 + b1 + b2))"
    return f"""CASE WHEN len(bounds) <> 2 OR b0 IS NULL OR b0 + b1 + b2 = 0 THEN NULL
       WHEN b0 > 0 AND b0 >= {r} THEN min_value + (10 - min_value) * {r} / b0
       WHEN b1 > 0 AND b0 + b1 >= {r} THEN 10 + 40 * ({r} - b0) / b1
       ELSE 50 + (max_value - 50) * ({r} - b0 - b1) / b2 END AS {name}"""


@query(
    "histogram_quantile",
    f"""SELECT name, service_name, window_start, bounds, round(p50_value, 6) AS p50_value,
       round(p95_value, 6) AS p95_value, round(p99_value, 6) AS p99_value FROM (
         SELECT name, service_name, window_start, array_to_string(bounds, ',') AS bounds,
         {_quantile_sql(0.5, 'p50_value')}, {_quantile_sql(0.95, 'p95_value')}, {_quantile_sql(0.99, 'p99_value')}
         FROM merged)""",
    uses=("merged",),
)
def _(spark, d):
    out = H.histogram_percentiles(H.merge_histograms(A.metrics(spark, d)))
    return out.select(
        "name", "service_name", "window_start", joined("bounds").alias("bounds"), "p50_value", "p95_value", "p99_value"
    )


@query(
    "merge_exp_histograms",
    """, base AS (
      SELECT *, date_trunc('hour', metric_timestamp) AS window_start,
             min(exp_histogram_scale) OVER (PARTITION BY name, service_name, date_trunc('hour', metric_timestamp)) AS min_scale
      FROM metrics WHERE metric_type = 'exponential_histogram'
    ), cells AS (
      SELECT name, service_name, window_start, 'p' AS side,
             CAST(floor(((l_suppkey % 7) - 3) / power(2.0, exp_histogram_scale - min_scale)) AS BIGINT) AS idx, half AS n FROM base
      UNION ALL SELECT name, service_name, window_start, 'p',
             CAST(floor(((l_suppkey % 7) - 2) / power(2.0, exp_histogram_scale - min_scale)) AS BIGINT), quarter FROM base
      UNION ALL SELECT name, service_name, window_start, 'n',
             CAST(floor(-2 / power(2.0, exp_histogram_scale - min_scale)) AS BIGINT), rest FROM base
    ), summed AS (
      SELECT name, service_name, window_start, side, idx, sum(n) AS n FROM cells GROUP BY ALL HAVING sum(n) > 0
    ), sides AS (
      SELECT name, service_name, window_start,
             string_agg(idx || '=' || n, ',' ORDER BY idx) FILTER (side = 'p') AS positive,
             string_agg(idx || '=' || n, ',' ORDER BY idx) FILTER (side = 'n') AS negative
      FROM summed GROUP BY ALL
    ), totals AS (
      SELECT name, service_name, window_start, CAST(min(exp_histogram_scale) AS BIGINT) AS scale, count(*) AS point_count,
             CAST(sum(q) AS BIGINT) AS total_count, round(sum(l_extendedprice), 6) AS total_sum,
             CAST(sum(exp_histogram_zero_count) AS BIGINT) AS zero_count,
             round(min(exp_histogram_min), 6) AS min_value, round(max(exp_histogram_max), 6) AS max_value
      FROM base GROUP BY ALL
    )
    SELECT t.*, coalesce(positive, '') AS positive, coalesce(negative, '') AS negative
    FROM totals t LEFT JOIN sides s USING (name, service_name, window_start)""",
    uses=("metrics",),
)
def _(spark, d):
    def cells(c):
        return F.array_join(F.transform(c, lambda b: F.concat(b["idx"], F.lit("="), b["n"])), ",")

    out = H.merge_exp_histograms(A.metrics(spark, d))
    return out.withColumns({"positive": cells("positive"), "negative": cells("negative")})


QUANTILES_SQL = """SELECT name, service_name, {window} quantile, count(*) AS point_count, {mean}
       round(min(v), 6) AS min_value, round(max(v), 6) AS max_value
    FROM (SELECT name, service_name, date_trunc('hour', metric_timestamp) AS window_start, 0.5::DOUBLE AS quantile, l_extendedprice / 2 AS v
          FROM metrics WHERE metric_type = 'summary'
          UNION ALL
          SELECT name, service_name, date_trunc('hour', metric_timestamp), 0.99::DOUBLE, l_extendedprice
          FROM metrics WHERE metric_type = 'summary') GROUP BY ALL"""


@query(
    "summary_quantiles",
    QUANTILES_SQL.format(window="window_start,", mean="round(avg(v), 6) AS avg_value,"),
    uses=("metrics",),
)
def _(spark, d):
    return H.summary_quantiles(A.metrics(spark, d))


@query("rollup_quantiles", QUANTILES_SQL.format(window="", mean=""), uses=("metrics",))
def _(spark, d):
    return H.rollup_quantiles(distributions(spark, d))


# Over the whole time range of the table.
@query(
    "rollup_gaps",
    """, series AS (SELECT DISTINCT name, service_name FROM rollup1),
    spine AS (SELECT name, service_name, unnest(generate_series((SELECT min(window_start) FROM rollup1),
              (SELECT max(window_start) FROM rollup1), INTERVAL 1 MINUTE)) AS expected_window_start FROM series)
    SELECT name, service_name, expected_window_start, 'MISSING' AS status FROM spine s
    WHERE NOT EXISTS (SELECT 1 FROM rollup1 i WHERE i.name = s.name AND i.service_name = s.service_name AND i.window_start = s.expected_window_start)""",
    uses=("rollup1",),
)
def _(spark, d):
    return R.rollup_gaps(rollup1(spark, d))


@query(
    "missing_buckets",
    """SELECT name, service_name, metric_timestamp, histogram_count FROM metrics
    WHERE metric_type = 'histogram' AND (histogram_buckets IS NULL OR histogram_bounds IS NULL OR histogram_count IS NULL)""",
    uses=("metrics",),
)
def _(spark, d):
    return P.missing_buckets(A.metrics(spark, d)).select(
        "name", "service_name", "metric_timestamp", "histogram_count"
    )


@query(
    "laggards",
    f"""SELECT {SERIES}, metric_timestamp, round(delay_s / 60.0, 2) AS lag_minutes FROM metrics WHERE delay_s > 300""",
    uses=("metrics",),
)
def _(spark, d):
    late = P.laggards(A.metrics_with_arrival(spark, d), "metric_timestamp", "ingestion_timestamp", 300)
    return late.select("name", "service_name", "metric_type", "metric_timestamp", "lag_minutes")
