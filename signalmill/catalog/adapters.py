"""The generic test tables read as raw telemetry.

events    -> spans: eight consecutive events form one trace, a binary tree of
             calls; and log records: one per event.
lineitem  -> metric points: every row is one point, of one of the five types.

Each adapter is a single projection, so its output grows with the table and no
group is ever gathered. The SQL next to it says the same for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.logs import flatten_logs
from ..operators.metrics import flatten_metrics
from ..operators.spans import flatten_spans
from ..functions.columns import conform
from ..schemas import METRIC_TYPES, struct
from ..session import tune

# The end of the events table's month; lookbacks count from here.
AS_OF = "2024-01-31 00:00:00"
AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _attrs(values: dict[str, Column]) -> Column:
    entries = []
    for name, value in values.items():
        entries += [F.lit(name), value]
    return F.create_map(*entries)


def _conform(df: DataFrame, signal: str) -> DataFrame:
    return conform(df, struct(signal))


def spans_of(events: DataFrame) -> DataFrame:
    """Raw spans of an events frame, batch or stream."""
    e = F.col
    base = F.call_function("div", e("event_id"), F.lit(8))
    slot = e("event_id") % 8
    start = F.unix_micros(e("ts").cast("timestamp")) * 1000 + 999
    parent = (
        F.when(slot == 0, F.when(e("event_type") == "signup", "").otherwise(F.lit(None)))
        .when(e("value") > 150, F.concat(F.lit("lost-"), e("event_id")))
        .otherwise(F.concat(F.lit("s"), base * 8 + F.call_function("div", slot - 1, F.lit(2))))
    )
    status = F.when(
        e("user_id") % 10 != 3,
        F.struct(
            F.when(e("value") > 100, e("props")).alias("message"),
            F.when(e("value") > 100, "ERROR").otherwise("OK").alias("code"),
        ),
    )
    attributes = _attrs({
        "http.method": F.when(e("user_id") % 4 != 0, F.when(e("user_id") % 4 == 1, "POST").otherwise("GET")),
        "http.route": F.when(e("value") >= 5, F.concat(F.lit("/"), e("event_type"), F.lit("/"), e("user_id") % 20)),
        "http.url": F.concat(F.lit("https://shop.example/"), e("event_type")),
        "http.target": F.concat(F.lit("/"), e("event_type")),
        "rpc.service": F.concat(F.lit("rpc."), e("event_type")),
        "rpc.method": F.lit("Call"),
        "peer.service": F.when(slot > 0, F.concat(F.lit("svc-"), e("event_type"))),
        "http.status_code": F.when(e("value") > 100, "500").when(e("value") < 1, "abc").otherwise("200"),
        "rpc.grpc.status_code": (e("user_id") % 17).cast("string"),
    })
    events_list = F.when(
        e("value") > 100,
        F.array(
            F.struct(
                start.alias("time_unix_nano"), F.lit("exception").alias("name"),
                F.create_map(F.lit("exception.message"), e("props")).alias("attributes"),
                F.lit(0).alias("dropped_attributes_count"),
            )
        ),
    )
    resource = F.struct(
        _attrs({
            "service.name": F.when(e("user_id") % 50 != 0, F.concat(F.lit("svc-"), e("event_type"))),
            "service.version": F.concat(F.lit("1."), e("user_id") % 3),
            "telemetry.sdk.language": F.lit("python"),
            "telemetry.sdk.name": F.lit("opentelemetry"),
            "telemetry.sdk.version": F.lit("1.30"),
        }).alias("attributes"),
        F.lit(0).alias("dropped_attributes_count"),
    )
    raw = events.select(
        F.concat(F.lit("t"), base).alias("trace_id"),
        F.concat(F.lit("s"), e("event_id")).alias("span_id"),
        parent.alias("parent_span_id"),
        F.concat(e("event_type"), F.lit(".handle")).alias("name"),
        F.when(slot == 0, "SERVER").otherwise("CLIENT").alias("kind"),
        start.alias("start_time_unix_nano"),
        (start + F.round(e("value") * 1e6).cast("bigint")).alias("end_time_unix_nano"),
        attributes.alias("attributes"),
        events_list.alias("events"),
        status.alias("status"),
        resource.alias("resource"),
        F.struct(
            F.lit("demo").alias("name"), F.lit("0.1").alias("version"),
            F.lit(None).cast("map<string,string>").alias("attributes"),
            F.lit(0).alias("dropped_attributes_count"),
        ).alias("instrumentation_scope"),
    )
    return _conform(raw, "spans")


def logs_of(events: DataFrame) -> DataFrame:
    """Raw log records of an events frame, batch or stream."""
    e = F.col
    micros = F.unix_micros(e("ts").cast("timestamp"))
    traced = e("user_id") % 10 != 0
    raw = events.select(
        F.concat(e("event_type"), F.lit(".log")).alias("event_name"),
        F.when(traced, F.concat(F.lit("t"), F.call_function("div", e("event_id"), F.lit(8)))).alias("trace_id"),
        F.when(
            traced,
            F.when(e("event_type") == "signup", F.concat(F.lit("gone-"), e("event_id"))).otherwise(
                F.concat(F.lit("s"), e("event_id"))
            ),
        ).alias("span_id"),
        ((micros + 5_000) * 1000).alias("time_unix_nano"),
        ((micros + 1_000_000) * 1000).alias("observed_time_unix_nano"),
        F.when(e("value") > 100, "17").when(e("event_type") == "error", "x").otherwise("9").alias("severity_number"),
        F.when(e("value") > 100, "ERROR").otherwise("INFO").alias("severity_text"),
        F.concat(e("event_type"), F.lit(" "), e("props")).alias("body"),
        _attrs({"user.id": e("user_id").cast("string")}).alias("attributes"),
        F.struct(
            _attrs({
                "service.name": F.when(e("user_id") % 50 != 0, F.concat(F.lit("svc-"), e("event_type"))),
                "service.version": F.concat(F.lit("1."), e("user_id") % 3),
            }).alias("attributes"),
            F.lit(0).alias("dropped_attributes_count"),
        ).alias("resource"),
    )
    return _conform(raw, "logs")


def metrics_of(lineitem: DataFrame) -> DataFrame:
    """Raw metric points of a lineitem frame, batch or stream, with the fields the operators read."""
    c = F.col
    micros = F.unix_micros(F.lit("2024-01-01").cast("timestamp")) + (c("l_orderkey") % 172_800) * 15_000_000
    kind = F.get(F.array(*[F.lit(t) for t in METRIC_TYPES]), (c("l_partkey") % 5).cast("int"))
    quantity = c("l_quantity").cast("bigint")
    half = F.call_function("div", quantity, F.lit(2))
    quarter = F.call_function("div", quantity, F.lit(4))
    attributes = _attrs({
        "line": F.concat_ws("/", c("l_orderkey"), c("l_partkey"), c("l_linenumber")),
        "delay_s": F.round(c("l_tax") * 100 * 60).cast("int").cast("string"),
    })
    common = {"time_unix_nano": micros * 1000, "attributes": attributes}
    price = c("l_extendedprice")
    buckets = F.when(c("l_tax") > 0, F.array(half, quarter, quantity - half - quarter))
    bounds = F.when(c("l_discount") > 0.09, F.array(F.lit(10.0), F.lit(50.0), F.lit(90.0))).otherwise(
        F.array(F.lit(10.0), F.lit(50.0))
    )

    def only(name: str, **fields: Column) -> Column:
        return F.when(kind == name, F.struct(*[v.alias(n) for n, v in fields.items()])).alias(name)

    raw = lineitem.select(
        F.concat(F.lit("m."), F.lower("l_returnflag"), F.lower("l_linestatus")).alias("name"),
        F.lit("demo metric").alias("description"),
        F.lit("1").alias("unit"),
        kind.alias("metric_type"),
        only("gauge", **common, value=price),
        only(
            "sum", **common, value=c("l_quantity"), aggregation_temporality=F.lit("CUMULATIVE"),
            is_monotonic=c("l_linenumber") > 1,
        ),
        only(
            "histogram", **common, count=quantity, sum=price, bucket_counts=buckets, explicit_bounds=bounds,
            min=c("l_tax"), max=c("l_quantity") * 10,
        ),
        only(
            "exponential_histogram", **common, count=quantity, sum=price,
            scale=c("l_linenumber") % 3, zero_count=c("l_partkey") % 4,
            positive_bucket=F.struct(
                ((c("l_suppkey") % 7) - 3).cast("int").alias("offset"), F.array(half, quarter).alias("bucket_counts")
            ),
            negative_bucket=F.struct(
                F.lit(-2).alias("offset"), F.array(quantity - half - quarter).alias("bucket_counts")
            ),
            min=-c("l_quantity"), max=c("l_quantity"),
        ),
        only(
            "summary", **common, count=quantity, sum=price,
            quantile_values=F.array(
                F.struct(F.lit(0.5).alias("quantile"), (price / 2).alias("value")),
                F.struct(F.lit(0.99).alias("quantile"), price.alias("value")),
            ),
        ),
        F.struct(
            _attrs({"service.name": F.concat(F.lit("svc-"), c("l_suppkey") % 7)}).alias("attributes"),
            F.lit(0).alias("dropped_attributes_count"),
        ).alias("resource"),
    )
    return raw


def raw_spans(spark: SparkSession, d: str) -> DataFrame:
    return spans_of(table(spark, d, "events"))


def raw_logs(spark: SparkSession, d: str) -> DataFrame:
    return logs_of(table(spark, d, "events"))


def raw_metrics(spark: SparkSession, d: str) -> DataFrame:
    return metrics_of(table(spark, d, "lineitem"))


def spans(spark: SparkSession, d: str) -> DataFrame:
    return flatten_spans(raw_spans(spark, d))


def wide_spans(spark: SparkSession, d: str) -> DataFrame:
    return flatten_spans(raw_spans(spark, d), wide=True)


def logs(spark: SparkSession, d: str) -> DataFrame:
    return flatten_logs(raw_logs(spark, d))


def metrics(spark: SparkSession, d: str) -> DataFrame:
    return flatten_metrics(raw_metrics(spark, d))


def metrics_with_arrival(spark: SparkSession, d: str) -> DataFrame:
    """Flat metrics whose arrival time is taken from the data."""
    delay = F.col("attributes")["delay_s"].cast("int")
    arrival = F.timestamp_add("SECOND", delay, F.col("metric_timestamp"))
    return metrics(spark, d).withColumn("ingestion_timestamp", arrival)


SPANS_SQL = """
spans AS (
  SELECT 't' || (event_id // 8) AS trace_id,
         's' || event_id AS span_id,
         CASE WHEN event_id % 8 = 0 THEN NULL
              WHEN value > 150 THEN 'lost-' || event_id
              ELSE 's' || ((event_id // 8) * 8 + (event_id % 8 - 1) // 2) END AS parent_span_id,
         event_type || '.handle' AS name,
         CASE WHEN event_id % 8 = 0 THEN 'SERVER' ELSE 'CLIENT' END AS kind,
         CASE WHEN user_id % 50 <> 0 THEN 'svc-' || event_type END AS service_name,
         ts AS start_timestamp,
         ts + to_microseconds(CAST(round(value * 1000) AS BIGINT)) AS end_timestamp,
         value AS duration_ms,
         (value > 100 AND user_id % 10 <> 3) AS is_error,
         CASE WHEN value > 100 AND user_id % 10 <> 3 THEN props END AS status_message,
         CASE WHEN user_id % 4 = 0 THEN NULL WHEN user_id % 4 = 1 THEN 'POST' ELSE 'GET' END AS http_method,
         CASE WHEN value >= 5 THEN '/' || event_type || '/' || (user_id % 20) END AS http_route,
         CASE WHEN value > 100 THEN 500 WHEN value < 1 THEN NULL ELSE 200 END AS http_status_code,
         'https://shop.example/' || event_type AS http_url,
         '/' || event_type AS http_target,
         'rpc.' || event_type AS rpc_service,
         user_id % 17 AS rpc_grpc_status_code,
         CASE WHEN event_id % 8 > 0 THEN 'svc-' || event_type END AS peer_service,
         '1.' || (user_id % 3) AS service_version
  FROM events
)"""

LOGS_SQL = """
logs AS (
  SELECT event_type || '.log' AS event_name,
         CASE WHEN user_id % 10 <> 0 THEN 't' || (event_id // 8) END AS trace_id,
         CASE WHEN user_id % 10 <> 0
              THEN CASE WHEN event_type = 'signup' THEN 'gone-' || event_id ELSE 's' || event_id END END AS span_id,
         ts + INTERVAL 5 MILLISECONDS AS log_timestamp,
         ts + INTERVAL 1 SECOND AS observed_timestamp,
         CASE WHEN value > 100 THEN '17' WHEN event_type = 'error' THEN 'x' ELSE '9' END AS severity_number,
         CASE WHEN value > 100 THEN 'ERROR' ELSE 'INFO' END AS severity_text,
         event_type || ' ' || props AS body,
         CASE WHEN user_id % 50 <> 0 THEN 'svc-' || event_type END AS service_name,
         '1.' || (user_id % 3) AS service_version
  FROM events
)"""

METRICS_SQL = """
points AS (
  SELECT 'm.' || lower(l_returnflag) || lower(l_linestatus) AS name,
         'svc-' || (l_suppkey % 7) AS service_name,
         TIMESTAMP '2024-01-01' + to_seconds((l_orderkey % 172800) * 15) AS metric_timestamp,
         list_extract(['gauge', 'sum', 'histogram', 'exponential_histogram', 'summary'], CAST(l_partkey % 5 AS INTEGER) + 1) AS metric_type,
         CAST(l_quantity AS BIGINT) AS q,
         CAST(l_quantity AS BIGINT) // 2 AS half,
         CAST(l_quantity AS BIGINT) // 4 AS quarter,
         CAST(l_quantity AS BIGINT) - CAST(l_quantity AS BIGINT) // 2 - CAST(l_quantity AS BIGINT) // 4 AS rest,
         CAST(round(l_tax * 100 * 60) AS BIGINT) AS delay_s,
         l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem
),
metrics AS (
  SELECT *,
         CASE metric_type WHEN 'gauge' THEN l_extendedprice WHEN 'sum' THEN l_quantity END AS value,
         CASE WHEN metric_type = 'histogram' THEN q END AS histogram_count,
         CASE WHEN metric_type = 'histogram' THEN l_extendedprice END AS histogram_sum,
         CASE WHEN metric_type = 'histogram' THEN l_tax END AS histogram_min,
         CASE WHEN metric_type = 'histogram' THEN l_quantity * 10 END AS histogram_max,
         CASE WHEN metric_type = 'histogram' AND l_tax > 0 THEN [half, quarter, rest] END AS histogram_buckets,
         CASE WHEN metric_type = 'histogram'
              THEN CASE WHEN l_discount > 0.09 THEN [10.0, 50.0, 90.0] ELSE [10.0, 50.0] END END::DOUBLE[] AS histogram_bounds,
         CASE WHEN metric_type = 'exponential_histogram' THEN q END AS exp_histogram_count,
         CASE WHEN metric_type = 'exponential_histogram' THEN l_extendedprice END AS exp_histogram_sum,
         CASE WHEN metric_type = 'exponential_histogram' THEN -l_quantity END AS exp_histogram_min,
         CASE WHEN metric_type = 'exponential_histogram' THEN l_quantity END AS exp_histogram_max,
         CASE WHEN metric_type = 'exponential_histogram' THEN l_linenumber % 3 END AS exp_histogram_scale,
         CASE WHEN metric_type = 'exponential_histogram' THEN l_partkey % 4 END AS exp_histogram_zero_count,
         CASE WHEN metric_type = 'summary' THEN q END AS summary_count,
         CASE WHEN metric_type = 'summary' THEN l_extendedprice END AS summary_sum,
         metric_timestamp + to_seconds(delay_s) AS ingestion_timestamp
  FROM points
)"""


def nested_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_of(table(spark, sf_dir, "events"))


def nested_of(events: DataFrame) -> DataFrame:
    """Flat spans of an events frame, batch or stream, whose times overlap as calls do: eight consecutive events a trace, a binary tree of calls.

    Some parents are lost; some spans are each other's parents.
    """
    e = F.col
    base, slot = F.call_function("div", e("event_id"), F.lit(8)), e("event_id") % 8
    parent = (
        F.when(slot == 0, F.lit(None))
        .when(e("value") > 200, F.concat(F.lit("lost-"), e("event_id")))
        .when((slot == 1) & (e("event_type") == "signup"), F.concat(F.lit("s"), base * 8 + 3))
        .otherwise(F.concat(F.lit("s"), base * 8 + F.call_function("div", slot - 1, F.lit(2))))
    )
    start = F.lit(1_704_067_200_000_000) + base * 10_000_000 + slot * 20_000 + (e("user_id") % 5) * 15_000
    end = start + (8 - slot) * 20_000 + F.round(e("value") * 1000).cast("bigint")
    return events.select(
        F.concat(F.lit("t"), base).alias("trace_id"),
        F.concat(F.lit("s"), e("event_id")).alias("span_id"),
        parent.alias("parent_span_id"),
        F.concat(e("event_type"), F.lit(".handle")).alias("name"),
        F.when(e("user_id") % 50 != 0, F.concat(F.lit("svc-"), e("event_type"))).alias("service_name"),
        F.timestamp_micros(start).alias("start_timestamp"),
        F.timestamp_micros(end).alias("end_timestamp"),
        ((end - start) / 1000).alias("duration_ms"),
        F.when(e("user_id") % 10 != 3, e("value") > 40).alias("is_error"),
    )


NESTED_SQL = """
nested AS (
  SELECT *, start_us + (8 - slot) * 20000 + round(value * 1000)::BIGINT AS end_us FROM (
    SELECT 't' || (event_id // 8) AS trace_id, 's' || event_id AS span_id,
           CASE WHEN event_id % 8 = 0 THEN NULL
                WHEN value > 200 THEN 'lost-' || event_id
                WHEN event_id % 8 = 1 AND event_type = 'signup' THEN 's' || (event_id // 8 * 8 + 3)
                ELSE 's' || (event_id // 8 * 8 + (event_id % 8 - 1) // 2) END AS parent,
           event_type || '.handle' AS name, CASE WHEN user_id % 50 <> 0 THEN 'svc-' || event_type END AS service_name,
           event_id % 8 AS slot, value, CASE WHEN user_id % 10 <> 3 THEN value > 40 END AS is_error,
           1704067200000000 + event_id // 8 * 10000000 + event_id % 8 * 20000 + user_id % 5 * 15000 AS start_us
    FROM events)
)"""
