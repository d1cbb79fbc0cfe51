"""Change points of health series, in a batch and on a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import change as N
from ..session import work_dir
from .anomalies import base5
from .book import cte, query
from .health import h5
from .streams import drain, in_batches

RULES = N.ChangeRules(alpha=0.2, slack=0.25, alarm=4.0, chunk="3 days")

cte("ordered", """SELECT *, row_number() OVER (PARTITION BY service_name ORDER BY "timestamp") AS i FROM (
      SELECT h.service_name, "timestamp", p95_latency_ms AS x, (p95_latency_ms - baseline_p95_latency_ms) / latency_stddev AS z
      FROM h5 h JOIN base5 b ON h.service_name IS NOT DISTINCT FROM b.service_name)""", ("h5", "base5"))  # fmt: skip
SCORED = """SELECT service_name, "timestamp", round(x, 6) AS p95_latency_ms, round(e, 6) AS ewma, round(up, 6) AS cusum_up, round(down, 6) AS cusum_down,
       CASE WHEN up > 4 AND up0 <= 4 THEN 'up' WHEN down > 4 AND down0 <= 4 THEN 'down' END AS change
    FROM (WITH RECURSIVE r AS (
      SELECT service_name, "timestamp", i, x, x AS e, 0.0::DOUBLE AS up0, greatest(0.0, z - 0.25)::DOUBLE AS up,
             0.0::DOUBLE AS down0, greatest(0.0, -z - 0.25)::DOUBLE AS down FROM ordered WHERE i = 1
      UNION ALL
      SELECT o.service_name, o."timestamp", o.i, o.x, 0.2 * o.x + 0.8 * r.e, r.up, greatest(0.0, r.up + o.z - 0.25),
             r.down, greatest(0.0, r.down - o.z - 0.25)
      FROM r JOIN ordered o ON o.service_name IS NOT DISTINCT FROM r.service_name AND o.i = r.i + 1) SELECT * FROM r)"""
COLUMNS = ["service_name", "timestamp", "p95_latency_ms", *N.SCORES]


def based(spark, d):
    """Health rows with their service's mean and deviation."""
    base = base5(spark, d).select(F.col("service_name").alias("_s"), "baseline_p95_latency_ms", "latency_stddev")
    rows = h5(spark, d).select("service_name", "timestamp", "p95_latency_ms")
    return rows.join(base, F.col("service_name").eqNullSafe(F.col("_s"))).drop("_s")


def scored(rows):
    return N.score_changes(rows, ["service_name"], "p95_latency_ms", F.col("baseline_p95_latency_ms"), F.col("latency_stddev"), RULES)


@query("change_scores", SCORED, uses=("ordered",))
def _(spark, d):
    return scored(based(spark, d))[0].select(*COLUMNS)


@query("change_points", f"SELECT service_name, \"timestamp\", change, ewma FROM ({SCORED}) WHERE change IS NOT NULL", uses=("ordered",))
def _(spark, d):
    return scored(based(spark, d))[0].filter("change IS NOT NULL").select("service_name", "timestamp", "change", "ewma")


# Five files, a batch each; the state goes from one to the next.
@query("stream_change_scores", SCORED, uses=("ordered",))
def _(spark, d):
    rows = based(spark, d).withColumn("micros", F.unix_micros("timestamp")).cache()
    stream = in_batches(spark, rows, "micros", 5)
    rows.unpersist()
    target, states = work_dir(spark, "scores"), work_dir(spark, "score-states")
    each = N.score_batches(target, states, ["service_name"], "p95_latency_ms", F.col("baseline_p95_latency_ms"), F.col("latency_stddev"), RULES)
    drain(spark, stream, "score-run", each)
    return spark.read.parquet(target).select(*COLUMNS)
