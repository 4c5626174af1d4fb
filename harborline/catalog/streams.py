"""Streaming jobs run to the end of the available input."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog import shapes as S
from harborline.catalog.projections import TELEMETRY, telemetry
from harborline.catalog.registry import query
from harborline.catalog.sources import order_records
from harborline.operators.latest import latest_by_key
from harborline.plans import marts
from harborline.settings import work_path
from harborline.sources import cdc
from harborline.streaming import flights, jobs


def _events(t):
    return jobs.file_stream(t.spark, t.folder, t.events.schema, glob="events.parquet")


@query("r01_delete_filter", "SELECT count(*) FILTER (o_orderstatus <> 'P') AS kept, count(*) FILTER (o_orderstatus = 'P') AS deleted FROM orders")
def r01(t):
    records = order_records(t)
    kept = cdc.after_images(records, "orders").agg(F.count(F.lit(1)).alias("kept"))
    total = records.agg(F.count(F.lit(1)).alias("n")).scalar()
    return kept.select("kept", (total - F.col("kept")).alias("deleted"))


_LATEST = """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


@query("r02_stream_append_then_latest", _LATEST)
def r02_append(t):
    out = work_path(t.spark, "bronze-events")
    jobs.append_to(_events(t), out, out + "-checkpoint").awaitTermination()
    return latest_by_key(t.spark.read.parquet(out), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("r02_stream_keyed_state", _LATEST)
def r02_state(t):
    out = work_path(t.spark, "latest-events")
    state = jobs.last_value_per_key(_events(t), ["user_id"], ["ts", "event_id"])
    jobs.update_to(state, out, out + "-checkpoint").awaitTermination()
    newest = jobs.newest_state(t.spark.read.parquet(out), ["user_id"])
    return newest.select("user_id", "event_id", "event_type", "value")


@query("r02_compacted_state", _LATEST)
def r02_compacted(t):
    """Five deliveries; the log is folded into a snapshot after the second and the fourth."""
    inbox, out = work_path(t.spark, "deliveries"), work_path(t.spark, "compacted-events")
    for part in range(5):
        t.events.where(F.col("event_id") % 5 == part).write.mode("append").parquet(inbox)
        state = jobs.last_value_per_key(jobs.file_stream(t.spark, inbox, t.events.schema), ["user_id"], ["ts", "event_id"])
        jobs.update_to(state, out, out + "-checkpoint").awaitTermination()
        if part % 2:
            jobs.compact(t.spark, out, ["user_id"])
    return jobs.read_state(t.spark, out, ["user_id"]).select("user_id", "event_id", "event_type", "value")


@query("r04_restart", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, 2 AS starts FROM events GROUP BY 1")
def r04(t):
    """A batch is written, then the query fails before it commits; the restart replaces the batch under its number."""
    inbox, out = work_path(t.spark, "restart-in"), work_path(t.spark, "restart-out")
    rows, failed = t.events.select("event_id", "event_type"), []
    for part in range(2):
        rows.where(F.col("event_id") % 2 == part).write.mode("append").parquet(inbox)

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/_batch={number}")
        if not failed:
            failed.append(number)
            raise RuntimeError("lost between write and commit")

    start = lambda: jobs.batch_sink(jobs.file_stream(t.spark, inbox, rows.schema), write, out + "-checkpoint", "10 seconds" if not failed else None)
    starts = jobs.run_with_restarts(start)
    done = t.spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
    return done.withColumn("starts", F.lit(starts))


@query(
    "k14_tap",
    f"""SELECT 'before' AS side, event_type, count(*) AS n FROM events GROUP BY 1, 2
        UNION ALL SELECT 'after', event_type, count(*) FROM ({_LATEST}) GROUP BY 1, 2""",
)
def k14(t):
    out = work_path(t.spark, "tap")
    jobs.tap(_events(t), ["user_id"], ["ts", "event_id"], out, out + "-checkpoint").awaitTermination()
    side = lambda name: t.spark.read.parquet(f"{out}/{name}").groupBy(F.lit(name).alias("side"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return side("before").unionByName(side("after"))


@query(
    "r05_stream_value_bursts",
    """SELECT user_id, count(*) AS failed_count, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end
       FROM events WHERE value > 1 GROUP BY 1, 3 HAVING count(*) >= 1""",
)
def r05_stream(t):
    out = work_path(t.spark, "bursts")
    found = jobs.bursts(_events(t), "user_id", "ts", F.col("value") > 1, 1)
    jobs.update_to(found, out, out + "-checkpoint").awaitTermination()
    return jobs.newest_state(t.spark.read.parquet(out), ["user_id", "window_start", "window_end"])


_PAYMENT_BURSTS = (
    f"""WITH {S.BRONZE_ORDERS}, {S.BRONZE_PAYMENTS},
        latest_payments AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY updated_at DESC, status DESC, amount DESC) AS rn FROM bronze_payments) WHERE rn = 1)
        SELECT o.user_id, count(*) AS failed_count, time_bucket(INTERVAL 5 MINUTE, payment_date) AS window_start, time_bucket(INTERVAL 5 MINUTE, payment_date) + INTERVAL 5 MINUTE AS window_end
        FROM latest_payments p LEFT JOIN latest_orders o ON p.order_id = o.order_id WHERE status = 'failed' GROUP BY 1, 3 HAVING count(*) >= 3"""
)


@query("r05_stream_payment_bursts", _PAYMENT_BURSTS)
def r05_stream_payments(t):
    """Three failed payments in five minutes, from a stream in three deliveries with a compaction between them."""
    payments = latest_by_key(S.bronze_payments(t), ["payment_id"], ["updated_at", "status", "amount"])
    users = latest_by_key(S.bronze_orders(t), ["order_id"], ["updated_at", "order_status"]).select("order_id", "user_id")
    stated = payments.join(users, "order_id", "left").select("payment_id", "user_id", "payment_date", "status")
    inbox, out, keys = work_path(t.spark, "payments"), work_path(t.spark, "payment-bursts"), ["user_id", "window_start", "window_end"]
    for part in range(3):
        stated.where(F.col("payment_id") % 3 == part).write.mode("append").parquet(inbox)
        found = jobs.bursts(jobs.file_stream(t.spark, inbox, stated.schema), "user_id", "payment_date", F.col("status") == "failed", 3)
        jobs.update_to(found, out, out + "-checkpoint").awaitTermination()
        jobs.compact(t.spark, out, keys)
    return jobs.read_state(t.spark, out, keys)


@query("r05_payment_bursts", _PAYMENT_BURSTS)
def r05(t):
    return marts.abnormal_payments(S.bronze_payments(t), S.bronze_orders(t))


@query(
    "r06_live_views",
    f"""WITH {S.BRONZE_ORDERS}
        SELECT count(DISTINCT user_id) AS active_users, count(*) AS total_orders FROM latest_orders WHERE CAST(updated_at AS DATE) = DATE '{S.DAY}'""",
)
def r06(t):
    as_of = F.lit(f"{S.DAY} 23:00:00").cast("timestamp_ntz")
    marts.register_marts(S.bronze_orders(t), S.bronze_items(t), S.bronze_products(t), S.bronze_payments(t), as_of, S.DAY)
    return t.spark.table("unique_user").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("active_users", "total_orders")]
    )


@query(
    "r07_stream_two_sinks",
    f"""WITH {TELEMETRY}
        SELECT 'positions' AS sink, airline, count(*) AS n FROM telemetry GROUP BY 1, 2
        UNION ALL SELECT 'landed', airline, count(*) FROM telemetry WHERE flight_status = 'Landed' GROUP BY 1, 2""",
)
def r07(t):
    raw, out = work_path(t.spark, "telemetry"), work_path(t.spark, "flight-tables")
    telemetry(t).write.parquet(raw)
    flat = flights.flights(jobs.file_stream(t.spark, raw, "data string"))
    jobs.two_sinks(flat, {"positions": flights.positions, "landed": flights.landings}, out, out + "-checkpoint").awaitTermination()
    count = lambda name: t.spark.read.parquet(f"{out}/{name}").groupBy(F.lit(name).alias("sink"), "airline").agg(F.count(F.lit(1)).alias("n"))
    return count("positions").unionByName(count("landed"))


@query(
    "r09_incremental_file_stream",
    "SELECT source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1",
)
def r09(t):
    inbox, out = work_path(t.spark, "inbox"), work_path(t.spark, "loaded")
    schema = "doc_id long, source string, n_chars long"
    rows = t.documents.select("doc_id", "source", "n_chars")
    for late in (False, True):  # two deliveries, one checkpoint
        half = rows.where((F.col("source") >= "src5") == late)
        half.write.mode("append").option("header", "true").csv(inbox)
        stream = jobs.file_stream(t.spark, inbox, schema, glob="*.csv", fmt="csv", header="true")
        jobs.append_to(stream, out, out + "-checkpoint").awaitTermination()
    return t.spark.read.schema(schema).parquet(out).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("k01_micro_batch_sink", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def k01(t):
    out = work_path(t.spark, "batches")
    write = lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/_batch={number}")
    jobs.batch_sink(_events(t).select("event_id", "event_type"), write, out + "-checkpoint").awaitTermination()
    return t.spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query(
    "r03_late_rows_are_kept",
    """SELECT user_id, count(*) AS failed_count, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end
       FROM events WHERE event_type = 'error' GROUP BY 1, 3""",
)
def r03(t):
    inbox, out = work_path(t.spark, "late-events"), work_path(t.spark, "late-bursts")
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    for delivered in (F.col("ts") >= middle, F.col("ts") < middle):  # the older half arrives last
        t.events.where(delivered).write.mode("append").parquet(inbox)
        stream = jobs.file_stream(t.spark, inbox, t.events.schema)
        jobs.update_to(jobs.bursts(stream, "user_id", "ts", F.col("event_type") == "error", 1), out, out + "-checkpoint").awaitTermination()
    return jobs.newest_state(t.spark.read.parquet(out), ["user_id", "window_start", "window_end"])
