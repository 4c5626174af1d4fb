"""Writing: partitions, hot to cold, splits, audit and error rows, upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog import shapes as S
from harborline.catalog.registry import query
from harborline.operators import merge as M
from harborline.operators import scd
from harborline.settings import work_path
from harborline.sinks import audit, tables
from harborline.sources import files
from harborline.streaming import jobs


@query(
    "k03_hourly_landing",
    """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
       FROM events GROUP BY 1, 2, 3, 4""",
)
def k03(t):
    path = work_path(t.spark, "raw")
    tables.land(t.events, path, "ts")
    parts = [F.lpad(F.col(c).cast("string"), n, "0").alias(c) for c, n in (("year", 4), ("month", 2), ("day", 2), ("hour", 2))]
    return t.spark.read.parquet(path).groupBy(*parts).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query(
    "k04_audit_rows",
    """SELECT 'run-1' AS execution_id, source AS source_detail, max(doc_id) AS landing_time, count(*) FILTER (n_chars > 300) AS rows_processed,
              CASE WHEN count(*) FILTER (n_chars > 300) = 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS process_status,
              CASE WHEN count(*) FILTER (n_chars > 300) = 0 THEN 'no row was loaded' END AS error_message FROM documents GROUP BY source""",
)
def k04(t):
    stamp = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    rows = audit.audit_rows(
        t.documents, "source", execution_id="run-1", process_name="documents", source_name="vendor", target_table="raw",
        started=stamp, finished=stamp, landing_time="doc_id", valid=F.col("n_chars") > 300,
    )
    return rows.select("execution_id", "source_detail", "landing_time", "rows_processed", "process_status", "error_message")


@query(
    "k04_empty_file",
    """SELECT 'p_' || o_orderpriority || '.csv' AS source_detail, CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE count(*) END AS rows_processed,
              CASE WHEN o_orderpriority = '5-LOW' THEN 'FAILURE' ELSE 'SUCCESS' END AS process_status, TRUE AS position_moved FROM orders GROUP BY o_orderpriority""",
)
def k04_empty(t):
    """One file per priority, one of them with a header only; the listing comes from storage."""
    inbox = work_path(t.spark, "deliveries")
    rows = t.orders.select("o_orderkey", F.concat(F.lit("p_"), "o_orderpriority", F.lit(".csv")).alias("file"))
    for name in sorted(r[0] for r in rows.select("file").distinct().collect()):  # one folder per delivered file
        held = rows.where(F.col("file") == name).select("o_orderkey")
        held.where(F.lit("5-LOW" not in name)).coalesce(1).write.option("header", "true").csv(f"{inbox}/{name}")
    folder = lambda c: F.element_at(F.split(c, "/"), -2)
    found = files.list_files(t.spark, [inbox])
    listing = found.select(folder("path").alias("source_detail"), F.col("generation").alias("landing_time"))
    loaded = t.spark.read.schema("o_orderkey long").option("header", "true").option("recursiveFileLookup", "true").csv(inbox).withColumn("file", folder(files.plain_path(F.col("_metadata.file_path"))))
    stamp = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    rows = audit.audit_rows(loaded, "file", execution_id="run-1", process_name="orders", source_name="vendor", target_table="raw", started=stamp, finished=stamp, listing=listing)
    return rows.select("source_detail", "rows_processed", "process_status", (F.col("landing_time") > 0).alias("position_moved"))


@query(
    "k05_error_rows",
    """SELECT 'run-1' AS execution_id, CAST(NULL AS VARCHAR) AS identity, CAST(o_custkey AS VARCHAR) AS phone, o_orderpriority AS email, 'orders.parquet' AS file_name,
         'status ' || o_orderstatus AS error_detail, '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS data, 0 AS processed_flag
       FROM orders WHERE o_orderstatus = 'P'""",
)
def k05(t):
    rejected = t.orders.where("o_orderstatus = 'P'").withColumn("detail", F.concat(F.lit("status "), "o_orderstatus"))
    return audit.error_rows(
        rejected, execution_id="run-1", identity=None, phone="o_custkey", email="o_orderpriority",
        file_name=F.lit("orders.parquet"), detail="detail", data=["o_orderkey", "o_orderstatus"],
    )


@query(
    "k06_hot_to_cold",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN 'cold' ELSE 'hot' END AS tier, count(*) AS n FROM events GROUP BY 1, 2""",
)
def k06(t):
    hot, cold = work_path(t.spark, "hot"), work_path(t.spark, "cold")
    tables.replace_partitions(t.events.withColumn("day", F.to_date("ts")), hot, ["day"], ["ts"])
    tables.move_day_to_cold(t.spark, hot, cold, "2024-01-10", "ts")
    tables.move_day_to_cold(t.spark, hot, cold, "2024-01-10", "ts")
    tiers = [t.spark.read.parquet(p).select("day", F.lit(name).alias("tier")) for p, name in ((hot, "hot"), (cold, "cold"))]
    return S.day_texts(tiers[0].unionByName(tiers[1]).groupBy("day", "tier").agg(F.count(F.lit(1)).alias("n")), "day")


@query(
    "k06_second_move_new_column",
    """SELECT event_id, event_type, CASE WHEN event_id % 3 = 0 THEN 'late' END AS channel, CASE WHEN event_id % 3 = 0 THEN user_id END AS owner
       FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'""",
)
def k06_new_column(t):
    """A third of a day's rows comes later, with a text and a map column that the first move didn't have; some come again."""
    hot, cold = work_path(t.spark, "hot"), work_path(t.spark, "cold")
    rows = t.events.where("cast(ts as date) = date'2024-01-10'").select("event_id", "event_type", "user_id", "ts", F.to_date("ts").alias("day"))
    late = rows.where("event_id % 3 = 0").withColumns({"channel": F.lit("late"), "tags": F.create_map(F.lit("owner"), F.col("user_id"))})
    for batch in (rows, late, rows.where("event_id % 3 = 1")):
        tables.replace_partitions(batch, hot, ["day"], ["ts"])
        tables.move_day_to_cold(t.spark, hot, cold, "2024-01-10", "ts", ["event_id"])
    return tables.read_cold(t.spark, cold).select("event_id", "event_type", "channel", F.col("tags")["owner"].alias("owner"))


@query(
    "k06_replace_partition",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(sum(CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN 2 ELSE 1 END) AS BIGINT) AS weight FROM events GROUP BY 1""",
)
def k06_replace(t):
    path = work_path(t.spark, "days")
    rows = t.events.select("event_id", F.to_date("ts").alias("day"), F.lit(1).alias("weight"))
    tables.replace_partitions(rows, path, ["day"])
    late = rows.where(F.col("day") >= F.lit("2024-01-20").cast("date")).withColumn("weight", F.lit(2))
    tables.replace_partitions(late, path, ["day"])
    return S.day_texts(t.spark.read.parquet(path).groupBy("day").agg(F.sum("weight").alias("weight")), "day")


@query(
    "k08_collapse_versions",
    f"""WITH {S.USER_VERSIONS}
        SELECT user_key, user_id, CAST(start_date AS VARCHAR) AS start_date, CASE WHEN is_current = 1 THEN '2001-09-01' ELSE CAST(end_date AS VARCHAR) END AS end_date, 0 AS is_current FROM dim_user""",
)
def k08(t):
    dim = S.dim_user(t).drop("segment")
    changed = t.orders.select(F.col("o_custkey").alias("user_id"))
    both = dim.unionByName(scd.expired_versions(dim, changed, "user_id", "2001-09-01"))
    return S.day_texts(scd.collapse_versions(both, "user_id"), "start_date", "end_date")


@query("k09_materialise", "SELECT p_brand, count(*) AS parts, CAST(sum(p_size) AS BIGINT) AS size FROM part GROUP BY 1")
def k09(t):
    brands = t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"), F.sum("p_size").alias("size"))
    return tables.materialise(brands, work_path(t.spark, "brands"))


@query("k10_csv_to_parquet", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def k10(t):
    source, target = work_path(t.spark, "orders-csv"), work_path(t.spark, "orders-parquet")
    t.orders.select("o_orderkey", F.date_format("o_orderdate", "dd.MM.yyyy HH:mm").alias("o_orderdate"), "o_totalprice").write.option("header", "true").csv(source)
    tables.csv_to_parquet(t.spark, source, target, "o_orderkey long, o_orderdate timestamp_ntz, o_totalprice double", "dd.MM.yyyy HH:mm")
    return t.spark.read.parquet(target)


@query("k11_split_and_verify", "SELECT count(*) AS source_rows, count(*) AS split_rows, TRUE AS same_header, TRUE AS complete FROM lineitem")
def k11(t):
    path = work_path(t.spark, "split")
    tables.split_files(t.lineitem, path, ["l_orderkey"], files=4, rows_per_file=100_000)
    return tables.verify_split(t.spark, t.lineitem, path)


@query(
    "k11_part_headers",
    """SELECT 'l_linenumber,l_orderkey' AS header, FALSE AS same, FALSE AS complete, count(*) AS rows FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2, 3
       UNION ALL SELECT 'l_orderkey,l_linenumber', TRUE, FALSE, count(*) FROM lineitem WHERE l_returnflag <> 'R'""",
)
def k11_headers(t):
    """A split some of whose parts have their columns in another order: the totals agree, the headers don't."""
    path, source = work_path(t.spark, "split"), t.lineitem.select("l_orderkey", "l_linenumber")
    returned = t.lineitem["l_returnflag"] == "R"
    for part, columns in ((t.lineitem.where(~returned), source.columns), (t.lineitem.where(returned), source.columns[::-1])):
        part.select(*columns).coalesce(1).write.mode("append").option("header", "true").csv(path)
    heads = tables.part_headers(t.spark, source, path)
    lines = t.spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("part")).agg((F.count(F.lit(1)) - 1).alias("rows"))
    complete = tables.verify_split(t.spark, source, path).select("complete").scalar()
    return heads.join(lines, "part").groupBy("header", "same").agg(F.sum("rows").alias("rows")).withColumn("complete", complete)


@query(
    "k12_append_once",
    """SELECT l_orderkey, l_linenumber, CAST(max(l_partkey) AS BIGINT) AS l_partkey FROM lineitem GROUP BY 1, 2""",
)
def k12(t):
    path = work_path(t.spark, "flights")
    once = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("l_partkey"))
    audit.append(once, path)
    return t.spark.read.schema(once.schema).parquet(path)


_SNAPSHOT = """
old AS (SELECT o_custkey AS id, arg_max(o_orderpriority, o_orderkey) AS priority, arg_max(o_orderstatus, o_orderkey) AS status,
               string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses, max(o_orderkey) AS last_order FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY 1),
new AS (SELECT o_custkey AS id, arg_max(o_orderpriority, o_orderkey) AS priority, nullif(arg_max(o_orderstatus, o_orderkey), 'P') AS status,
               'new' AS statuses, CASE WHEN count(*) > 3 THEN max(o_orderkey) END AS last_order FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY 1)
"""


@query(
    "k13_merge_upsert",
    f"""WITH {_SNAPSHOT}
        SELECT id, CASE WHEN n.id IS NULL THEN o.priority ELSE n.priority END AS priority,
          COALESCE(n.status, o.status) AS status,
          CASE WHEN o.id IS NULL THEN n.statuses WHEN n.id IS NULL THEN o.statuses ELSE o.statuses || ',' || n.statuses END AS statuses,
          CASE WHEN n.id IS NULL THEN o.last_order WHEN o.id IS NULL THEN n.last_order ELSE n.last_order END AS last_order,
          CASE WHEN o.id IS NULL THEN TIMESTAMP '2002-01-01' END AS created_at,
          CASE WHEN n.id IS NOT NULL THEN TIMESTAMP '2002-01-01' END AS updated_at,
          CASE WHEN o.id IS NULL OR (n.id IS NOT NULL AND (n.priority IS DISTINCT FROM o.priority OR COALESCE(n.status, o.status) IS DISTINCT FROM o.status)) THEN TIMESTAMP '2002-01-01' END AS bumped_at
        FROM old o FULL JOIN new n USING (id)""",
)
def k13(t):
    late = F.col("o_orderdate") >= F.lit(S.CUTOFF).cast("timestamp_ntz")
    grouped = lambda df: df.groupBy(F.col("o_custkey").alias("id"))
    last = lambda c: F.max_by(c, "o_orderkey")
    none = F.lit(None).cast("timestamp_ntz")
    old = grouped(t.orders.where(~late)).agg(
        last("o_orderpriority").alias("priority"), last("o_orderstatus").alias("status"),
        F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"), F.max("o_orderkey").alias("last_order"),
    ).withColumns({"created_at": none, "updated_at": none, "bumped_at": none})
    new = grouped(t.orders.where(late)).agg(
        last("o_orderpriority").alias("priority"), F.nullif(last("o_orderstatus"), F.lit("P")).alias("status"),
        F.lit("new").alias("statuses"), F.when(F.count(F.lit(1)) > 3, F.max("o_orderkey")).alias("last_order"),
    )
    rules = {"priority": M.overwrite, "status": M.coalesce, "statuses": M.csv_union, "last_order": M.overwrite}
    return M.merge_upsert(
        old, new, ["id"], rules, watched=["priority", "status"], bump="bumped_at",
        created_at="created_at", updated_at="updated_at", now=F.lit("2002-01-01").cast("timestamp_ntz"),
    )


@query("k02_stream_append", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def k02(t):
    out = work_path(t.spark, "events-by-day")
    stream = jobs.file_stream(t.spark, t.folder, t.events.schema, glob="events.parquet").withColumn("day", F.to_date("ts"))
    jobs.append_to(stream, out, out + "-checkpoint", ["day"]).awaitTermination()
    return S.day_texts(t.spark.read.parquet(out).groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")), "day")
