"""Counting, distribution, roll-up, change and streaming queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import changes, statistics
from ..session import ensure_checkpoint_dir
from ..sources import files
from ..streaming import watch
from .registry import Registry

R = Registry()


@R.query("select event_type, count(*) as n from events where event_type is not null group by 1")
def event_type_counts(t):
    return statistics.value_counts(t.events, "event_type")


@R.query("select p_type, count(*) as n, min(p_partkey) as first_seen from part group by 1 order by 2 desc, 3 limit 10")
def top_k_counts(t):
    """The ten most frequent part types; ties keep the first seen."""
    return t.part.groupBy("p_type").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_seen")).orderBy(F.desc("n"), "first_seen").limit(10)


@R.query("""select case when upper(trim(condition_name)) like 'EP%' then 'EP' when upper(trim(condition_name)) like 'MI%' then 'MI' when upper(trim(condition_name)) like 'OS%' then 'OS' else 'Other' end as prefix,
            count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 2) as percent from comorbidities where condition_name is not null group by 1""")
def prefix_categories(t):
    up = F.upper(F.trim("condition_name"))
    c = F.when(up.startswith("EP"), "EP").when(up.startswith("MI"), "MI").when(up.startswith("OS"), "OS").otherwise("Other")
    return statistics.shares(t.comorbidities.filter("condition_name is not null").select(c.alias("prefix")), "prefix")


@R.query("""select case when duration_hours < 1 then 'short' when duration_hours <= 24 then 'day' else 'long' end as band, count(*) as n from recordings where n_data_records > 0 and duration_hours is not null group by 1""")
def duration_bands(t):
    h = F.col("duration_hours")
    band = F.when(h < 1, "short").otherwise(statistics.banded(h, [("day", 1, 24), ("long", 24, float("inf"))]))
    return t.recordings.filter("n_data_records > 0 and duration_hours is not null").groupBy(band.alias("band")).agg(F.count("*").alias("n"))


@R.query("""select l_returnflag, count(l_quantity) as n, round(quantile_cont(l_extendedprice, 0.25), 4) as q1, round(quantile_cont(l_extendedprice, 0.5), 4) as median, round(quantile_cont(l_extendedprice, 0.75), 4) as q3 from lineitem group by 1""")
def quantiles_linear(t):
    return statistics.quartiles(t.lineitem, "l_extendedprice", ["l_returnflag"])


@R.query("""with s as (select list(l_quantity order by l_quantity) as a from lineitem where l_quantity is not null) select a[len(a) // 4 + 1] as q1, a[len(a) // 2 + 1] as median, a[3 * len(a) // 4 + 1] as q3 from s""")
def quantiles_nearest_rank(t):
    return statistics.nearest_rank_quartiles(t.lineitem, "l_quantity")


@R.query("""with c as (select o_custkey, count(*) as n from orders group by 1) select round(median(n), 4) as median_orders, round(avg(case when n > 1 then 1.0 else 0.0 end), 4) as share_many from c""")
def per_entity_then_median(t):
    c = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return c.agg(F.round(F.expr("percentile(n, 0.5)"), 4).alias("median_orders"), F.round(F.avg((F.col("n") > 1).cast("double")), 4).alias("share_many"))


@R.query("""select case when l_quantity = 50 then 9 else cast(floor(l_quantity / 5) as integer) end as bin, count(*) as n from lineitem where l_quantity between 0 and 50 group by 1""")
def histogram_fixed(t):
    return statistics.histogram(t.lineitem, F.col("l_quantity"), 0, 5, 10)


@R.query("""select cast(floor((log10(o_totalprice) - 2) / 0.1) as integer) as bin, count(*) as n from orders where o_totalprice > 0 and log10(o_totalprice) >= 2 and log10(o_totalprice) < 7 group by 1""")
def histogram_log(t):
    return statistics.histogram(t.orders.filter("o_totalprice > 0"), F.log10("o_totalprice"), 2, 0.1, 50)


@R.query("""select o_custkey, max(case when o_orderstatus = 'F' then 1 else 0 end) as ever_filled, round(median(l.q), 4) as median_quantity, round(coalesce(sum(l.q), 0), 4) as quantity, count(distinct o_orderkey) as n_orders
            from orders left join (select l_orderkey, l_quantity as q from lineitem) l on o_orderkey = l.l_orderkey group by 1""")
def entity_rollup(t):
    d = t.orders.join(t.lineitem.select("l_orderkey", "l_quantity"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return d.groupBy("o_custkey").agg(
        F.max((F.col("o_orderstatus") == "F").cast("int")).alias("ever_filled"),
        F.round(F.expr("percentile(l_quantity, 0.5)"), 4).alias("median_quantity"),
        F.round(F.coalesce(F.sum("l_quantity"), F.lit(0.0)), 4).alias("quantity"),
        F.count_distinct("o_orderkey").alias("n_orders"),
    )


@R.query("""select study_id, count(*) as packets, sum(coalesce(try_cast(duration_hours as double), 0)) as hours, max(case when lower(has_video) = 'true' then 1 else 0 end) as ever_video, max(case when lower(is_ambulatory) = 'true' then 1 else 0 end) as ever_ambulatory
            from studies where study_id is not null group by 1""")
def study_rollup(t):
    """Any-flags over both boolean spellings, hours with unreadable ones as 0."""
    yes = lambda c: F.max(F.coalesce((F.lower(c) == "true").cast("int"), F.lit(0)))
    hours = F.sum(F.coalesce(F.col("duration_hours").try_cast("double"), F.lit(0.0)))
    return t.studies.filter("study_id is not null").groupBy("study_id").agg(F.count("*").alias("packets"), hours.alias("hours"), yes("has_video").alias("ever_video"), yes("is_ambulatory").alias("ever_ambulatory"))


@R.query("""select cast(h as integer) as hour, coalesce(n, 0) as n_logged, coalesce(f, 0) as n_flagged from generate_series(0, 23) g(h) left join (select extract(hour from ts) as hour, count(*) as n, cast(sum(case when value > 50 then 1 else 0 end) as bigint) as f from events group by 1) c on g.h = c.hour""")
def hour_of_day_dense(t):
    return statistics.dense_hours(t.events.withColumn("h", F.hour("ts")), "h", F.col("value") > 50)


@R.query("""select count(distinct id) as n_ids from (select cast(o_custkey as varchar) as id from orders union all select cast(c_custkey as varchar) from customer union all select cast(user_id as varchar) from events) where trim(id) <> ''""")
def distinct_over_union(t):
    return statistics.distinct_over_union([(t.orders, "o_custkey"), (t.customer, "c_custkey"), (t.events, "user_id")])


@R.query("""with m as (select case when l_linenumber % 2 = 0 then 1 else 0 end as h, count(*) as n, sum(l_quantity) as q, count(distinct l_suppkey) as s from lineitem group by 1), u as (unpivot (select h, cast(n as double) as n_rows, q as quantity, cast(s as double) as suppliers from m) on n_rows, quantity, suppliers into name metric value value)
            select a.metric, a.value as old_value, b.value as new_value, round(b.value - a.value, 4) as delta, a.value <> b.value as changed from u a join u b on a.metric = b.metric and a.h = 0 and b.h = 1""")
def run_diff(t):
    m = {"n_rows": F.count("*"), "quantity": F.sum("l_quantity"), "suppliers": F.count_distinct("l_suppkey")}
    half = lambda k: statistics.long_metrics(t.lineitem.filter(F.col("l_linenumber") % 2 == k), m)
    return statistics.compare(half(1), half(0))


@R.query("""select folder_name, count(*) as n_files, round(coalesce(sum(edf_size_mb), 0), 4) as mb, count(distinct site_code) as n_sites, array_to_string(list_sort(list(distinct filetype) filter (where filetype is not null))[1:25], ',') as kinds from recordings where folder_name is not null group by 1""")
def group_summary(t):
    return t.recordings.filter("folder_name is not null").groupBy("folder_name").agg(
        F.count("*").alias("n_files"), F.round(F.coalesce(F.sum("edf_size_mb"), F.lit(0.0)), 4).alias("mb"), F.count_distinct("site_code").alias("n_sites"), F.array_join(F.slice(F.array_sort(F.collect_set("filetype")), 1, 25), ",").alias("kinds")
    )


@R.query("""select folder_name, kind, count(*) as n from (select folder_name, lower(regexp_extract(edf_filename, '(\\.[^.]+)$', 1)) as kind from recordings where edf_filename is not null) group by 1, 2""")
def type_histogram_map(t):
    """Files per extension as a map per folder, exploded again."""
    d = t.recordings.filter("edf_filename is not null")
    kind = F.lower(F.regexp_extract("edf_filename", r"(\.[^.]+)$", 1))
    inventory = files.folder_inventory(d.select(F.coalesce("folder_name", F.lit("\u0000")).alias("folder"), kind.alias("extension"), (F.col("edf_size_mb") * 1048576).alias("size")), [".edf"])
    return inventory.select(F.nullif("folder", F.lit("\u0000")).alias("folder_name"), F.explode("kinds").alias("kind", "n"))


@R.query("""select primary_sample_rate, count(*) as n from recordings where primary_sample_rate is not null group by 1 order by 2 desc, 1 limit 1""")
def common_rate(t):
    """The most frequent sample rate, the lowest of equals."""
    return t.recordings.filter("primary_sample_rate is not null").groupBy("primary_sample_rate").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "primary_sample_rate").limit(1)


@R.query("""select event_id from events where event_id not in (select event_id from events where event_type = 'click')""")
def incremental_anti(t):
    return changes.pending(t.events, t.events.filter("event_type = 'click'"), "event_id").select("event_id")


@R.query("""select r.recording_id from recordings r left join (select folder_name, max(loaded_at) as made from annotations group by 1) a on r.folder_name = a.folder_name where a.made is null or a.made < r.loaded_at""")
def stale_results(t):
    return changes.stale(t.recordings.filter("folder_name is not null"), t.annotations, "folder_name", "loaded_at", "loaded_at").select("recording_id")


@R.query("""with d as (select cast(ts as date) as day, count(*) as n from events group by 1), c as (select day, sum(n) over (order by day) as done, row_number() over (order by day) * 60.0 as elapsed from d)
            select day, cast(done as bigint) as done, round((done - lag(done) over (order by day)) / (elapsed - lag(elapsed) over (order by day)) * 60, 4) as rate, cast((select count(*) from events) - done as bigint) as remaining from c""")
def rate_from_snapshots(t):
    from pyspark.sql import Window

    d = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    w = Window.orderBy("day")  # one row a day
    c = d.select("day", F.sum("n").over(w).alias("done"), (F.row_number().over(w) * 60.0).alias("elapsed"))
    total = t.events.agg(F.count("*").alias("total"))
    return watch.rates(c, "day", "done", "elapsed").join(F.broadcast(total)).select("day", "done", "rate", (F.col("total") - F.col("done")).alias("remaining"))


@R.query("""select vec_id, round(list_sum(list_transform(list_zip(embedding[1:len(embedding) - 1], embedding[2:]), lambda x: abs(cast(x[1] as double) - cast(x[2] as double)))), 4) as movement from embeddings""")
def bipolar_difference(t):
    """Differences of neighbouring channels and their summed size."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    d = scalars.difference(F.slice(e, F.lit(1), F.size(e) - 1), F.slice(e, F.lit(2), F.size(e) - 1))
    return t.embeddings.select("vec_id", F.round(F.aggregate(F.transform(d, F.abs), F.lit(0.0), lambda s, x: s + x), 4).alias("movement"))


@R.query("""select date_trunc('hour', ts) as window_start, event_type, count(*) as n from events group by 1, 2""")
def tumbling_counts(t):
    return watch.tumbling_counts(t.events, "ts", "event_type").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@R.query("select event_type, count(*) as n from events group by 1")
def watch_ingest(t):
    """The events as a file stream that is drained once, batch by batch; equals the batch result."""
    home = os.path.join(ensure_checkpoint_dir(t.spark), "watch-" + uuid.uuid4().hex)
    source = t.events
    q = watch.watch(t.spark, f"{t.folder}/events*", source.schema, lambda b: b.groupBy("event_type").agg(F.count("*").alias("n")), f"{home}/out", f"{home}/check")
    q.awaitTermination()
    return t.spark.read.parquet(f"{home}/out").groupBy("event_type").agg(F.sum("n").alias("n"))
