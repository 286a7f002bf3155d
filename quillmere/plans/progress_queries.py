"""Queries on progress, coverage, eligibility and order, and on masking patterns with oracles of their own."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import statistics
from ..session import ensure_checkpoint_dir
from ..sources import files
from ..streaming import watch
from .registry import Registry

R = Registry()


@R.query("""with w as (select greatest(count(distinct study_id), 1) as total from studies), p as (select 'medications' as part, count(distinct study_id) as n from medications union all select 'comorbidities', count(distinct study_id) from comorbidities union all select 'dated', count(distinct study_id) from studies where trim(patient_dob) <> '')
            select part, n, cast(least(100, round_even(100.0 * n / total, 0)) as integer) as percent from p, w""")
def coverage_percent(t):
    """How many studies have medications, conditions and birth dates, in per cent."""
    s = t.studies
    return statistics.coverage(s, "study_id", {"medications": t.medications, "comorbidities": t.comorbidities, "dated": s.filter("trim(patient_dob) <> ''")})


@R.query("""select event_id, event_type, cast(sum(event_id % 7) over (partition by event_type order by event_id) as bigint) as total from events where event_type is not null""")
def running_counters(t):
    """Counters by type merged into running totals."""
    d = t.events.filter("event_type is not null").select("event_id", "event_type", (F.col("event_id") % 7).alias("amount"))
    return statistics.running_counters(d, "event_id", "event_type", "amount").select("event_id", "event_type", "total")


@R.query("""with d as (select cast(ts as date) as day, count(*) as n from events where ts is not null group by 1), c as (select day, sum(n) over (order by day) as done, row_number() over (order by day) * 60.0 as elapsed from d)
            select day, cast(done as bigint) as done, round(done / elapsed, 4) as rate, round(((select count(*) from events where ts is not null) - done) / (done / elapsed), 4) as eta_sec from c""")
def remaining_time(t):
    """Average rate since the start and the time left at it, at the end of each day."""
    from pyspark.sql import Window

    d = t.events.filter("ts is not null").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    w = Window.orderBy("day")  # one row a day
    c = d.select("day", F.sum("n").over(w).alias("done"), (F.row_number().over(w) * 60.0).alias("elapsed"))
    c = c.join(F.broadcast(t.events.filter("ts is not null").agg(F.count("*").alias("total"))))
    return c.select("day", "done", *[x.alias(n) for n, x in statistics.remaining_time(F.col("done"), F.col("total"), F.col("elapsed")).items()])


@R.query("""with n as (select event_id, row_number() over (order by event_id) - 1 as i, count(*) over () as n from events) select event_id from n where n <= 500 or i % 2 = 0""")
def thinned_history(t):
    """A history of more than 500 points keeps every second one."""
    return statistics.decimated(t.events.select("event_id"), "event_id")


@R.query("""select count(*) as csv_rows, cast(coalesce(sum(1 + length(text) - length(replace(text, chr(10), ''))), 0) as bigint) as physical_lines from (select replace(coalesce(text, ''), chr(13), '') as text from documents)""")
def csv_row_counts(t):
    """The documents as a delimited file with quoted line breaks: its rows and its physical lines."""
    path = os.path.join(ensure_checkpoint_dir(t.spark), "rows-" + uuid.uuid4().hex)
    d = t.documents.select("doc_id", F.concat(F.lit("<"), F.replace(F.coalesce("text", F.lit("")), F.lit("\r"), F.lit("")), F.lit(">")).alias("text"))
    d.write.option("header", "true").option("quoteAll", "true").option("escape", '"').csv(path)
    return files.row_counts(t.spark, path)


@R.query("""select study_row_id from studies where study_id is not null and trim(study_id) <> '' and (case study_row_id % 3 when 0 then 'high' when 1 then 'medium' else 'low' end) in ('high', 'medium')""")
def eligible_rows(t):
    """Rows with an id whose match has at least medium confidence."""
    c = F.when(F.col("study_row_id") % 3 == 0, "high").when(F.col("study_row_id") % 3 == 1, "medium").otherwise("low")
    return t.studies.filter((F.trim("study_id") != "") & c.isin("high", "medium")).select("study_row_id")


@R.query(r"""select study_row_id, cast(regexp_extract(patient_dob, '((?:19|20)[0-9]{2})', 1) as integer) as year from studies where regexp_matches(patient_dob, '(?:19|20)[0-9]{2}') and cast(regexp_extract(patient_dob, '((?:19|20)[0-9]{2})', 1) as integer) > 1920 and cast(regexp_extract(patient_dob, '((?:19|20)[0-9]{2})', 1) as integer) < 2025""")
def sane_birth_years(t):
    """Birth years beyond 1920 and before 2025."""
    y = F.regexp_extract("patient_dob", "((?:19|20)[0-9]{2})", 1).try_cast("int")
    return t.studies.select("study_row_id", y.alias("year")).filter("year > 1920 and year < 2025")


@R.query("""select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25""")
def sorted_limit(t):
    """The first 25 orders by price, then key."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@R.query("""select folder_name, count(*) as n_files, cast(sum(coalesce(n_data_records, 0)) as bigint) as records, arg_min(site_code, recording_id) as first_site from recordings where folder_name is not null group by 1""")
def folder_counts(t):
    """Files and records of a folder with the site of its first row."""
    r = t.recordings.filter("folder_name is not null")
    return r.groupBy("folder_name").agg(F.count("*").alias("n_files"), F.sum(F.coalesce("n_data_records", F.lit(0))).cast("bigint").alias("records"), F.min_by("site_code", "recording_id").alias("first_site"))


@R.query(r"""select study_id, median(low) as median_low_hz, cast(sum(coalesce(low, 0)) as double) as sum_low from (select study_id, try_cast(regexp_extract(pdr_frequency_hz, '^\s*([0-9]+(?:\.[0-9]+)?)', 1) as double) as low from eeg_background where study_id is not null) group by 1""")
def rhythm_rollup(t):
    """The median of a study's lower rhythm bounds and their sum, without any 0."""
    from ..functions import text as tx

    d = t.eeg_background.filter("study_id is not null").select("study_id", tx.lower_bound(F.col("pdr_frequency_hz")).alias("low"))
    return d.groupBy("study_id").agg(F.expr("percentile(low, 0.5)").alias("median_low_hz"), F.sum(F.coalesce("low", F.lit(0.0))).alias("sum_low"))


@R.query("""select recording_id, round(edf_size_mb * 1048576 / 1000000000, 2) as gb, round(edf_size_mb * 1048576 / 1073741824, 2) as gib from recordings where edf_size_mb is not null""")
def size_units(t):
    """Sizes in decimal and in binary gigabytes."""
    b = F.col("edf_size_mb") * 1048576
    return t.recordings.filter("edf_size_mb is not null").select("recording_id", scalars.gigabytes(b).alias("gb"), scalars.gigabytes(b, binary=True).alias("gib"))


@R.query("""with r as (select recording_id, folder_name, edf_size_mb * 1048576 as bytes, row_number() over (partition by folder_name order by recording_id) as position from recordings where folder_name is not null)
            select recording_id, position from r where bytes >= 512 * 1024 and folder_name like '%, %'""")
def stubs_after_numbering(t):
    """Stub files and folders off the pattern go after numbering, so they keep their numbers."""
    from ..operators import identity

    d = identity.numbered(t.recordings.filter("folder_name is not null"), ["folder_name"], ["recording_id"])
    return d.filter((F.col("edf_size_mb") * 1048576 >= 512 * 1024) & F.col("folder_name").like("%, %")).select("recording_id", F.col("position").cast("bigint").alias("position"))


@R.query("""select c_custkey, 'ok' as status, case when c_custkey % 3 = 0 then 1 else 0 end as attempt from customer""")
def retried_items(t):
    """Items that fail at first come again in the next round."""
    path = os.path.join(ensure_checkpoint_dir(t.spark), "status-" + uuid.uuid4().hex)
    rounds = []

    def process(batch):
        rounds.append(1)
        return batch.withColumn("ok", (F.col("c_custkey") % 3 != 0) | F.lit(len(rounds) > 1))

    s = watch.run_pending(t.spark, t.customer.select("c_custkey"), "c_custkey", process, path, "full")
    return s.filter("status = 'ok'").select("c_custkey", "status", "attempt")


@R.query("""with a as (select p_partkey as id, lower(p_name) as k from part), r as (select min(id) as id, k from a group by 2), f as (select string_split(k, ' ')[1] as w, min(id) as id from r group by 1)
            select a.id as left_id, f.id as ref_id, 'first_root' as method, 'medium' as confidence from a join f on string_split(a.k, ' ')[1] = f.w""")
def first_root_match(t):
    """Names that share nothing but their first word are resolved by it."""
    from ..operators import resolution

    k = F.lower("p_name")
    root = F.get(F.split(k, " "), F.lit(0))
    left = t.part.select(F.col("p_partkey").alias("left_id"), F.concat(k, F.lit(" qqqqqqqq")).alias("exact_key"), F.concat(k, F.lit(" zzzzzzzz")).alias("norm_key"), root.alias("root_key"))
    ref = t.part.groupBy(k.alias("exact_key"), root.alias("root_key")).agg(F.min("p_partkey").alias("ref_id")).select("ref_id", F.col("ref_id").alias("ref_order"), "exact_key", F.col("exact_key").alias("norm_key"), "root_key")
    return resolution.tiered_match(left, ref)
