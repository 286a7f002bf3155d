"""Queries that write tables in the formats of the sinks and read them again through the sources.

Each run writes to a folder of its own below the shared checkpoint folder; the oracle takes
the same rows from the tables.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..functions import scalars
from ..functions import text as tx
from ..operators import nested
from ..session import ensure_checkpoint_dir
from ..sources import files, sinks
from .registry import Registry

R = Registry()


def _folder(t, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(t.spark), f"{name}-{uuid.uuid4().hex}")


@R.query(r"""select page_start as page, cast(length(text) as integer) as chars, false as ocr_used, text from documents where page_start is not null""")
def jsonl_pages(t):
    """Documents as JSON lines of pages, with blank and broken lines between them."""
    d = t.documents.filter("page_start is not null")
    line = F.to_json(F.struct(F.col("page_start").alias("page"), F.length("text").alias("chars"), F.lit(False).alias("ocr_used"), "text"))
    path = _folder(t, "pages")
    d.select(F.explode(F.array(line, F.lit(""), F.lit('{"page": 1, "tex'))).alias("value")).write.text(path)
    return files.page_lines(t.spark, path)


@R.query("""select c_name, c_mktsegment, cast(c_nationkey as varchar) as c_nationkey from customer union all select '', null, null from region where r_regionkey = 0""")
def csv_all_text(t):
    """A delimited table with every cell as text; an empty cell is no null, and a missing file has no rows."""
    path = _folder(t, "csv")
    columns = ["c_name", "c_mktsegment", "c_nationkey"]
    more = t.region.filter("r_regionkey = 0").select(F.lit("").alias("c_name"), F.lit(None).cast("string").alias("c_mktsegment"), F.lit(None).cast("string").alias("c_nationkey"))
    sinks.write_csv(t.customer.select("c_name", "c_mktsegment", F.col("c_nationkey").cast("string")).unionByName(more), path, null="\u0000")
    return files.table_or_empty(t.spark, path, columns).unionByName(files.table_or_empty(t.spark, path + "-absent", columns))


@R.query("""select 'n_regionkey=' || n_regionkey as folder, sum(count(*)) over (partition by n_regionkey) as rows from nation where n_regionkey <> 2 group by n_regionkey""")
def json_per_entity(t):
    """A folder of JSON per region, listed without the denied one and read again."""
    path = _folder(t, "json")
    sinks.write_json_per_entity(t.nation, path, "n_regionkey")
    f = files.with_suffix(files.listing(t.spark, path), ".json")
    kept = files.entity_folders(f, ["n_regionkey=2"])
    rows = t.spark.read.json(path).groupBy(F.concat(F.lit("n_regionkey="), F.col("n_regionkey").cast("string")).alias("folder")).agg(F.count("*").alias("rows"))
    return kept.join(rows, "folder")


@R.query("""select cast(study_row_id as varchar) as study_row_id, coalesce(site_code, 'n/a') as site_code, coalesce(patient_sex, 'n/a') as patient_sex from studies where coalesce(patient_sex, 'x') <> ''""")
def tsv_with_dictionary(t):
    """Tab-separated rows with n/a for nulls beside their dictionary."""
    path = _folder(t, "tsv")
    d = t.studies.filter("coalesce(patient_sex, 'x') <> ''").select("study_row_id", "site_code", "patient_sex")
    sinks.write_tsv_with_dictionary(d, path, "studies", {"site_code": "Site of the study"})
    return files.table_or_empty(t.spark, os.path.join(path, "studies"), ["study_row_id", "site_code", "patient_sex"], sep="\t")


@R.query("""select 'labels' as name, recording_id, trim(label) as value from (select recording_id, unnest(string_split(channel_labels, '|')) as label from recordings)
            union all select 'rates', recording_id, trim(rate) from (select recording_id, unnest(string_split(sample_rates, '|')) as rate from recordings)""")
def fanned_out_tables(t):
    """Two arrays of one record to two tables, written together and read again."""
    path = _folder(t, "tables")
    d = t.recordings.select("recording_id", F.split("channel_labels", r"\|").alias("labels"), F.split("sample_rates", r"\|").alias("rates"))
    made = nested.fan_out(d, {n: (n, [F.col("recording_id"), F.trim("x").alias("value")]) for n in ("labels", "rates")})
    sinks.write_tables(made, path)
    parts = [t.spark.read.parquet(os.path.join(path, n)).select(F.lit(n).alias("name"), "recording_id", "value") for n in made]
    return parts[0].unionByName(parts[1])


@R.query("""select status, count(*) * 2 as n from (select o_orderstatus as status from orders) group by 1""")
def appended_log(t):
    """A log that two runs append to."""
    path = _folder(t, "log")
    for _ in range(2):
        sinks.append_log(t.orders.select(F.col("o_orderstatus").alias("status")), path)
    return t.spark.read.option("header", "true").csv(path).groupBy("status").agg(F.count("*").alias("n"))


@R.query("""select 'sub-' || c_nationkey as subject, 'ses-' || (c_custkey % 3) as session, count(*) as n from customer group by 1, 2""")
def subject_tree(t):
    """Rows below sub-*/ses-* folders; subject and session come from the paths."""
    path = _folder(t, "tree")
    d = t.customer.select(F.concat(F.lit("sub-"), F.col("c_nationkey").cast("string")).alias("sub"), F.concat(F.lit("ses-"), (F.col("c_custkey") % 3).cast("string")).alias("ses"), "c_name")
    sinks.write_subject_tree(d, path)
    rows = t.spark.read.option("header", "true").option("sep", "\t").option("recursiveFileLookup", "true").csv(path)
    p = rows.select(F.regexp_replace(F.regexp_replace(files.plain_path(F.col("_metadata.file_path")), "sub=", ""), "ses=", "").alias("path"))
    return files.session_keys(p, suffix="csv").groupBy("subject", "session").agg(F.count("*").alias("n"))


@R.query("""select event_type, count(*) as n from events where event_type is not null group by 1""")
def shard_totals(t):
    """Counters of four workers' files, summed."""
    path = _folder(t, "shards")
    d = t.events.filter("event_type is not null").groupBy((F.col("event_id") % 4).alias("shard"), "event_type").agg(F.count("*").alias("n"))
    d.repartition("shard").write.partitionBy("shard").option("header", "true").csv(path)
    return files.shard_counters(t.spark, path, "event_type")


@R.query("""with l as (select c_custkey as k, unnest([1, 2, 3]) as no from customer), m as (select k, no, case when no = 2 and k % 2 = 0 then 'done ' || k when no = 3 then 'seen ' || k else '-' end as line from l)
            select k, coalesce(arg_max(line, no) filter (where line like 'done%'), arg_max(line, no) filter (where line like 'seen%')) as line from m group by 1""")
def latest_line_or_next(t):
    """The last line of the first pattern, else of the second."""
    d = t.customer.select(F.col("c_custkey").alias("k"), F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)])).alias("no"))
    k = F.col("k").cast("string")
    line = F.when((F.col("no") == 2) & (F.col("k") % 2 == 0), F.concat(F.lit("done "), k)).when(F.col("no") == 3, F.concat(F.lit("seen "), k)).otherwise("-")
    return files.last_matching(d.withColumn("line", line), "k", "no", "line", "^done", "^seen")


@R.query("""select p_partkey, 'a: ' || p_size || ' [' || case when p_size > 25 then 'H' else '' end || ']; ?: ' || p_brand || ' []' as findings from part""")
def finding_lists(t):
    """Arrays of findings as one text, with defaults for what is absent."""
    item = lambda a, v, f: F.struct(a.alias("analyte"), v.alias("value"), f.alias("flag"))
    none = F.lit(None).cast("string")
    items = F.array(item(F.lit("a"), F.col("p_size").cast("string"), F.when(F.col("p_size") > 25, "H")), item(none, F.col("p_brand"), F.lit("")))
    return t.part.select("p_partkey", scalars.finding_list(items).alias("findings"))


@R.query("""select kind, case kind when 'ECG' then 'ElectroCardioGram' when 'EOG' then 'ElectroOculoGram' when 'EMG' then 'ElectroMyoGram' when 'MISC' then 'Miscellaneous' else 'ElectroEncephaloGram' end as description
            from (select unnest(['EEG', 'ECG', 'EOG', 'EMG', 'MISC', 'other']) as kind)""")
def channel_descriptions(t):
    d = t.region.filter("r_regionkey = 0").select(F.explode(F.array(*[F.lit(x) for x in ("EEG", "ECG", "EOG", "EMG", "MISC", "other")])).alias("kind"))
    return d.select("kind", tx.channel_description(F.col("kind")).alias("description"))
