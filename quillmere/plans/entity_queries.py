"""Queries over names, ids, links and dates of patients, packets and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, names, scalars
from ..functions import text as tx
from ..operators import identity, nested, resolution
from ..sources import sinks
from .registry import Registry

R = Registry()

_STRICT = r"^([^,]+),\s*([^\d]+?)\s+(\d{2}-\d{4,5})\s*(.*)$"
_NORM = r"trim(regexp_replace(trim(regexp_replace(regexp_replace(trim(lower({0})), '[,.\-''\"()\[\]]+', ' ', 'g'), '\s+', ' ', 'g')), '\b(jr|sr|ii|iii|iv)\b', '', 'g'))"
_LAST = "trim(string_split(regexp_replace(study_id, '-\\d+$', ''), ',')[1])"
_FIRST = "coalesce(trim(substr(regexp_replace(study_id, '-\\d+$', ''), nullif(strpos(regexp_replace(study_id, '-\\d+$', ''), ','), 0) + 1)), '')"


@R.query(rf"""select distinct folder_name, case when regexp_matches(folder_name, '{_STRICT}') then trim(regexp_extract(folder_name, '{_STRICT}', 1)) else '' end as last_name,
              case when regexp_matches(folder_name, '{_STRICT}') then trim(regexp_extract(folder_name, '{_STRICT}', 2)) else '' end as first_name,
              case when regexp_matches(folder_name, '{_STRICT}') then regexp_extract(folder_name, '{_STRICT}', 3) else '' end as case_id,
              case when regexp_matches(folder_name, '{_STRICT}') then trim(regexp_extract(folder_name, '{_STRICT}', 4)) else folder_name end as suffix from recordings where folder_name is not null""")
def parse_entity_name(t):
    d = t.recordings.select("folder_name").filter("folder_name is not null").distinct()
    return d.select("folder_name", *[c.alias(n) for n, c in names.strict_folder(F.col("folder_name")).items()])


@R.query(r"""with d as (select distinct folder_name as f from recordings where folder_name is not null),
             p as (select f, regexp_matches(f, '^([^,.]+)[,.\s]+\s*([^\d]+?)\s+(\d{2}\s*-+\s*\d{4,5})\s*(.*)$') as a, regexp_matches(f, '^([^,]+),\s*(\S+)\s+(.*)$') as b from d)
             select f as folder_name, case when a then trim(regexp_extract(f, '^([^,.]+)[,.\s]+\s*([^\d]+?)\s+(\d{2}\s*-+\s*\d{4,5})\s*(.*)$', 1)) when b then trim(regexp_extract(f, '^([^,]+),\s*(\S+)\s+(.*)$', 1)) end as last_name,
             case when a then replace(regexp_extract(f, '^([^,.]+)[,.\s]+\s*([^\d]+?)\s+(\d{2}\s*-+\s*\d{4,5})\s*(.*)$', 3), ' ', '') when b then 'UNKNOWN' end as case_id from p""")
def parse_loose_folder(t):
    d = t.recordings.select("folder_name").filter("folder_name is not null").distinct()
    p = names.loose_folder(F.col("folder_name"))
    return d.select("folder_name", p["last_name"].alias("last_name"), p["case_id"].alias("case_id"))


@R.query(rf"""with s as (select distinct study_id from studies where study_id is not null), p as (select study_id, {_LAST} as l, case when strpos(study_id, ',') = 0 then '' else {_FIRST} end as f from s)
              select study_id, concat_ws('|', lower(l), lower(f)) as exact_key, concat_ws('|', {_NORM.format('l')}, {_NORM.format('f')}) as norm_key, concat_ws('|', {_NORM.format('l')}, string_split({_NORM.format('f')}, ' ')[1]) as root_key from p""")
def name_normalize_keys(t):
    d = t.studies.select("study_id").filter("study_id is not null").distinct()
    p = names.packet_parts(F.col("study_id"))
    return d.select("study_id", *[c.alias(k) for k, c in names.keys(p["last"], p["first"]).items()])


@R.query("""select distinct study_id, lower(trim(regexp_replace(study_id, '-\\d+$', ''))) as patient_key from studies where study_id is not null""")
def patient_keys(t):
    return t.studies.select("study_id", names.patient_key(F.col("study_id")).alias("patient_key")).filter("study_id is not null").distinct()


@R.query("""select c_custkey, concat('sub-', replace(concat(c_mktsegment, '-', cast(c_custkey as varchar)), '-', '')) as participant_id from customer""")
def participant_ids(t):
    return t.customer.select("c_custkey", names.participant(F.concat_ws("-", "c_mktsegment", F.col("c_custkey").cast("string"))).alias("participant_id"))


@R.query("""with a as (select p_partkey as left_id, p_name, lower(p_name) as k from part), r as (select min(p_partkey) as id, p_name, lower(p_name) as k from part group by 2, 3),
            l as (select left_id, case when left_id % 4 = 0 then upper(k) when left_id % 4 = 1 then replace(k, ' ', '-') when left_id % 4 = 2 then concat(substr(k, 1, 3), 'q', substr(k, 4)) else concat('zz ', reverse(k)) end as name from a),
            n as (select left_id, lower(trim(name)) as e, trim(regexp_replace(regexp_replace(lower(trim(name)), '[,.\\-]+', ' ', 'g'), '\\s+', ' ', 'g')) as m from l),
            f as (select n.left_id, arg_min(r.id, (levenshtein(n.m, r.k), r.id)) as id, min(levenshtein(n.m, r.k)) as d from n join r on substr(n.m, 1, 1) = substr(r.k, 1, 1) and levenshtein(n.m, r.k) <= 2 group by 1)
            select n.left_id, coalesce(x.id, y.id, f.id) as ref_id, case when x.id is not null then 'exact' when y.id is not null then 'normalized' when f.id is not null then concat('levenshtein_d', cast(f.d as varchar)) else 'unmatched' end as method,
            case when x.id is not null or y.id is not null then 'high' when f.id is null then '' when f.d <= 1 then 'medium' else 'low' end as confidence
            from n left join r x on n.e = x.k left join r y on n.m = y.k left join f on n.left_id = f.left_id""")
def tiered_match(t):
    """Part names, changed in case, punctuation and spelling, resolved to the first part of the name."""
    k, i = F.lower("p_name"), F.col("p_partkey")
    changed = F.when(i % 4 == 0, F.upper(k)).when(i % 4 == 1, F.replace(k, F.lit(" "), F.lit("-"))).when(i % 4 == 2, F.concat(F.substring(k, 1, 3), F.lit("q"), F.substr(k, F.lit(4)))).otherwise(F.concat(F.lit("zz "), F.reverse(k)))
    key = lambda c: {"exact_key": F.lower(F.trim(c)), "norm_key": names.normalise(c), "root_key": names.normalise(c)}
    left = t.part.select(i.alias("left_id"), *[c.alias(n) for n, c in key(changed).items()])
    ref = t.part.groupBy("p_name").agg(F.min("p_partkey").alias("ref_id")).select("ref_id", F.col("ref_id").alias("ref_order"), *[c.alias(n) for n, c in key(F.col("p_name")).items()])
    return resolution.tiered_match(left, ref)


@R.query("""with k as (select distinct lower(trim(patient_name)) as k from recordings where patient_name <> '' and trim(patient_name) <> ''), n as (select k, row_number() over (order by k) as number from k)
            select k as name_key, cast(number as bigint) as number, concat('P-', cast(number as varchar)) as id,
            cast(cast(concat('0x', substr(md5(concat('quillmere', k)), 1, 8)) as bigint) % 731 - 365 as integer) as shift_days from n""")
def dense_ids_shift(t):
    d = t.recordings.select(F.lower(F.trim("patient_name")).alias("name_key")).filter("name_key <> ''")
    return identity.dense_ids(d, "name_key")


@R.query("""with m as (select max(o_custkey) as top from orders), f as (select c_custkey from customer where c_custkey not in (select o_custkey from orders)),
            n as (select cast(c_custkey as varchar) as k from f) select k as name, concat('P-', cast(row_number() over (order by k) + (select top from m) as varchar)) as id from n""")
def unmatched_new_ids(t):
    """Customers without orders get ids that go on behind the greatest one given."""
    given = t.orders.select(F.col("o_custkey").cast("string").alias("name")).distinct().withColumn("id", F.concat(F.lit("P-"), "name"))
    new = t.customer.select(F.col("c_custkey").cast("string").alias("name"))
    return identity.continued_ids(given, new, "name").select("name", "id")


@R.query("""with n as (select o_custkey, o_orderkey, count(l_linenumber) as n from orders left join lineitem on o_orderkey = l_orderkey group by 1, 2)
            select o_custkey, o_orderkey, n, cast(coalesce(sum(n) over (partition by o_custkey order by o_orderkey rows between unbounded preceding and 1 preceding), 0) + 1 as bigint) as session_start from n""")
def session_numbering(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count("l_linenumber").alias("c"))
    n = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_custkey", "o_orderkey", F.coalesce("c", F.lit(0)).alias("n"))
    return identity.session_starts(n, "o_custkey", ["o_orderkey"], "n")


@R.query("""with r as (select o_custkey, o_orderkey, o_totalprice, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as position from orders)
            select o_custkey, o_orderkey, position from r where o_totalprice > 100000""")
def filtered_then_numbered(t):
    """Numbers are given before the filter, so skipped rows keep their number."""
    return identity.numbered(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).filter("o_totalprice > 100000").select("o_custkey", "o_orderkey", F.col("position").cast("bigint").alias("position"))


@R.query("""select study_id, study_row_id from (select *, row_number() over (partition by study_id order by loaded_at, study_row_id) as r from studies where study_id is not null) where r = 1""")
def dedup_keep_first(t):
    return identity.keep_first(t.studies.filter("study_id is not null"), ["study_id"], ["loaded_at", "study_row_id"]).select("study_id", "study_row_id")


@R.query("""select study_id, study_row_id, c as copies from (select *, count(*) over (partition by study_id) as c from studies where study_id is not null) where c > 1""")
def duplicate_report(t):
    return resolution.duplicated(t.studies.filter("study_id is not null"), "study_id").select("study_id", "study_row_id", "copies")


@R.query("""select c_custkey, substr(sha1(lower(trim(c_name))), 1, 6) as pseudonym from customer""")
def short_hash_pseudonym(t):
    return t.customer.select("c_custkey", tx.short_hash(F.col("c_name")).alias("pseudonym"))


@R.query("""with h as (select c_custkey, list_transform([1, 9, 17, 25], lambda i: cast('0x' || substr(md5(c_name), i, 8) as bigint)) as p from customer)
            select c_custkey, cast(((((p[1] % 7) * 4 + p[2]) % 7 * 4 + p[3]) % 7 * 4 + p[4]) % 7 as integer) as bucket from h""")
def hash_bucket(t):
    """128-bit md5 modulo 7; the oracle takes eight digits at a time, as 2^32 is 4 modulo 7."""
    return t.customer.select("c_custkey", tx.hash_bucket(F.col("c_name"), 7).alias("bucket"))


@R.query("""select o_orderkey, o_orderdate + to_days(cast(o_custkey % 731 - 365 as integer)) as shifted from orders""")
def date_shift_column(t):
    return t.orders.select("o_orderkey", F.expr("o_orderdate + make_dt_interval(cast(o_custkey % 731 - 365 as int))").alias("shifted"))


@R.query("""select o_orderkey, concat('seen ', strftime(o_orderdate + interval 10 day, '%m/%d/%Y'), ' and ', strftime(o_orderdate + interval 10 day, '%Y-%m-%d'), '.') as note from orders""")
def date_shift_text(t):
    d = t.orders.select("o_orderkey", F.concat(F.lit("seen "), F.date_format("o_orderdate", "MM/dd/yyyy"), F.lit(" and "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".")).alias("note"))
    return d.select("o_orderkey", dates.shift_dates_in_text(F.col("note"), F.lit(10)).alias("note"))


@R.query("""select o_orderkey, cast(o_orderdate as date) as d from orders""")
def multi_format_dates(t):
    """Order dates written in three notations and read again."""
    k = F.col("o_orderkey") % 3
    shown = F.when(k == 0, F.date_format("o_orderdate", "MM/dd/yyyy")).when(k == 1, F.date_format("o_orderdate", "M/d/yy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", dates.parse_date(shown).alias("d"))


@R.query("""with a as (select o_orderkey, round_even(date_diff('day', date '1905-03-01' + cast(o_custkey % 36000 as integer), cast(o_orderdate as date)) / 365.25, 1) as age from orders)
            select o_orderkey, case when age > 0 and age < 120 then least(age, 90.0) end as age from a""")
def age_topcode(t):
    born = F.date_add(F.lit("1905-03-01").cast("date"), (F.col("o_custkey") % 36000).cast("int"))
    return t.orders.select("o_orderkey", dates.top_coded(dates.age_years(born, F.to_date("o_orderdate"))).alias("age"))


@R.query("""select event_id, ts + to_microseconds(cast(round(value * 1000000) as bigint)) as at from events""")
def relative_to_absolute_ts(t):
    return t.events.select("event_id", dates.at_offset(F.col("ts"), F.col("value")).cast("timestamp_ntz").alias("at"))


@R.query("""select study_id, first_dob from (select study_id, arg_min(patient_dob, (loaded_at, study_row_id)) filter (where patient_dob is not null and trim(patient_dob) <> '') as first_dob from studies where study_id is not null group by 1)""")
def earliest_first_seen(t):
    ok = F.trim("patient_dob") != ""
    return t.studies.filter("study_id is not null").groupBy("study_id").agg(F.min_by("patient_dob", F.when(ok, F.struct("loaded_at", "study_row_id"))).alias("first_dob"))


@R.query("""select l.medication_row_id, s.eeg from medications l left join (select study_id, min(eeg_start_time) as eeg from studies group by 1) s on l.study_id = s.study_id""")
def any_visit_attach(t):
    s = t.studies.groupBy("study_id").agg(F.min("eeg_start_time").alias("eeg"))
    return t.medications.select("medication_row_id", "study_id").join(s, "study_id", "left").select("medication_row_id", "eeg")


@R.query("""select s.study_row_id, x.pid as person_id, s.site_code, s.patient_sex from studies s join (select study_id, md5(study_id) as pid from studies where study_id is not null and site_code <> 'NRB' group by 1) x on s.study_id = x.study_id""")
def whitelist_remap(t):
    x = t.studies.filter("study_id is not null and site_code <> 'NRB'").select("study_id", F.md5("study_id").alias("person_id")).distinct()
    return nested.whitelist(t.studies, x, "study_id", ["study_row_id", "site_code", "patient_sex", "absent_column"])


@R.query("""select coalesce(m.study_id, c.study_id) as study_id, m.n as medications, c.n as conditions from (select study_id, count(*) as n from medications where study_id is not null group by 1) m
            full outer join (select study_id, count(*) as n from comorbidities where study_id is not null group by 1) c on m.study_id = c.study_id""")
def outer_merge(t):
    m = t.medications.filter("study_id is not null").groupBy("study_id").agg(F.count("*").alias("medications"))
    return m.join(t.comorbidities.filter("study_id is not null").groupBy("study_id").agg(F.count("*").alias("conditions")), "study_id", "full_outer")


@R.query("""select count(*) as n from studies where study_id in (select study_id from medications) and study_id not in (select study_id from comorbidities where study_id is not null)""")
def semi_published(t):
    s = t.studies.filter("study_id is not null")
    return s.join(t.medications.select("study_id"), "study_id", "left_semi").join(t.comorbidities.select("study_id"), "study_id", "left_anti").agg(F.count("*").alias("n"))


@R.query("""select id from (select study_id as id from studies intersect (select study_id from medications union select study_id from comorbidities)) where id is not null
            except select study_id from eeg_epileptiform where study_id is not null""")
def id_set_algebra(t):
    ids = lambda d: d.select(F.col("study_id").alias("id")).filter("id is not null")
    return ids(t.studies).intersect(ids(t.medications).union(ids(t.comorbidities))).subtract(ids(t.eeg_epileptiform))


@R.query("""select key, arg_min(source, priority) as source, arg_min(name, priority) as name from (select c_nationkey as key, 'customer' as source, 0 as priority, min(c_name) as name from customer group by 1
            union all select s_nationkey, 'supplier', 1, min(s_name) from supplier group by 1) group by 1""")
def union_provenance(t):
    c = t.customer.groupBy(F.col("c_nationkey").alias("key")).agg(F.min("c_name").alias("name"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("key")).agg(F.min("s_name").alias("name"))
    u = resolution.union_labelled([("customer", c), ("supplier", s)])
    return u.groupBy("key").agg(F.min_by("source", "priority").alias("source"), F.min_by("name", "priority").alias("name"))


@R.query("""select a.annotation_id, r.recording_id from annotations a join (select folder_name, regexp_replace(edf_filename, '\\.[^.]*$', '') as stem, min(recording_id) as recording_id from recordings group by 1, 2) r
            on a.folder_name = r.folder_name and regexp_replace(a.matched_edf, '\\.[^.]*$', '') = r.stem""")
def stem_join(t):
    r = t.recordings.groupBy("folder_name", F.regexp_replace("edf_filename", r"\.[^.]*$", "").alias("stem")).agg(F.min("recording_id").alias("recording_id"))
    return t.annotations.select("annotation_id", "folder_name", F.regexp_replace("matched_edf", r"\.[^.]*$", "").alias("stem")).join(r, ["folder_name", "stem"]).select("annotation_id", "recording_id")


@R.query("""with n as (select study_row_id, regexp_replace(source_pdf, '[^A-Za-z0-9._-]+', '_', 'g') as f from studies where source_pdf is not null),
            v as (select *, row_number() over (partition by f order by study_row_id) as r from n)
            select study_row_id, case when r = 1 then f else concat(regexp_replace(f, '\\.[^.]*$', ''), '_ses', cast(r as varchar), '_', regexp_extract(f, '(\\.[^.]*)$', 1)) end as file from v""")
def versioned_name(t):
    d = t.studies.filter("source_pdf is not null").select("study_row_id", scalars.safe_file_name(F.col("source_pdf")).alias("file"))
    return sinks.versioned(d, ["file"], ["study_row_id"], "file")


@R.query("""select study_row_id, case when lower(trim(patient_sex)) in ('m', 'male') then 'Male' when lower(trim(patient_sex)) in ('f', 'female') then 'Female'
            when lower(trim(patient_sex)) in ('', 'x', 'n/a', 'unknown', 'none', 'nan') or patient_sex is null then null else 'Other' end as sex from studies""")
def sex_vocabulary(t):
    return t.studies.select("study_row_id", tx.sex_name(F.col("patient_sex")).alias("sex"))
