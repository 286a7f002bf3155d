"""Queries over semi-structured reports: fields, tables, sections, orders, monitoring logs, vocabularies.

The tables hold the contents of such reports, not the reports: each query writes them out
as a report would and reads them again, and its oracle takes the contents from the tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import reports, sections
from .registry import Registry

R = Registry()


def _s(c) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def _line(label: str, c) -> Column:
    """The label's line, left out where the value is blank."""
    v = F.col(c) if isinstance(c, str) else c.cast("string")
    return F.when(F.regexp_replace(F.coalesce(v, F.lit("")), r"\s+", "") != "", F.concat(F.lit(label + " "), v, F.lit("\n"))).otherwise("")


def _squeezed(c: str) -> str:
    return rf"nullif(trim(regexp_replace(regexp_extract({c}, '^\s*([^\n]*)', 1), '\s+', ' ', 'g')), '')"


_CLOCK = "lpad(cast(study_row_id % 24 as varchar), 2, '0') || ':15:00'"
_DAY = "lpad(cast(study_row_id % 12 + 1 as varchar), 2, '0') || '/' || lpad(cast(study_row_id % 28 + 1 as varchar), 2, '0') || '/2024'"


@R.query(rf"""select study_row_id, {_squeezed('patient_name')} as patient_name, {_squeezed('test_type_raw')} as test_type, {_squeezed('duration_hours')} as total_time, {_CLOCK} as eeg_start_time, '23:59' as eeg_end_time, {_DAY} as eeg_start_date, {_DAY} as eeg_end_date,
             cast(study_row_id % 17 as bigint) as n_patient_events, 'n/a for ' || (study_row_id % 3) as n_patient_events_video, nullif(trim(regexp_replace(tech_comments, '\s+', ' ', 'g')), '') as tech_comments,
             cast(study_row_id % 29 as bigint) as n_tech_events, cast(study_row_id % 31 as bigint) as automated_seizures, cast(study_row_id % 37 as bigint) as automated_spikes, {_squeezed('scanning_technologist')} as scanning_technologist from studies""")
def report_header_fields(t):
    """Header fields of a technologist's report for every study."""
    i = F.col("study_row_id")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    day = F.concat(two(i % 12 + 1), F.lit("/"), two(i % 28 + 1), F.lit("/2024"))
    spikes = F.when(i % 2 == 0, "Automated Spike Detections: ").otherwise("Spikes: ")
    text = F.concat(
        F.lit("Technologist Scan Report\n"),
        _line("Patient Name:", "patient_name"),
        _line("Duration/Type of Test Performed:", "test_type_raw"),
        _line("Total Time:", "duration_hours"),
        _line("EEG Start Time:", F.concat(two(i % 24), F.lit(":15:00"))),
        _line("EEG End Time:", F.lit("23:59")),
        _line("EEG Start Date:", day),
        _line("EEG End Date:", day),
        _line("Number of Patient Events:", i % 17),
        _line("Number of Patient Events captured on video:", F.concat(F.lit("n/a for "), (i % 3).cast("string"))),
        _line("Tech Comments:", "tech_comments"),
        _line("Total number of Tech Events:", i % 29),
        _line("Automated Seizure Detections:", i % 31),
        F.concat(spikes, (i % 37).cast("string"), F.lit("\n")),
        _line("SCANNING TECHNOLOGIST:", "scanning_technologist"),
    )
    d = t.studies.select("study_row_id", text.alias("report"))
    return d.select("study_row_id", *[c.alias(n) for n, c in reports.report_header(F.col("report")).items()])


_BODY = {
    "background": "Rhythm of # Hz, second line", "photic_stimulation": "driving # times", "hyperventilation": "build-up after # s", "slowing": "theta in # runs",
    "epileptiform_discharges": "spikes at T# side", "other_abnormal_patterns": "pattern # seen", "seizures": "none in # hours", "technologist_impression": "study # is complete",
}


@R.query(
    "select study_row_id, "
    + ", ".join(("case when study_row_id % 3 <> 0 then {} end" if n == "hyperventilation" else "case when study_row_id % 5 <> 0 then {} end" if n == "seizures" else "{}").format("replace('" + v + "', '#', cast(study_row_id as varchar))") + f" as {n}" for n, v in _BODY.items())
    + " from studies"
)
def report_body_sections(t):
    """The eight sections of a report, some of them absent."""
    i = F.col("study_row_id")
    v = {n: F.replace(F.lit(x), F.lit("#"), i.cast("string")) for n, x in _BODY.items()}
    text = F.concat(
        F.lit("BACKGROUND\n"), F.replace(v["background"], F.lit(", "), F.lit(",\n  ")), F.lit("\nACTIVATIONS\nPhotic Stimulation: "), v["photic_stimulation"], F.when(i % 3 != 0, F.concat(F.lit("\nHV: "), v["hyperventilation"])).otherwise(""),
        F.lit("\nABNORMALITIES\nSlowing:\n"), v["slowing"], F.lit("\nInterictal Epileptiform Discharges: "), v["epileptiform_discharges"], F.lit("\nOther Abnormal Patterns: "), v["other_abnormal_patterns"],
        F.when(i % 5 != 0, F.concat(F.lit("\nSeizures: "), v["seizures"])).otherwise(""), F.lit("\nTECHNOLOGIST IMPRESSION\n"), v["technologist_impression"], F.lit("\nSCANNING TECHNOLOGIST: x"),
    )
    d = t.studies.select("study_row_id", text.alias("report"))
    return d.select("study_row_id", *[c.alias(n) for n, c in reports.report_sections(F.col("report")).items()])


@R.query("""select event_id, k, case when k = 0 then event_id % 9 + 1 else 12 end as count, case when k = 0 then 'Sharp ' || event_type || ' ' || event_id else 'slow waves' end as description
            from (select * from events where event_type is not null), (select unnest([0, 1]) as k)""")
def report_event_table(t):
    """Rows of the event table, with and without a line number and a type."""
    i = F.col("event_id")
    text = F.concat(F.lit("Number of events  Description\n1  "), (i % 9 + 1).cast("string"), F.lit("  Tech Event Type 1: Sharp "), F.col("event_type"), F.lit(" "), i.cast("string"), F.lit("\n12 slow waves\n0 nothing\n"))
    d = reports.event_rows(t.events.filter("event_type is not null").select("event_id", text.alias("report")), "report")
    return d.withColumn("k", F.when(F.col("description") == "slow waves", 1).otherwise(0))


@R.query("""select event_id, 1 as event_number, strftime(ts, '%m/%d/%Y') as date, strftime(ts, '%H:%M') as time, nullif(event_type, '') as description from events
            union all select event_id, 2, strftime(ts, '%m/%d'), strftime(ts, '%H:%M:%S'), 'felt ' || event_type from events where event_type is not null""")
def report_patient_events(t):
    """Events noted by patients: number, date, time and words, quoted or not."""
    e = t.events
    second = F.when(F.col("event_type").isNotNull(), F.concat(F.lit("\nevent 2: "), F.date_format("ts", "MM/dd"), F.lit(" at "), F.date_format("ts", "HH:mm:ss"), F.lit(" felt "), F.col("event_type"))).otherwise("")
    text = F.concat(F.lit("Patient Event #1 - "), F.date_format("ts", "MM/dd/yyyy"), F.lit(" @ "), F.date_format("ts", "HH:mm"), F.lit(' "'), _s("event_type"), F.lit('"'), second)
    return reports.patient_event_rows(e.select("event_id", text.alias("report")), "report").withColumn("event_number", F.col("event_number").cast("int"))


@R.query("""select o_orderkey, cast(o_orderkey as varchar) as accession_number, 'Dr ' || o_custkey as ordering_provider, 'Ambulatory EEG 24-' || (o_orderkey % 72) || ' Hours (Order)' as procedure,
            case when o_orderkey % 4 <> 0 then 'Clinic ' || o_orderstatus end as department, o_orderpriority as primary_diagnosis from orders""")
def order_form_fields(t):
    """The five fields of an order form."""
    i = F.col("o_orderkey").cast("string")
    text = F.concat(
        F.lit("Accession number: "), i, F.lit("\nOrdering provider:  Dr "), F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, "  03/04/2024").otherwise(""), F.lit("\nProcedure: Ambulatory EEG 24-"),
        (F.col("o_orderkey") % 72).cast("string"), F.lit(" Hours (Order)\n"), F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("OCC: Clinic "), F.col("o_orderstatus"), F.lit("\n"))).otherwise(""), F.lit("Primary diagnosis: "), F.col("o_orderpriority"),
    )
    d = t.orders.select("o_orderkey", text.alias("form"))
    return d.select("o_orderkey", *[c.alias(n) for n, c in reports.order_fields(F.col("form")).items()])


def _logs(t):
    """A log of three hours per customer: reviewers and batteries beside the hour or below it, notes, a hour switched off."""
    i = F.col("c_custkey")
    n = lambda c: c.cast("string")
    text = F.concat(
        F.lit("Record On  Impedance\n03/0"), n(i % 9 + 1), F.lit(" 11:00 PM - 12:00 AM CST  Yes  "), n(i % 40), F.lit(" kOhm - mira - 03/04/2024 10:11 AM\n  "), n(i % 101),
        F.lit("\nEEGReview ed: seen by W, Felicia Manes REEGT\n04/10 12:00 AM - 1:00 AM   No "), n(i % 90 + 10),
        F.lit("\nGeneralNote: battery changed\nlena - 04/11/2024 1:02:03 PM\nrosa - 04/12/2024 2:02 PM\n04/10 1:00 AM - 2:00 AM EDT Yes\nEquipmentFailure: lead off, Bo R. EEG T\n"),
    )
    return t.customer.select("c_custkey", text.alias("log"))


@R.query("""select c_custkey, cast(1 as bigint) as n_eeg_reviewed_notes, cast(1 as bigint) as n_general_notes, cast(1 as bigint) as n_equipment_failures, '03/0' || (c_custkey % 9 + 1) as date_range_first, '04/10' as date_range_last, cast(2 as bigint) as n_distinct_days,
            'lena,mira,rosa' as distinct_reviewers from customer""")
def monitoring_summary(t):
    return _logs(t).select("c_custkey", *[c.alias(n) for n, c in reports.log_summary(F.col("log")).items()])


@R.query("""select c_custkey, cast(1 as bigint) as record, '03/0' || (c_custkey % 9 + 1) as date, '11:00 PM' as time_start, '12:00 AM' as time_end, 'CST' as timezone, true as recording_on, (c_custkey % 40) || ' kOhm' as impedance, cast(c_custkey % 101 as integer) as battery_pct, 'mira' as reviewer_name, '03/04/2024 10:11 AM' as review_timestamp from customer
            union all select c_custkey, 2, '04/10', '12:00 AM', '1:00 AM', null, false, null, cast(c_custkey % 90 + 10 as integer), 'lena', '04/11/2024 1:02:03 PM' from customer
            union all select c_custkey, 3, '04/10', '1:00 AM', '2:00 AM', 'EDT', true, null, null, null, null from customer""")
def monitoring_hour_rows(t):
    """Hours of monitoring logs with what belongs to them."""
    return reports.log_hours(_logs(t), "c_custkey", "log").drop("line_no")


@R.query("""select c_custkey, 'eeg_reviewed' as event_type, 'seen by W, Felicia Manes REEGT' as description, '03/0' || (c_custkey % 9 + 1) as date, '11:00 PM' as hour_start, 'Felicia Manes' as reviewer_name from customer
            union all select c_custkey, 'general_note', 'battery changed', '04/10', '12:00 AM', null from customer
            union all select c_custkey, 'equipment_failure', 'lead off, Bo R. EEG T', '04/10', '1:00 AM', 'Bo' from customer""")
def monitoring_events(t):
    """Events of monitoring logs with their hour and the reviewer in front of a credential."""
    return reports.log_events(_logs(t), "c_custkey", "log").drop("line_no")


@R.query("""select c_custkey, case c_custkey % 4 when 0 then 'regex' when 1 then 'skip' when 2 then 'no_extractor' else 'regex_error' end as method, case when c_custkey % 4 = 0 then cast(c_custkey as varchar) end as accession_number, c_custkey % 4 = 3 as failed from customer""")
def section_extraction(t):
    """A section's fields by the extractor of its type; one that fails marks its own rows alone."""
    i = F.col("c_custkey")
    kind = F.when(i % 4 == 0, "eeg_order").when(i % 4 == 1, "hipaa_consent").when(i % 4 == 2, "imaging_report").otherwise("broken")
    d = t.customer.select("c_custkey", kind.alias("doc_type"), F.concat(F.lit("Accession number: "), i.cast("string")).alias("text"))
    e = reports.extract(d, "doc_type", "text", reports.EXTRACTORS | {"broken": lambda c: {"x": F.col("no_such_column")}})
    return e.select("c_custkey", "method", F.get_json_object("fields", "$.accession_number").alias("accession_number"), F.col("error").isNotNull().alias("failed"))


_ASM_SQL = "[" + ", ".join(f"'{n}'" for n in tx.SEIZURE_DRUGS) + "]"
_BRAND_SQL = "map {" + ", ".join(f"'{a}': '{b}'" for a, b in tx.BRANDS.items()) + "}"
_ALIAS_SQL = "map {" + ", ".join(f"'{a}': '{b}'" for a, b in tx.CONDITION_ALIASES.items()) + "}"


@R.query(rf"""with m as (select medication_row_id as id, lower(name) as n from (select medication_row_id, name from medications union all select -p_partkey, list_extract({_ASM_SQL}, cast(p_partkey % {len(tx.SEIZURE_DRUGS)} + 1 as integer)) || ' ' || p_size || ' mg' from part)),
             k as (select *, regexp_extract(trim(n), '^[a-z]+') as w from m where len(list_filter({_ASM_SQL}, lambda a: contains(n, a))) > 0)
             select case when w = '' then trim(n) else coalesce({_BRAND_SQL}[w], w) end as generic, count(*) as n from k group by 1""")
def generic_drugs(t):
    """Anti-seizure drugs among entries, brand names by their generic one."""
    listed = F.array(*[F.lit(x) for x in tx.SEIZURE_DRUGS])
    made = t.part.select(F.concat(F.get(listed, (F.col("p_partkey") % len(tx.SEIZURE_DRUGS)).cast("int")), F.lit(" "), F.col("p_size").cast("string"), F.lit(" mg")).alias("name"))
    d = t.medications.select("name").unionByName(made)
    return d.select(tx.generic_drug(F.col("name")).alias("generic")).filter("generic is not null").groupBy("generic").agg(F.count("*").alias("n"))


@R.query(rf"""with c as (select trim(lower(condition_name)) as c from comorbidities where condition_name is not null)
             select coalesce({_ALIAS_SQL}[c], c) as condition, count(*) as n from c where not contains(c, 'seizure') and not contains(c, 'epilepsy') group by 1""")
def condition_names(t):
    """Conditions under one name, without those the records are about."""
    return t.comorbidities.select(tx.condition_name(F.col("condition_name")).alias("condition")).filter("condition is not null").groupBy("condition").agg(F.count("*").alias("n"))


@R.query("""select event_id, (case when h % 12 = 0 then 12 else h % 12 end) || ':05 ' || (case when h < 12 then 'AM' else 'pm' end) as clock, h as hour from (select event_id, cast(extract(hour from ts) as integer) as h from events)""")
def clock_hours(t):
    """12-hour clock times read as hours of the day."""
    from ..functions import dates

    h = F.hour("ts")
    shown = F.concat(F.when(h % 12 == 0, 12).otherwise(h % 12).cast("string"), F.lit(":05 "), F.when(h < 12, "AM").otherwise("pm"))
    return t.events.select("event_id", shown.alias("clock")).select("event_id", "clock", dates.clock_hour(F.col("clock")).alias("hour"))


@R.query(r"""with l as (select doc_id, string_split(text, chr(10)) as a from documents where text is not null), e as (select doc_id, generate_subscripts(a, 1) as no, unnest(a) as line from l)
             select doc_id, arg_min(m, no) as first_dose, arg_max(m, no) as last_dose from (select doc_id, no, regexp_extract(line, '([0-9]+) mg', 1) as m from e where regexp_matches(line, '[0-9]+ mg')) group by 1""")
def first_and_last(t):
    """The first and the last dose of a text in document order."""
    d = t.documents.filter("text is not null").select("doc_id", F.transform(F.filter(F.split("text", "\n"), lambda x: x.rlike("[0-9]+ mg")), lambda x: F.regexp_extract(x, "([0-9]+) mg", 1)).alias("m"))
    return d.filter(F.size("m") > 0).select("doc_id", F.get("m", F.lit(0)).alias("first_dose"), F.element_at("m", -1).alias("last_dose"))
