"""Fields, tables and sections of semi-structured reports, orders and monitoring logs.

Every field is a Column over the text, so a whole report is one wide projection without a
shuffle. Tables inside a text become arrays and rows by ``explode``. Logs are lines with a
state (the hour a line belongs to) and go through ``sections.attach_state``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from . import sections

# Labels of the report's header lines. Kinds: 'text' squeezes white space, 'plain' trims, 'int' reads a number.
HEADER_FIELDS = [
    ("patient_name", r"Patient Name:\s*([^\n]+)", "text"),
    ("test_type", r"(?:Duration/)?Type of Test Performed:\s*([^\n]+)", "text"),
    ("total_time", r"Total Time[:\s]+([^\n]+)", "text"),
    ("eeg_start_time", r"EEG Start Time:\s*([0-9:]{4,8})", "plain"),
    ("eeg_end_time", r"EEG End Time:\s*([0-9:]{4,8})", "plain"),
    ("eeg_start_date", r"EEG Start Date:\s*([0-9/]{8,10})", "plain"),
    ("eeg_end_date", r"EEG End Date:\s*([0-9/]{8,10})", "plain"),
    ("n_patient_events", r"Number of Patient Events:\s*(\d+)", "int"),
    ("n_patient_events_video", r"Number of Patient Events captured on video:\s*([^\n]+)", "text"),
    ("tech_comments", r"Tech Comments:\s*([\s\S]+?)(?:\n\s*(?:Total number|Was video|Were there|Number of Tech|Automated|Tech Events)|\z)", "text"),
    ("n_tech_events", r"(?:Total number of Tech Events|Tech Events Total #):\s*(\d+)", "int"),
    ("automated_seizures", r"Automated Seizure (?:Detection|Detections):\s*(\d+)", "int"),
    ("automated_spikes", r"Automated Spike (?:Detection|Detections):?\s*(\d+)", "int"),
    ("spikes", r"\bSpikes:\s*(\d+)", "int"),
    ("scanning_technologist", r"SCANNING TECHNOLOGIST:\s*([^\n]+)", "text"),
]

# Where each section of a report begins and what ends it; True where a finding is cut at a following heading.
REPORT_SECTIONS = [
    ("background", r"(?:BACKGROUND|Awake\b)[^\n]*\n", [r"\nACTIVATION", r"\nPhotic Stimulation\b", r"\nABNORMALITIES\b", r"\nTECHNOLOGIST IMPRESSION\b", r"\nTechnical Description\b", r"\nTechnologist Scan Report\b", r"\nPatient Name:\s"], False),
    ("photic_stimulation", r"Photic Stimulation[:\s]*", [r"\nHV\b", r"\nHyperventilation\b", r"\nPain\b", r"\nABNORMALITIES\b", r"\nTECHNOLOGIST IMPRESSION\b", r"\nTechnical Description\b"], False),
    ("hyperventilation", r"\bHV[:\s]+", [r"\nPain Stimulation\b", r"\nABNORMALITIES\b", r"\nPhotic\b", r"\nTECHNOLOGIST IMPRESSION\b"], False),
    ("slowing", r"(?:Abnormal\s+)?Slowing[:\s]*", [r"\n(?:Interictal\s+)?Epileptiform\b", r"\nOther Abnormal\b", r"\nSeizures?\b", r"\nTECHNOLOGIST IMPRESSION\b", r"\nBreach\b", r"\nTechnical Description\b"], True),
    ("epileptiform_discharges", r"(?:Interictal\s+)?Epileptiform (?:Discharges|Activity)[:\s]*", [r"\nOther Abnormal\b", r"\nSeizures?\b", r"\nBreach\b", r"\nTECHNOLOGIST IMPRESSION\b", r"\nTechnical Description\b"], True),
    ("other_abnormal_patterns", r"Other Abnormal Patterns[:\s]*", [r"\nSeizures?\b", r"\nTECHNOLOGIST IMPRESSION\b", r"\nBreach\b", r"\nTechnical Description\b"], False),
    ("seizures", r"(?<!Automated )(?<!Detection)\bSeizures?\s*:\s*\n?", [r"TECHNOLOGIST IMPRESSION\b", r"\nSCANNING TECHNOLOGIST\b", r"\nTechnical Description\b", r"\nTechnologist Scan Report\b", r"\nPatient Name:\s", r"\nBreach\b"], True),
    ("technologist_impression", r"TECHNOLOGIST IMPRESSION\s*\n+", [r"\nSCANNING TECHNOLOGIST\b", r"\nTechnical Description\b", r"\nTechnologist Scan Report\b"], False),
]

# Rows of the report's tables, of orders and of monitoring logs.
EVENT_ROW = r"(?md)(?:^\s*\d+\s+)?(\d+)\s+(Tech Event Type \d+:\s*(.+)|(.+))"
PATIENT_EVENT = r"(?id)(?:Patient\s+)?Event\s*#?\s*(\d+)\s*[-:]?\s*(\d{1,2}/\d{1,2}(?:/\d{2,4})?)\s*(?:@|at\s*)?\s*(\d{1,2}:\d{2}(?::\d{2})?)\s*(?:\"([^\"]*)\"|(.*))"
ORDER_FIELDS = [
    ("accession_number", r"Accession number:\s*(\d+)", "plain"),
    ("ordering_provider", r"Ordering provider:\s*([^\n]+?)(?:\s+\d{2}/\d{2}/\d{2,4}|\n)", "text"),
    ("procedure", r"(Ambulatory EEG \d+-\d+ Hours[^\n]*)", "text"),
    ("department", r"OCC:\s*([^\n]+)", "text"),
    ("primary_diagnosis", r"Primary diagnosis:\s*([^\n]+)", "text"),
]
LOG_NOTES = [("n_eeg_reviewed_notes", r"EEGReview\s*ed:"), ("n_general_notes", "GeneralNote:"), ("n_equipment_failures", "EquipmentFailure:")]
LOG_DATE = r"\b(\d{2}/\d{2})\b(?=\s+\d{1,2}:\d{2})"
LOG_REVIEWER = r"\b([A-Za-z][a-zA-Z]{2,})\s*[-]\s*\d{2}/\d{2}/\d{2,4}"
LOG_HOUR = r"(?i)(\d{2}/\d{2})\s+(\d{1,2}:\d{2}\s*(?:AM|PM))\s*-\s*(\d{1,2}:\d{2}\s*(?:AM|PM))\s*(CST|CDT|EST|EDT|MST|MDT|PST|PDT)?\s+(Yes|No)"
LOG_REVIEW = r"(?i)([A-Za-z][A-Za-z]{1,20})\s*-\s*(\d{2}/\d{2}/\d{2,4})\s+(\d{1,2}:\d{2}(?::\d{2})?\s*(?:AM|PM))"
LOG_EVENT = r"(?i)(EEGReview\s*ed|GeneralNote|EquipmentFailure|SpikeDetection|SeizureDetection):\s*(.*)"
LOG_EVENTS = {"generalnote": "general_note", "equipmentfailure": "equipment_failure", "spikedetection": "spike_detection", "seizuredetection": "seizure_detection"}
CREDENTIALLED = r"([A-Z][a-zA-Z]+(?:\s+[A-Z][a-zA-Z]+)?)\s+(?:R\.?\s*EEG\s*T|REEGT|RPSGT|CLTM)"
MOST_REVIEWERS = 25


def _read(text: Column, pattern: str, kind: str) -> Column:
    got = tx.first_group(text, pattern)
    return {"text": tx.squeeze(got), "plain": got, "int": got.try_cast("bigint")}[kind]


def report_header(text: Column) -> dict[str, Column]:
    """The header fields; spike counts fall back to their short label. Absent fields are null."""
    fields = {n: _read(text, p, k) for n, p, k in HEADER_FIELDS}
    fields["automated_spikes"] = F.coalesce(fields["automated_spikes"], fields.pop("spikes"))
    return fields


def report_sections(text: Column) -> dict[str, Column]:
    """The sections from behind their heading to the earliest end; absent ones are null."""
    return {n: (tx.truncate_at if finding else lambda c: c)(tx.squeeze(tx.between(text, start, ends))) for n, start, ends, finding in REPORT_SECTIONS}


def _groups(text: Column, pattern: str, *numbers: int) -> Column:
    return F.arrays_zip(*[F.regexp_extract_all(text, F.lit(pattern), F.lit(n)).alias(f"g{n}") for n in numbers])


def event_rows(df: DataFrame, text: str) -> DataFrame:
    """The other columns with ``count`` and ``description``, a row for each line of the event table."""
    rest = [c for c in df.columns if c != text]
    d = df.select(*rest, F.explode(_groups(F.col(text), EVENT_ROW, 1, 3, 4)).alias("e"))
    d = d.select(*rest, F.col("e.g1").try_cast("bigint").alias("count"), F.trim(F.coalesce(F.nullif(F.col("e.g3"), F.lit("")), F.col("e.g4"))).alias("description"))
    return d.filter("count > 0 and description <> ''")


def patient_event_rows(df: DataFrame, text: str) -> DataFrame:
    """The other columns with number, date, time and description of each event that the patient noted."""
    rest = [c for c in df.columns if c != text]
    d = df.select(*rest, F.explode(_groups(F.col(text), PATIENT_EVENT, 1, 2, 3, 4, 5)).alias("e"))
    said = F.nullif(F.trim(F.coalesce(F.nullif(F.col("e.g4"), F.lit("")), F.col("e.g5"))), F.lit(""))
    return d.select(*rest, F.col("e.g1").try_cast("bigint").alias("event_number"), F.col("e.g2").alias("date"), F.col("e.g3").alias("time"), said.alias("description"))


def order_fields(text: Column) -> dict[str, Column]:
    return {n: _read(text, p, k) for n, p, k in ORDER_FIELDS}


def log_summary(text: Column) -> dict[str, Column]:
    """Counts of notes, first and last date, days and the first 25 reviewers by name."""
    dates = F.regexp_extract_all(text, F.lit(LOG_DATE), F.lit(1))
    reviewers = F.slice(F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(LOG_REVIEWER), F.lit(1)))), 1, MOST_REVIEWERS)
    return {n: F.regexp_count(text, F.lit(p)).cast("bigint") for n, p in LOG_NOTES} | {
        "date_range_first": F.get(dates, F.lit(0)),
        "date_range_last": F.try_element_at(dates, F.lit(-1)),
        "n_distinct_days": F.size(F.array_distinct(dates)).cast("bigint"),
        "distinct_reviewers": F.array_join(reviewers, ","),
    }


def _lines(df: DataFrame, packet: str, text: str) -> DataFrame:
    d = df.select(packet, F.posexplode(F.split(text, "\n")).alias("line_no", "line")).withColumn("line", F.trim("line"))
    return d.filter("line <> ''")


def log_hours(df: DataFrame, packet: str, text: str) -> DataFrame:
    return monitoring_hours(_lines(df, packet, text), packet, "line_no", "line")


def monitoring_hours(lines: DataFrame, packet: str, order: str, line: str) -> DataFrame:
    """One row per hour of a monitoring log, in line order by ``record``.

    Review and battery belong to the hour line itself or, where it has none, to the first
    later line of the same hour that has one. Impedance is what the hour line says beside them.
    """
    c = F.trim(F.col(line))
    opens = c.rlike(LOG_HOUR)
    group = lambda x, p, i: F.nullif(F.regexp_extract(x, p, i), F.lit(""))
    rest = F.when(opens, F.trim(F.regexp_replace(c, r"(?i)^.*?" + LOG_HOUR.removeprefix("(?i)"), "")))
    beside = F.trim(F.regexp_replace(rest, LOG_REVIEW + ".*$", ""))
    battery = group(beside, r"\b(100|\d{1,2})\s*$", 1)
    impedance = F.nullif(F.trim(F.rtrim(F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace(beside, r"\b(?:100|\d{1,2})\s*$", ""), r"\b(?:Yes|No)\b", "")), r"-+$", ""))), F.lit(""))
    seen = F.when(opens, rest).otherwise(c)
    return sections.attach_state(
        lines,
        packet,
        order,
        opens,
        {
            "date": F.when(opens, group(c, LOG_HOUR, 1)),
            "time_start": F.when(opens, group(c, LOG_HOUR, 2)),
            "time_end": F.when(opens, group(c, LOG_HOUR, 3)),
            "timezone": F.when(opens, group(c, LOG_HOUR, 4)),
            "recording_on": F.when(opens, F.lower(group(c, LOG_HOUR, 5)) == "yes"),
            "impedance": F.when(opens, impedance),
            "battery_pct": F.coalesce(battery, F.when(~opens, group(c, r"^\s*(100|\d{1,2})\s*$", 1))).try_cast("int"),
            "reviewer_name": group(seen, LOG_REVIEW, 1),
            "review_timestamp": F.when(seen.rlike(LOG_REVIEW), F.concat_ws(" ", group(seen, LOG_REVIEW, 2), group(seen, LOG_REVIEW, 3))),
        },
    )


def log_events(df: DataFrame, packet: str, text: str) -> DataFrame:
    """(packet, line_no, event_type, description, date, hour_start, reviewer_name) of each event line.

    Date and hour are those of the hour line before; the reviewer is a name in front of a credential, told only inside an hour.
    """
    c = F.col("line")
    hour = c.rlike(LOG_HOUR)
    d = sections.with_last(_lines(df, packet, text), packet, "line_no", F.when(hour, F.struct("line_no", F.regexp_extract(c, LOG_HOUR, 1).alias("date"), F.regexp_extract(c, LOG_HOUR, 2).alias("start"))), "h")
    d = d.filter(~hour & c.rlike(LOG_EVENT))
    raw, said = F.regexp_extract(c, LOG_EVENT, 1), F.trim(F.regexp_extract(c, LOG_EVENT, 2))
    kind = F.when(F.contains(raw, F.lit("EEGReview")), "eeg_reviewed").otherwise(F.coalesce(tx.lookup(F.lower(raw), LOG_EVENTS), F.lower(raw)))
    by = F.nullif(F.regexp_extract(said, CREDENTIALLED, 1), F.lit(""))
    return d.select(packet, "line_no", kind.alias("event_type"), said.alias("description"), F.col("h.date").alias("date"), F.col("h.start").alias("hour_start"), F.when(F.col("h").isNotNull(), by).alias("reviewer_name"))


Extractor = Callable[[Column], dict[str, Column]]
EXTRACTORS: dict[str, Extractor] = {"tech_scan_report": lambda c: report_header(c) | report_sections(c), "eeg_order": order_fields, "trackit_monitoring_log": log_summary}
SKIPPED = ["hipaa_consent", "unknown"]


def extract(df: DataFrame, kind: str, text: str, extractors: dict[str, Extractor] | None = None, skipped: list[str] | None = None) -> DataFrame:
    """Add ``method``, ``fields`` (JSON of the type's fields) and ``error`` by each row's type.

    An extractor that fails to build marks the rows of its type as 'regex_error' with its
    message; the others go on. Types without an extractor get 'no_extractor', skipped ones 'skip'.
    """
    fields, errors = F.lit(None).cast("string"), F.lit(None).cast("string")
    known = EXTRACTORS if extractors is None else extractors
    for name, build in known.items():
        try:
            columns = build(F.col(text))
            df.select(F.struct(*[c.alias(n) for n, c in columns.items()])).schema  # fails here, not when rows are read
            fields = F.when(F.col(kind) == name, F.to_json(F.struct(*[c.alias(n) for n, c in columns.items()]))).otherwise(fields)
        except Exception as e:  # noqa: BLE001
            errors = F.when(F.col(kind) == name, F.lit(repr(e)[:300])).otherwise(errors)
    method = F.when(F.col(kind).isin(SKIPPED if skipped is None else skipped), "skip").when(errors.isNotNull(), "regex_error").when(F.col(kind).isin(list(known)), "regex").otherwise("no_extractor")
    return df.withColumns({"method": method, "fields": F.when(method == "regex", fields), "error": errors})
