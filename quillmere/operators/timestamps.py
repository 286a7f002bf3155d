"""Problem 5: mixed timestamp formats and time zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import iso_date, iso_instant, parse_mixed


def with_site(df: DataFrame, sites: DataFrame, code: str = "site_code") -> DataFrame:
    """Attach ``__zone`` and ``__order`` of the row's site.

    ``sites`` is a small dimension; the join stays a plain equi-join, so a broadcast is
    chosen by its measured size. Sites listed twice keep one entry (the smallest).
    """
    s = sites.groupBy(F.col(code).alias("__site")).agg(F.min(F.struct("zone_name", "date_order")).alias("__s"))
    joined = df.join(s, F.col(code).eqNullSafe(F.col("__site")), "left")
    return joined.withColumns({"__zone": F.col("__s.zone_name"), "__order": F.col("__s.date_order")}).drop("__s", "__site")


def normalise(df: DataFrame, sites: DataFrame, source: str, row_id: str, field: str, clock: str | None, birth: bool = False) -> DataFrame:
    """(source_table, row_id, field, normal_value) for every possible date of ``field``.

    Null, blank, unreadable and impossible values give no row. ``birth`` dates keep the day
    as written; others give the UTC instant, or the date alone where no time is known.
    Columns of ``df`` beyond those named are ignored.
    """
    cols = [F.col(row_id).alias("row_id"), F.col(field).alias("value"), F.col("site_code")] + ([F.col(clock).alias("clock")] if clock else [])
    d = with_site(df.select(*cols).filter(F.trim("value") != ""), sites)
    d = parse_mixed(d, "value", "clock" if clock else None, "__zone", "__order")
    day = iso_date(F.col("ts_day"))
    shown = day if birth else F.coalesce(iso_instant(F.col("ts_epoch")), day)
    return d.filter("ts_day is not null").select(F.lit(source).alias("source_table"), F.col("row_id").cast("bigint").alias("row_id"), F.lit(field).alias("field"), shown.alias("normal_value"))


def normalise_all(studies: DataFrame, recordings: DataFrame, sites: DataFrame) -> DataFrame:
    return (
        normalise(studies, sites, "studies", "study_row_id", "eeg_start_date", "eeg_start_time")
        .unionByName(normalise(studies, sites, "studies", "study_row_id", "patient_dob", None, birth=True))
        .unionByName(normalise(recordings, sites, "recordings", "recording_id", "startdate", "starttime"))
    )
