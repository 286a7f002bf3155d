"""Quirks of text, name, date and cast functions on single rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillmere.functions import dates, names, scalars
from quillmere.functions import text as tx


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(("text", "labels"), [("Abnormal multifocal", "normal|abnormal|focal"), ("hello", "other"), ("", "other"), ("sz end", "seizure"), ("sz", "other"), (None, None)])
def test_labels(spark, text, labels):
    assert one(spark, text, tx.annotation_labels) == labels


@pytest.mark.parametrize(("text", "hz"), [("8-9", 8.5), ("9", 9.0), ("x", None), ("nan", None), (None, None)])
def test_midpoint(spark, text, hz):
    assert one(spark, text, tx.midpoint) == hz


def test_weighted_class_ties(spark):
    rules = [("a", ["x"], 2), ("b", ["y"], 2)]
    r = one(spark, "y x", lambda c: tx.weighted_class(c, rules))
    assert (r["name"], r["score"]) == ("a", 2)
    assert one(spark, "z", lambda c: tx.weighted_class(c, rules))["name"] is None


def test_earliest_end(spark):
    f = lambda c: tx.between(c, "START", ["ONE", "TWO"])
    assert one(spark, "xSTART a TWO b ONE", f) == "a"
    assert one(spark, "xSTART a\nb", f) == "a\nb"
    assert one(spark, "nothing", f) is None


@pytest.mark.parametrize(("text", "pages"), [("a\fb\f", ["a", "b"]), ("a", ["a"]), ("", [""]), ("\f", [""])])
def test_pages(spark, text, pages):
    assert one(spark, text, tx.split_pages) == pages


def test_rhythm_finds_reactive_inside(spark):
    row = spark.createDataFrame([("8 - 9.5 Hz, symmetric, non-reactive",)], "x string").select(*[c.alias(n) for n, c in tx.rhythm(F.col("x")).items()]).first()
    assert tuple(row) == ("8-9.5", "symmetric", "reactive")


@pytest.mark.parametrize(("name", "norm"), [("O'Neil, J.", "o neil j"), ("Smith-Jones  JR", "smith jones"), (" Ann (Mary) III", "ann mary"), ("", "")])
def test_normalise(spark, name, norm):
    assert one(spark, name, names.normalise) == norm


def test_folders(spark):
    r = spark.createDataFrame([("Doe. Jane A 24 - 87600 EMS",)], "x string").select(*[c.alias(n) for n, c in names.loose_folder(F.col("x")).items()]).first()
    assert tuple(r) == ("Doe", "Jane A", "24-87600", "EMS")
    r = spark.createDataFrame([("Doe, Jane rest",)], "x string").select(*[c.alias(n) for n, c in names.loose_folder(F.col("x")).items()]).first()
    assert tuple(r) == ("Doe", "Jane", "UNKNOWN", "rest")
    r = spark.createDataFrame([("nothing",)], "x string").select(*[c.alias(n) for n, c in names.loose_folder(F.col("x")).items()]).first()
    assert tuple(r) == (None,) * 4


@pytest.mark.parametrize(("text", "day"), [("1/2/75", dt.date(1975, 1, 2)), ("1/2/55", dt.date(2055, 1, 2)), ("2020-02-30", None), ("12/31/1999", dt.date(1999, 12, 31)), ("", None), (None, None)])
def test_dates(spark, text, day):
    assert one(spark, text, dates.parse_date) == day


@pytest.mark.parametrize(
    ("text", "shifted"),
    [("on 1/5/2020 and 12/30/99.", "on 01/15/2020 and 01/09/2000."), ("2020-02-25 x", "2020-03-06 x"), ("99/99/2020", "99/99/2020"), ("none", "none"), ("", ""), (None, None)],
)
def test_shift_in_text(spark, text, shifted):
    assert one(spark, text, lambda c: dates.shift_dates_in_text(c, F.lit(10))) == shifted


def test_shift_dotted(spark):
    f = lambda c: dates.shift_dotted_dates(c, F.lit(1))
    assert one(spark, "03.04.2021 25.12.2021 03.04.1999", f) == "03.05.2021 26.12.2021 03.04.1999"


@pytest.mark.parametrize(("clock", "hour"), [("12:05 AM", 0), ("12:05 PM", 12), ("3:00 PM", 15), ("x", None)])
def test_clock(spark, clock, hour):
    assert one(spark, clock, dates.clock_hour) == hour


def test_casts(spark):
    assert one(spark, "12.5", scalars.safe_int) == "" and one(spark, "12", scalars.safe_int) == "12" and one(spark, None, scalars.safe_int) == ""
    assert one(spark, "2.34567", scalars.safe_float) == "2.3457"


def test_scrubbing(spark):
    assert one(spark, "Doe and doe, not Doerr", lambda c: tx.scrub_words(c, F.array(F.lit("Doe"), F.lit("x")))) == "[NAME] and [NAME], not Doerr"
    masked = one(spark, "call 617-555-0101 at 12 Main St.", tx.scrub_contacts)
    assert "617" not in masked and "[PHONE]" in masked and "[ADDRESS]" in masked
    log = one(spark, "Doe, Jane seen 1/2/2020 id 12345678 file a.pdf", tx.sanitise_log)
    assert "Doe" not in log and "[date]" in log and "[id]" in log and "file-" in log


def test_hash_bucket_is_md5_modulo(spark):
    import hashlib

    assert one(spark, "abc", lambda c: tx.hash_bucket(c, 7)) == int(hashlib.md5(b"abc").hexdigest(), 16) % 7


def test_truncate(spark):
    assert one(spark, "spikes left PHOTIC STIMULATION normal", tx.truncate_at) == "spikes left"
    assert one(spark, "PHOTIC STIMULATION normal", tx.truncate_at) == "PHOTIC STIMULATION normal"
    assert one(spark, "x" * 4000, tx.truncate_at) == "x" * 3000
