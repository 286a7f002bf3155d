"""Names, folder names and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRICT = r"^([^,]+),\s*([^\d]+?)\s+(\d{2}-\d{4,5})\s*(.*)$"
LOOSE = r"^([^,.]+)[,.\s]+\s*([^\d]+?)\s+(\d{2}\s*-+\s*\d{4,5})\s*(.*)$"
FALLBACK = r"^([^,]+),\s*(\S+)\s+(.*)$"
PARTS = ["last_name", "first_name", "case_id", "suffix"]


def strict_folder(name: Column) -> dict[str, Column]:
    """'Last, First NN-NNNNN rest' to its parts; else blanks with the whole name as suffix."""
    fits = name.rlike(STRICT)
    got = {p: F.trim(F.regexp_extract(name, STRICT, i + 1)) for i, p in enumerate(PARTS)}
    return {p: F.when(fits, v).otherwise(name if p == "suffix" else F.lit("")) for p, v in got.items()}


def loose_folder(name: Column) -> dict[str, Column]:
    """Separators vary, blanks inside the case id go; without one the id is 'UNKNOWN'; else null."""
    a, b = name.rlike(LOOSE), name.rlike(FALLBACK)
    first = {p: F.trim(F.regexp_extract(name, LOOSE, i + 1)) for i, p in enumerate(PARTS)}
    first["case_id"] = F.replace(first["case_id"], F.lit(" "), F.lit(""))
    second = {"last_name": F.trim(F.regexp_extract(name, FALLBACK, 1)), "first_name": F.trim(F.regexp_extract(name, FALLBACK, 2)), "case_id": F.lit("UNKNOWN"), "suffix": F.trim(F.regexp_extract(name, FALLBACK, 3))}
    return {p: F.when(a, first[p]).when(b, second[p]) for p in PARTS}


def normalise(name: Column) -> Column:
    """Lower case, punctuation to blanks, blanks squeezed, generation words dropped."""
    t = F.regexp_replace(F.trim(F.lower(name)), r"[,.\-'\"()\[\]]+", " ")
    t = F.trim(F.regexp_replace(t, r"\s+", " "))
    return F.trim(F.regexp_replace(t, r"\b(jr|sr|ii|iii|iv)\b", ""))


def first_root(name: Column) -> Column:
    return F.get(F.split(normalise(name), " "), F.lit(0))


def packet_parts(folder: Column) -> dict[str, Column]:
    """'Last, First-NNNNNNNN' to last, first, number (each '' where absent)."""
    text = F.regexp_extract(folder, r"^(.+?)-(\d{8,})$", 1)
    body = F.when(text == "", folder).otherwise(text)
    return {
        "last": F.trim(F.get(F.split(body, ",", 2), F.lit(0))),
        "first": F.coalesce(F.trim(F.get(F.split(body, ",", 2), F.lit(1))), F.lit("")),
        "number": F.regexp_extract(folder, r"^(.+?)-(\d{8,})$", 2),
    }


def keys(last: Column, first: Column) -> dict[str, Column]:
    """Exact, normalised and first-word keys of a name."""
    return {
        "exact_key": F.concat_ws("|", F.lower(F.trim(last)), F.lower(F.trim(first))),
        "norm_key": F.concat_ws("|", normalise(last), normalise(first)),
        "root_key": F.concat_ws("|", normalise(last), first_root(first)),
    }


def patient_key(folder: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(folder, r"-\d+$", "")))


def participant(identifier: Column) -> Column:
    """'Source-12' to 'sub-Source12'."""
    return F.concat(F.lit("sub-"), F.replace(identifier, F.lit("-"), F.lit("")))
