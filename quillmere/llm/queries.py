"""Queries and SQL oracles of the subpackage."""

from __future__ import annotations

import secrets

from ..session import cut_lineage
from ..sources.tables import load
from . import canonical, entities, mixing, pii, quality, scanned, tokens


def p1_found(spark, sf_dir):
    t = lambda n: load(spark, sf_dir, n)
    return canonical.match_terms(canonical.clinical_values(t("medications"), t("comorbidities")), t("canonical_terms"))


def _remarks(spark, sf_dir):
    return pii.remarks({n: load(spark, sf_dir, n) for n, _, _ in pii.SOURCES})


def p3_found(spark, sf_dir):
    return pii.found(_remarks(spark, sf_dir))


def p3_redacted(spark, sf_dir):
    """The remarks with typed placeholders. The key is the setting quillmere.pii.key; a session without one gets a random key, kept there."""
    key = spark.conf.get("quillmere.pii.key", None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set("quillmere.pii.key", key)
    return pii.redact(_remarks(spark, sf_dir), "text", key).select("source_table", "row_id", "redacted")


def p4_matched(spark, sf_dir):
    """Every candidate pair with its confidence."""
    t = lambda n: load(spark, sf_dir, n)
    return entities.match(t("studies"), t("recordings"), t("sites")).select("study_id", "folder_name", "confidence")


def p4_found(spark, sf_dir):
    return entities.found(p4_matched(spark, sf_dir))


def p4_reliability(spark, sf_dir):
    """Calibrated confidences of one half of the studies against the other."""
    t = lambda n: load(spark, sf_dir, n)
    return entities.reliability(t("studies"), t("recordings"), t("sites"))


def _reports(spark, sf_dir):
    return scanned.reports(load(spark, sf_dir, "technologist_impression"), load(spark, sf_dir, "eeg_background"))


def p6_found(spark, sf_dir):
    return scanned.found(_reports(spark, sf_dir))


def p6_repaired(spark, sf_dir):
    return scanned.paragraphs(_reports(spark, sf_dir))


def p7_ids(spark, sf_dir):
    return tokens.encode(load(spark, sf_dir, "documents"))


def p7_blocks(spark, sf_dir):
    """Documents packed to blocks longer than a chunk: their ids and the number of stitched pieces."""
    return tokens.encode(tokens.blocks(load(spark, sf_dir, "documents")), key="block", count_pieces=True)


def _sized(spark, sf_dir):
    """Documents with their size in tokens."""
    return tokens.token_counts(load(spark, sf_dir, "documents"), keep=("source",))


def p8_mix(spark, sf_dir):
    return mixing.mix(_sized(spark, sf_dir), load(spark, sf_dir, "source_targets")).select("doc_id", "source", "tokens", "copies")


def p8_shares(spark, sf_dir):
    sized, targets = cut_lineage(_sized(spark, sf_dir)), load(spark, sf_dir, "source_targets")
    return mixing.shares(mixing.mix(sized, targets), sized, targets)


def p9_found(spark, sf_dir):
    return quality.found(load(spark, sf_dir, "documents"))


def p9_statistics(spark, sf_dir):
    return quality.statistics(load(spark, sf_dir, "documents"))


QUERIES = {
    "p1_found": p1_found,
    "p3_found": p3_found,
    "p3_redacted": p3_redacted,
    "p4_found": p4_found,
    "p4_matched": p4_matched,
    "p4_reliability": p4_reliability,
    "p6_found": p6_found,
    "p6_repaired": p6_repaired,
    "p7_ids": p7_ids,
    "p7_blocks": p7_blocks,
    "p8_mix": p8_mix,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_statistics": p9_statistics,
}
ORACLES: dict[str, str] = {}
