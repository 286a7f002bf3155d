"""Text queries on small tables of their own."""

from quillmere.plans import catalogue


def write(spark, folder, name, rows, kind):
    spark.createDataFrame(rows, kind).write.parquet(f"{folder}/{name}.parquet")


def test_extraction_input_cuts_at_the_limit_only(spark, tmp_path):
    texts = ["", "a" * 501, "b" * 20_000, "c" * 20_000 + "rest", None]
    write(spark, tmp_path, "documents", list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.head, r.was_cut, r.n_chars) for r in catalogue.queries()["extraction_input"](spark, str(tmp_path)).collect()}
    assert got == {0: ("", False, 0), 1: ("a" * 501, False, 501), 2: ("b" * 20_000, False, 20_000), 3: ("c" * 20_000, True, 20_004)}


def test_dictionary_names_are_replaced_in_every_text(spark, tmp_path):
    names = [("Ostrander", "Mark"), ("Müller-Lüd", "José"), ("van der Berg", "Al"), ("Spike", "nan"), ("Smith", "Smithson"), (None, "Zoltan")]
    write(spark, tmp_path, "recordings", names, "last_name string, first_name string")
    texts = ["Mark spike OSTRANDER, ostrander's mother", "José Müller-Lüd sat up", "seen by Van Der Berg; van alone, Al", "Smithson Smith Smiths", "no name", "", None, "zoltan"]
    write(spark, tmp_path, "annotations", list(enumerate(texts)), "annotation_id bigint, text string")
    got = {r.annotation_id: r.scrubbed for r in catalogue.queries()["scrub_names_text"](spark, str(tmp_path)).collect()}
    assert got == {0: "Mark spike [NAME], [NAME]'s mother", 1: "[NAME] [NAME] sat up", 2: "seen by [NAME]; van alone, Al", 3: "[NAME] [NAME] Smiths", 4: "no name", 5: "", 7: "[NAME]"}


PAGES = [
    ("tech_scan_report", 6, "Technologist Scan Report\nPhotic Stimulation: none"),
    ("trackit_monitoring_log", 6, "TrackIT Battery\nGeneralNote: ok"),
    ("eeg_intake_form", 3, "Subscriber ID: 1"),
    ("eeg_order", 9, "Accession number: 12\nOrder #: 3\nOrdering provider: x"),
    ("clinical_progress_note", 4, "Chief complaint: none\nReview of Systems"),
    ("history_and_physical", 3, "Admission history"),
    ("imaging_report", 6, "MR BRAIN\nFindings: see\rbelow\nin FLAIR"),
    ("hipaa_consent", 2, "the HIPAA rules"),
    ("patient_event_log", 3, "Seizure diary"),
    ("lab_results", 3, "CBC  Result"),
    (None, 0, "nothing of the kind"),
]


def test_all_page_rules(spark, tmp_path):
    rows = [(i, text, "s", i) for i, (_, _, text) in enumerate(PAGES)] + [(99, None, "s", 99)]
    write(spark, tmp_path, "documents", rows, "doc_id bigint, text string, study_id string, page_start int")
    got = {r.doc_id: (r.name, r.score) for r in catalogue.queries()["page_types"](spark, str(tmp_path)).collect()}
    assert got == {i: (name, score) for i, (name, score, _) in enumerate(PAGES)}
    found = sorted((r.page_start, r.page_end, r.kind, r.max_score, r.confidence) for r in catalogue.queries()["packet_sections"](spark, str(tmp_path)).collect())
    want = [(i, i, name, score, "high" if score >= 6 else "medium" if score >= 3 else "low") for i, (name, score, _) in enumerate(PAGES[:9])]
    assert found == [*want, (9, 10, "lab_results", 3, "medium")]
