import json
import random
import time

import pytest
from pyspark.sql import functions as F

from quillmere.operators import changes, identity, nested, ordered, reports, resolution, sections, statistics
from quillmere.plans.pipeline import Pipeline
from quillmere.sources import files, sinks
from quillmere.streaming import watch


def test_carry_forward_limit(spark):
    d = spark.createDataFrame([("p", i, "t" if i == 1 else None) for i in range(1, 17)], "packet string, page int, kind string")
    got = [r.kind for r in sections.carry_forward(ordered.spread(d, ["packet"], ["page"]), "packet", ["page"], "kind").orderBy("page").collect()]
    assert got == ["t"] * 13 + ["unknown"] * 3


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_sections_against_brute_force(spark, coalesce):
    r = random.Random(3)
    rows = [("hot" if r.random() < 0.7 else f"p{r.randrange(5)}", i, r.choice(["a", "b", None, None, None])) for i in range(400)]
    want = []
    for p in {x[0] for x in rows}:
        last, at, runs = None, -99, []
        for n, (_, page, kind) in enumerate(sorted(x for x in rows if x[0] == p) if False else sorted((x for x in rows if x[0] == p), key=lambda x: x[1])):
            if kind:
                last, at = kind, n
            k = last if last and n - at <= 12 else "unknown"
            if runs and runs[-1][1] == k:
                runs[-1][3] = page
            else:
                runs.append([p, k, page, page])
        want += [tuple(x) for x in runs]
    d = spark.createDataFrame(rows, "packet string, page int, kind string").withColumns({"chars": F.lit(1), "score": F.lit(3)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    s = sections.sections(d, "packet", ["page"], "kind", "page", "chars", "score")
    got = [(x.packet, x.kind, x.page_start, x.page_end) for x in s.collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(got) == sorted(want)


def test_running_total_with_hot_group(spark):
    rows = [("hot" if i % 3 else None, i, i % 5) for i in range(500)]
    d = spark.createDataFrame(rows, "g string, o int, v int")
    got = {(r.g, r.o): r.t for r in ordered.running_total(d, ["g"], ["o"], F.col("v"), "t").collect()}
    total = {}
    for g, o, v in rows:
        assert got[(g, o)] == total.get(g, 0)
        total[g] = total.get(g, 0) + v


def _broadcast_rows(plan):
    """Rows of each broadcast of an executed plan."""
    kind = plan.getClass().getSimpleName()
    if kind.startswith("BroadcastExchange"):
        return [plan.metrics().apply("numOutputRows").value()]
    inner = plan.executedPlan() if kind == "AdaptiveSparkPlanExec" else plan.plan() if kind.endswith("QueryStageExec") else None
    children = plan.children()
    return [n for x in ([inner] if inner else [children.apply(i) for i in range(children.size())]) for n in _broadcast_rows(x)]


def test_prefix_broadcasts_one_row_a_partition(spark):
    """Many small groups: neither the rows nor a value per group may go through the driver."""
    d = ordered.spread(spark.range(6000).selectExpr("id div 2 as g", "id as o"), ["g"], ["o"])
    got = ordered.prefix(d, ["g"], ["o"], F.lit(1), "t", own=True)
    assert sorted((r.g, r.t) for r in got.collect()) == [(g, t) for g in range(3000) for t in (1, 2)]
    assert max(_broadcast_rows(got._jdf.queryExecution().executedPlan()), default=0) <= d.select(ordered.PART).distinct().count()


def test_sessions(spark):
    d = spark.createDataFrame([("p", 1, 3), ("p", 2, 0), ("p", 3, 2)], "p string, o int, n int")
    assert [r.session_start for r in identity.session_starts(d, "p", ["o"], "n").orderBy("o").collect()] == [1, 4, 4]


def test_ids_continue(spark):
    old = spark.createDataFrame([("a", "P-7"), ("b", "P-12")], "k string, id string")
    new = spark.createDataFrame([("b",), ("d",), ("c",), (None,), ("",)], "k string")
    assert {(r.k, r.id) for r in identity.continued_ids(old, new, "k").collect()} == {("c", "P-13"), ("d", "P-14")}


@pytest.mark.parametrize("a,b,method,confidence", [("a|b", "a|b", "exact", "high"), ("smith|jon", "smyth|jon", "levenshtein_d1", "medium"), ("smith|jon", "smyth|jan", "levenshtein_d2", "low"), ("smith|jon", "zmith|jon", "unmatched", "")])
def test_tiers(spark, a, b, method, confidence):
    left = spark.createDataFrame([(1, a, a, a)], "left_id int, exact_key string, norm_key string, root_key string")
    ref = spark.createDataFrame([(9, 1, b, b, b)], "ref_id int, ref_order int, exact_key string, norm_key string, root_key string")
    r = resolution.tiered_match(left, ref).first()
    assert (r.method, r.confidence) == (method, confidence)


def test_fuzzy_join_is_complete(spark):
    r = random.Random(5)
    words = sorted({"a" + "".join(r.choice("abc") for _ in range(r.randint(0, 8))) for _ in range(120)})
    left = spark.createDataFrame([(w,) for w in words[::2]], "norm_key string")
    right = spark.createDataFrame([(w, i, i) for i, w in enumerate(words[1::2])], "norm_key string, ref_id int, ref_order int")
    got = {(x.l, x.norm_key) for x in resolution.fuzzy_join(left, right).collect()}
    want = left.withColumnRenamed("norm_key", "l").crossJoin(right).filter(F.levenshtein("l", "norm_key") <= 2)
    assert got == {(x.l, x.norm_key) for x in want.collect()}


def test_quartiles(spark):
    d = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 10)], "v double")
    assert statistics.quartiles(d, "v").first().q1 == 1.75
    assert statistics.nearest_rank_quartiles(d, "v").first().q1 == 2.0
    assert statistics.quartiles(d.limit(0), "v").first().median is None


def test_closed_last_bin(spark):
    d = spark.createDataFrame([(x,) for x in (0.0, 4.9, 5.0, 10.0, 10.1, None)], "v double")
    assert {(r.bin, r.n) for r in statistics.histogram(d, F.col("v"), 0, 5, 2).collect()} == {(0, 2), (1, 2)}


@pytest.mark.parametrize(("cut", "whole"), [('{"a":["x', {"a": ["x"]}), ('```json\n{"a": 1,', {"a": 1}), ('{"a": "q\\"', {"a": 'q"'}), ("[1, {", [1, {}])])
def test_json_repair(cut, whole):
    assert json.loads(nested.repair(cut)) == whole


def test_lenient_json_keeps_all_rows(spark):
    d = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"a": [1'), (3, "no json"), (4, None)], "i int, t string")
    assert {r.i: r.o for r in nested.lenient_json(d, "t", "o").collect()} == {1: '{"a": 1}', 2: '{"a": [1]}', 3: None, 4: None}


def test_incremental(spark):
    items = spark.createDataFrame([(1, 5, "x"), (2, 5, "y"), (3, 5, "z")], "k int, changed int, h string")
    made = spark.createDataFrame([(1, 9, "x"), (2, 3, "q")], "k int, made int, h string")
    assert {r.k for r in changes.pending(items, made, "k").collect()} == {3}
    assert {r.k for r in changes.stale(items, made, "k", "changed", "made").collect()} == {2, 3}
    assert {r.k for r in changes.hash_changed(items, made, "k", "h").collect()} == {2, 3}
    status = spark.createDataFrame([(1, "ok", "full"), (2, "ok", "skipped"), (3, "error", "full")], "k int, status string, method string")
    assert {r.k for r in changes.retry(items, status, "k", "full").collect()} == {2, 3}
    assert changes.merge_records(made, made.limit(1), ["k"]).count() == 2


def test_file_sources(spark, tmp_path):
    (tmp_path / "Doe, J 24-00001").mkdir()
    (tmp_path / "$RECYCLE").mkdir()
    lay = "[File]\na=b\n[Comments]\n1.5,2,0,0,\"left, spike\"\nshort line\n\n[Other]\n1,2,3,4,no\n"
    (tmp_path / "Doe, J 24-00001" / "a.lay").write_text(lay)
    (tmp_path / "Doe, J 24-00001" / "b.mg2x.raw").write_text("zz")
    (tmp_path / "$RECYCLE" / "c.edf").write_text("")
    got = [(r.onset_sec, r.text) for r in files.lay_files(spark, str(tmp_path)).orderBy("line_no").collect()]
    assert got == [(1.5, "left, spike"), (0.0, "short line")]
    assert files.lay_files(spark, str(tmp_path), strict=True).count() == 1
    f = files.listing(spark, str(tmp_path))
    assert [r.folder for r in files.entity_folders(f).collect()] == ["Doe, J 24-00001"]
    assert [r.folder for r in files.entity_folders(f, parsed=True).collect()] == ["Doe, J 24-00001"]
    # The files of both sources join by their path.
    assert files.lay_files(spark, str(tmp_path)).join(f, F.col("file") == F.col("path")).count() == 2
    inv = files.folder_inventory(f.filter("name like '%lay' or name like '%raw'"), [".lay"]).first()
    assert inv.n_files == 2 and inv.sized_bytes == len(lay) and inv.kinds[".mg2_trend"] == 1
    (tmp_path / "p.jsonl").write_text('{"page": 1, "text": "a"}\n\nbroken\n{"page": 2, "text": "b"}\n')
    assert files.page_lines(spark, str(tmp_path / "p.jsonl")).count() == 2
    assert files.table_or_empty(spark, str(tmp_path / "none.csv"), ["a"]).count() == 0


def test_edf_header(spark, tmp_path):
    head = b"0".ljust(8) + b"X F 01-JAN-1990 Doe".ljust(80) + b"Startdate 02-JAN-2020".ljust(80) + b"02.01.20" + b"10.11.12" + b"768".ljust(8) + b"".ljust(44) + b"60".ljust(8) + b"1".ljust(8) + b"2".ljust(4)
    (tmp_path / "a.edf").write_bytes(head + bytes(100))
    (tmp_path / "b.edf").write_bytes(b"junk")
    rows = sorted((r.n_data_records or 0, r.n_channels or 0, r.duration_sec or 0.0, r.error) for r in files.edf_headers(spark, str(tmp_path)).collect())
    assert rows == [(0, 0, 0.0, "unreadable header"), (60, 2, 60.0, "")]


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([("a", None), ("b", "x")], "k string, v string")
    assert not sinks.write_csv(d.limit(0), str(tmp_path / "e"))
    sinks.write_tsv_with_dictionary(d, str(tmp_path), "t", {"k": "key"})
    assert "n/a" in "".join(p.read_text() for p in (tmp_path / "t").glob("*.csv"))
    assert sinks.fill_template("{NEW: a} {NEW: b}", {"a": "1"}) == ("1 {NEW: b}", ["b"])
    n = spark.createDataFrame([("s", 1, "f.pdf"), ("s", 2, "f.pdf")], "s string, o int, f string")
    assert {r.f for r in sinks.versioned(n, ["f"], ["o"], "f").collect()} == {"f.pdf", "f_ses2_.pdf"}


def test_long_ranges_come_in_parts(spark):
    pages = spark.createDataFrame([("p", i // 2, i, f"t{i}") for i in range(450)] + [("q", 1, 1, "x")], "packet string, page int, id int, text string")
    spans = spark.createDataFrame([("p", 0, 300), ("q", 1, 1), ("r", 1, 9)], "packet string, page_start int, page_end int")
    got = sections.text_of_range(spans, pages, "packet", "page", "text", "id").collect()
    parts = {(r.packet, r.part): r.section_text for r in got}
    assert len(got) == len(parts) == 5 and parts["q", 0] == "x" and parts["r", 0] == ""
    assert "\f".join(parts["p", k] for k in range(3)).split("\f") == [f"t{i}" for i in range(450)]
    assert sections.text_of_range(spans.limit(0), pages, "packet", "page", "text", "id").count() == 0


def test_more_sources(spark, tmp_path):
    d = spark.createDataFrame([("sub-A1/ses-2/eeg/sub-A1_ses-2_channels.tsv",), ("sub-A1/x_channels.tsv",), ("sub-B/ses-1/y.json",)], "path string")
    assert [(r.subject, r.session) for r in files.session_keys(d).collect()] == [("sub-A1", "ses-2")]
    n = spark.createDataFrame([("a.EDF",), ("b.backup.edf",), ("c.lay",), (None,)], "name string")
    assert [r.name for r in files.with_suffix(n, ".edf").collect()] == ["a.EDF"]
    for k in range(2):
        (tmp_path / f"w{k}").mkdir()
        (tmp_path / f"w{k}" / "c.csv").write_text(f"kind,n\nx,{k + 1}\ny,5\n")
    assert {(r.kind, r.n) for r in files.shard_counters(spark, str(tmp_path), "kind").collect()} == {("x", 3), ("y", 10)}
    (tmp_path / "q.csv").write_text('a,b\n1,"two\nlines"\n2,one\n')
    assert tuple(files.row_counts(spark, str(tmp_path / "q.csv")).first()) == (2, 3)
    lines = spark.createDataFrame([("g", 1, "done 5"), ("g", 2, "todo 3"), ("g", 3, "todo 4"), ("h", 1, "todo 9"), ("i", 1, "-")], "g string, o int, line string")
    assert {r.g: r.line for r in files.last_matching(lines, "g", "o", "line", "done", "todo").collect()} == {"g": "done 5", "h": "todo 9"}
    (tmp_path / "docs +%20x").mkdir()
    (tmp_path / "docs +%20x" / "d.json").write_text('{"a": 1}')
    (row,) = files.documents(spark, str(tmp_path / "docs +%20x"), "a int").collect()
    assert row.a == 1 and row.path.endswith("docs +%20x/d.json")


def test_more_sinks(spark, tmp_path):
    d = spark.createDataFrame([("A", "1", 5), ("A", "2", None)], "sub string, ses string, v int")
    sinks.write_subject_tree(d, str(tmp_path / "tree"))
    assert sorted(p.parent.relative_to(tmp_path).as_posix() for p in (tmp_path / "tree").rglob("*.csv")) == ["tree/sub=A/ses=1", "tree/sub=A/ses=2"]
    assert "n/a" in "".join(p.read_text() for p in (tmp_path / "tree" / "sub=A" / "ses=2").glob("*.csv"))
    sinks.write_json_per_entity(d, str(tmp_path / "json"), "ses")
    assert spark.read.json(str(tmp_path / "json" / "ses=1")).first().v == 5
    for _ in range(2):
        sinks.append_log(d, str(tmp_path / "log"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "log")).count() == 4
    r = spark.createDataFrame([(1, [("a", 2)], [])], "id int, xs array<struct<k:string,n:int>>, ys array<string>")
    t = nested.fan_out(r, {"xs": ("xs", [F.col("id"), F.col("x.k").alias("k")]), "ys": ("ys", [F.col("id"), F.col("x").alias("y")])})
    assert [tuple(x) for x in t["xs"].collect()] == [(1, "a")] and t["ys"].count() == 0
    with pytest.warns(UserWarning, match="absent"):
        nested.whitelist(d, spark.createDataFrame([("A", 7)], "sub string, person_id int"), "sub", ["v", "w"])


def test_snapshots_are_thinned():
    now = iter(range(0, 10_000_000, 10))
    s = watch.Snapshots(every=15, most=10, clock=lambda: next(now))
    for _ in range(60):
        s.count(5)
    assert s.rows == 300 and s.batches == 60 and len(s.history) <= 10 and s.history[0]["batches"] == 1


def test_snapshots_of_a_stream(spark, tmp_path):
    s = watch.Snapshots(every=0)
    spark.streams.addListener(s)
    try:
        spark.range(20).write.parquet(str(tmp_path / "in"))
        watch.watch(spark, str(tmp_path / "in"), spark.range(1).schema, lambda b: b, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        for _ in range(50):
            if s.rows == 20:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(s)
    assert s.rows == 20 and s.frame(spark).count() >= 1


def test_quartiles_of_odd_groups(spark):
    d = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 10)] + [("b", 7.0)] * 3 + [("c", None), (None, 2.0), (None, 4.0)], "g string, v double")
    got = {r.g: (r.n, r.q1, r.median, r.q3) for r in statistics.quartiles(d, "v", ["g"]).collect()}
    assert got == {"a": (4, 1.75, 2.5, 4.75), "b": (3, 7.0, 7.0, 7.0), "c": (0, None, None, None), None: (2, 2.5, 3.0, 3.5)}
    assert tuple(statistics.quartiles(d.limit(0), "v").first()) == (0, None, None, None)


def test_reports_without_fields(spark):
    d = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 100_000), (4, "Seizures: " + "a b\n" * 30_000)], "i int, text string")
    got = d.select("i", *[c.alias(n) for n, c in (reports.report_header(F.col("text")) | reports.report_sections(F.col("text")) | reports.order_fields(F.col("text"))).items()]).orderBy("i").collect()
    assert all(v is None for r in got[:3] for k, v in r.asDict().items() if k != "i") and len(got[3].seizures) == 3000 - 1
    assert reports.event_rows(d.filter("i < 3"), "text").count() == 0 and reports.log_hours(d.filter("i < 3"), "i", "text").count() == 0 and reports.log_events(d.filter("i < 3"), "i", "text").count() == 0
    e = reports.extract(d.withColumn("kind", F.lit("eeg_order")), "kind", "text").select("method", "error").distinct().collect()
    assert [tuple(x) for x in e] == [("regex", None)]


def test_pipeline_names_the_failing_stage():
    p = Pipeline()
    p.stage("one")(lambda r: 1)
    p.stage("two")(lambda r: r["one"] / 0)
    with pytest.raises(RuntimeError, match="two"):
        p.run()


def test_entry_is_usable_without_optional_modules(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert {"folder_name", "kind", "start_epoch", "end_epoch"} == set(e.entry(spark).columns)


def test_monitoring_hours(spark):
    text = "03/04 1:00 PM - 2:00 PM CST Yes good 97\nAnna - 03/04/2024 2:05 PM\n03/04 2:00 PM - 3:00 PM No\n55"
    d = spark.createDataFrame([("p", i, x) for i, x in enumerate(text.split("\n"))], "packet string, n int, line string")
    got = [(r.time_start, r.time_end, r.timezone, r.recording_on, r.battery_pct, r.reviewer_name) for r in reports.monitoring_hours(d, "packet", "n", "line").orderBy("record").collect()]
    assert got == [("1:00 PM", "2:00 PM", "CST", True, 97, "Anna"), ("2:00 PM", "3:00 PM", None, False, 55, None)]
