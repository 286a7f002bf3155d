import random

from quillmere.llm import scanned

WORDS = "the recording shows no abnormal rhythm during quiet sleep and the amplitude remains moderate over both frontal regions with well-organized background".split()


def corpus():
    r = random.Random(1)
    return [" ".join(r.choice(WORDS) for _ in range(60)) + "." for _ in range(40)]


def run(spark, texts):
    rows = spark.createDataFrame([("t", i, x) for i, x in enumerate(texts)], "source_table string, row_id bigint, text string")
    return rows, {tuple(r)[1:] for r in scanned.found(rows).collect()}


def test_repairs(spark):
    texts = [
        *corpus(),
        "The rec0rding shows no abnor-\nmal rhythrn during quiet\nPage 3 of 4\nsleep and the ampli­tude.",
        "the background is well-\norganized and the recor-\n\n   Quarry Hill Sleep & EEG     Study 22-52887\n- 2 -\nding over b0th",
        "both frontal\r\n*** continued ***\r\nregi0ns\x0c\nTECHNOL0GIST SCAN REPORT    1",
        None,
        "",
        "   \n ",
    ]
    # The two running titles come back on other pages, in the middle of sentences.
    sides = [("moderate", "amplitude"), ("over", "frontal"), ("abnormal", "sleep")]
    texts += [f"the recording shows {sides[i][0]}\n{title}{i}\n{sides[i][1]} over both frontal regions" for i in range(3) for title in ("Quarry Hill Sleep & EEG     Study 22-5288", "TECHNOLOGIST SCAN REPORT    ")]
    rows, got = run(spark, texts)
    n = len(corpus())
    assert {x for x in got if x[0] == n} == {(n, "misread", "recording"), (n, "misread", "rhythm"), (n, "split_word", "abnormal"), (n, "page_line", "Page 3 of 4")}
    assert {x for x in got if x[0] == n + 1} == {(n + 1, "split_word", "well-organized"), (n + 1, "split_word", "recording"), (n + 1, "page_line", "Quarry Hill Sleep & EEG     Study 22-52887"), (n + 1, "page_line", "- 2 -"), (n + 1, "misread", "both")}
    assert {x for x in got if x[0] == n + 2} == {(n + 2, "page_line", "*** continued ***"), (n + 2, "misread", "regions"), (n + 2, "page_line", "TECHNOL0GIST SCAN REPORT    1")}
    assert {x[1] for x in got if x[0] > n + 5} == {"page_line"} and not [x for x in got if n + 2 < x[0] <= n + 5 or x[0] < n]
    text = {r.row_id: r.repaired for r in scanned.paragraphs(rows).collect()}
    assert text[n].startswith("The recording shows no abnormal rhythm during quiet sleep and")
    assert text[n + 1] == "the background is well-organized and the recording over both"
    assert text[0] == corpus()[0]


def test_empty(spark):
    rows, got = run(spark, [None])
    assert got == set() and scanned.paragraphs(rows).count() == 0


def test_hash_is_additive():
    assert scanned._hash_of("rnoon") - scanned._hash_of("moon") == scanned._hash_of("rn") - scanned._hash_of("m")


def test_body_lines_stay(spark):
    lines = ["limits for age.", "50 Hz on the left", "MRI of the brain", "F7-T7 during sleep", "region."]
    _, got = run(spark, ["\n".join(lines)])
    assert not [x for x in got if x[1] == "page_line"]


def test_page_lines_by_place_and_repetition(spark):
    """A header in any wording that comes back inside sentences goes; a capitalised line that the text runs on into stays."""
    r = random.Random(4)
    prose = [" ".join(r.choice(WORDS) for _ in range(9)) for _ in range(60)]
    header, long = "acme labs bulletin no {} of spring", "Interim survey of the harbour district " + "and all of its outlying wards " * 9 + "{}"
    pages = lambda h: "\n".join(x for i in range(3) for x in (prose[2 * i], h.format(i + 7), prose[2 * i + 1]))
    texts = [*corpus(), pages(header), pages(long), "\n".join([prose[8], "Memorial Clinic North", prose[9]])]
    # A fixed paragraph, always broken at the same places, is text however often it comes back.
    texts += ["\n".join(["Patients are asked to avoid", "Coffee and other stimulants", "Before the recording begins", "and to arrive early."])] * 6
    _, got = run(spark, texts)
    n = len(corpus())
    assert {x for x in got if x[1] == "page_line"} == {(n, "page_line", header.format(i + 7)) for i in range(3)} | {(n + 1, "page_line", long.format(i + 7)) for i in range(3)}


def test_repeated_rows_count_each(spark):
    rows = spark.createDataFrame([("t", 1, "a\nPage 1 of 2\nb"), ("t", 1, "a\nPage 1 of 2\nb"), ("t", None, None)], "source_table string, row_id bigint, text string")
    assert [tuple(r)[2:] for r in scanned.found(rows).collect()] == [("page_line", "Page 1 of 2")]


def test_very_long_lines(spark):
    texts = ["Word " * 40_000, "=" * 200_000, "a" * 200_000, " " * 200_000 + "Page 1 of 2", "a-\nb" * 20_000]
    _, got = run(spark, texts)
    assert (3, "page_line", "Page 1 of 2") in got and not [x for x in got if x[0] in (0, 1, 2)]
