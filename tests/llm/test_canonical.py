import random

from quillmere.llm.canonical import match_terms

TERMS = [(1, "m", "levetiracetam", "LEV|Keltravo"), (2, "m", "lamotrigine", None), (3, "m", "vitamin b12", ""), (4, "m", "vitamin b6", ""), (5, "c", "diabetes mellitus type 1", "T1DM"), (6, "c", "diabetes mellitus type 2", "T2DM"), (7, "c", "cerebral palsy", "CP"), (8, "c", "stroke", "cerebral infarction"), (9, "m", "ferrous sulfate", "FeSO4")]
VALUES = [
    ("m", "LEVETIRACETAM 500 mg BID", 1), ("m", "1) leviteracetam", 1), ("m", "lev", 1), ("m", "levetir...", 1), ("m", "Keltrvo (generic)", 1), ("m", "lamotrgine XR - refill", 2), ("m", "Vitamin B12 0.5 mg", 3), ("m", "vitamn b6", 4),
    ("m", "unknown", -1), ("m", "aspirin", -1), ("m", "  ", None), ("m", "", None), ("m", None, None), ("m", "?", -1), ("c", "Diabetes mellitus type 2 x 5 yrs", 6), ("c", "diabetes melitus type 1", 5), ("c", "h/o T1DM", 5), ("c", "cerebra.", 7),
    ("c", "Palsy, cerebral [Z23.7]", 7), ("c", "levetiracetam", -1), ("m", "FERRYUSSULFATE", 9), ("m", "x" * 3000, -1), ("m", "RUF (lamotrigine)", 2),
]


def run(spark, values, terms=TERMS):
    v = spark.createDataFrame([("t", i, k, x, 9) for i, (k, x, *_) in enumerate(values)], "source_table string, row_id bigint, kind string, value string, term_id int")
    t = spark.createDataFrame(terms, "term_id bigint, kind string, canonical_name string, aliases string")
    got = [(r.row_id, r.term_id) for r in match_terms(v, t).collect()]
    assert len(got) == len({i for i, _ in got})
    return dict(got)


def test_values(spark):
    assert run(spark, VALUES) == {i: t for i, (_, _, t) in enumerate(VALUES) if t is not None}


def test_names_of_any_number_of_words(spark):
    """The longest name inside a value counts, and any number of leading words goes."""
    six, seven = "acute left upper lobe lung nodule", "acute left upper lobe lung nodule biopsy"
    nine = "late effect of mild injury to the lower leg"
    terms = [(1, "c", six, None), (2, "c", seven, None), (3, "c", nine, None)]
    values = [("c", f"seen in clinic: {seven} planned"), ("c", f"seen in clinic: {six} planned"), ("c", f"chart says {nine} beyond doubt"), ("c", "h/o known probable suspected possible h/o known hx of " + six), ("c", "word " * 3000 + nine)]
    assert run(spark, values, terms) == {0: 2, 1: 1, 2: 3, 3: 1, 4: 3}


def test_empty_tables(spark):
    assert run(spark, VALUES[:2], [(1, "z", "other", None)]) == {0: -1, 1: -1}
    v = spark.createDataFrame([], "source_table string, row_id bigint, kind string, value string")
    t = spark.createDataFrame([], "term_id bigint, kind string, canonical_name string, aliases string")
    assert match_terms(v, t).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_join_loses_no_close_pair(spark):
    """Random edits against brute force over all names."""
    r = random.Random(11)
    names = sorted({"".join(r.choice("abcd") for _ in range(r.randint(6, 13))) for _ in range(40)})
    terms = [(i, "m", n, None) for i, n in enumerate(names)]
    values = []
    for _ in range(150):
        s = list(r.choice(names))
        for _ in range(r.randint(0, 4)):
            k = r.randrange(len(s))
            s[k : k + r.choice([0, 1])] = r.choice(["", "a", "b", "c", "d"])
        if len(s) >= 5:
            values.append(("m", "".join(s)))
    got = run(spark, values, terms)
    for i, (_, v) in enumerate(values):
        best = min((distance(v, n), n) for n in names)
        ok = [j for j, n in enumerate(names) if distance(v, n) == best[0] <= (1 if len(n) < 7 else 2 if len(n) < 12 else 3)]
        if ok and got[i] != -1:
            assert distance(v, names[got[i]]) <= 3
        within = [n for n in names if distance(v, n) <= (1 if len(n) < 7 else 2 if len(n) < 12 else 3)]
        assert (got[i] != -1) or not within
