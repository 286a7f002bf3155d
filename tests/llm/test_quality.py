import pytest

from quillmere.llm import labelled, quality


@pytest.fixture(scope="module")
def rules(spark):
    return quality.learned(spark)


def kinds(spark, rules, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, kind string")
    return [r.kind for r in quality.classify(df, rules).orderBy("doc_id").collect()]


def test_held_out_accuracy(spark, rules):
    docs = labelled.compose(500, seed=77)
    got = kinds(spark, rules, [t for t, _ in docs])
    assert sum(g == k for g, (_, k) in zip(got, docs)) / len(docs) > 0.97


def test_documents(spark, rules):
    prose = "The recording ran for two days and its quality was good. The family describes brief events in the morning.\nNo change was seen."
    bullets = "\n".join(f"- item {w} 5 mg" for w in ("one", "two", "three", "four", "five", "six"))
    table = "\n".join("| a | 12.5 | ok |" for _ in range(8))
    texts = [prose, bullets, table, "a;b;c\n1;2;3\n4;;6\n7;8;9", "7f 35 64 9e 24 ba 56 df 4a 66 b3 ca", "void " * 60, "=" * 80, prose * 3 + "\n" + bullets, None, "", " \n\t ", "x"]
    got = kinds(spark, rules, texts)
    assert got[:8] == ["prose", "list", "table", "table", "junk", "junk", "junk", "prose"] and got[8:11] == [None] * 3


def test_rules_are_stable_and_become_sql(spark, rules):
    assert rules == quality.learned(spark)
    sql = quality.case_sql(rules)
    assert sql.startswith("case when") and all(f"'{k}'" in sql for k in quality.ORDER)
    assert quality.case_sql([]) == "'prose'"


def test_statistics_of_a_known_text(spark):
    r = quality.statistics(spark.createDataFrame([(1, "The cat sat.\n\n- one two\n")], "doc_id bigint, text string")).first()
    assert (r.words, r.lines, r.chars) == (5, 2, 17)
    assert round(r.ended_share, 2) == 0.5 and round(r.item_share, 2) == round(7 / 17, 2)
    assert quality.found(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


# Written by hand for this test, in no layout of the composer.
HELD_OUT = [
    ("She was seen on Tuesday and told us that the spells had stopped after the change of tablets.\nNobody at school has noticed anything since.", "prose"),
    ("Nach dem Anfall war er etwa eine Stunde lang verwirrt und konnte sich an nichts erinnern. Seitdem schläft er schlecht.", "prose"),
    ("El niño no ha vuelto a tener crisis desde el verano. Come bien y juega con sus hermanos.", "prose"),
    ("Depuis la sortie de l'hôpital, elle marche sans aide et ne prend plus de médicaments le soir.", "prose"),
    ("eggs\nmilk\nbrown bread\ntwo onions\ncoffee filters\nbatteries for the remote", "list"),
    ("1. unplug the amplifier\n2. wait ten seconds\n3. plug it in again\n4. call the desk", "list"),
    ("* ankle swelling\n* ringing in the ears\n* dry mouth\n* itching at night", "list"),
    ("[x] consent signed\n[ ] hair washed\n[x] electrodes placed\n[ ] camera on", "list"),
    ("day,dose,weight\n1,20,71.2\n2,25,71.0\n3,25,70.8\n4,30,70.9", "table"),
    ("| drug | am | pm |\n| zonisamide | 100 | 200 |\n| clobazam | 5 | 10 |", "table"),
    ("Mon\t7:30\t98\nTue\t8:15\t97\nWed\t7:45\t99\nThu\t9:00\t96", "table"),
    ("channel    gain    filter\nFp1        7       0.5\nFp2        7       0.5\nO1         10      1.0", "table"),
    ("asdf asdf asdf asdf asdf asdf asdf asdf asdf asdf asdf asdf", "junk"),
    ("-----------------------------\n=============================\n-----------------------------", "junk"),
    ("%PDF-1.4 %âãÏÓ 3 0 obj<</Length 4/Filter/FlateDecode>>stream x\x9c+ä2T0\x00B]$@ßÃÕ¿ï½", "junk"),
    ("q7Zx9Lm2Pw8Rt4Vb6Ny1Kc3Jd5Hf0Gs8Aa2Ss4Dd6Ff8Gg0Hh1Jj3Kk5Ll7", "junk"),
]


def test_documents_of_another_hand(spark, rules):
    got = kinds(spark, rules, [t for t, _ in HELD_OUT])
    right = sum(g == k for g, (_, k) in zip(got, HELD_OUT))
    assert right >= 14, [(t[:40], k, g) for g, (t, k) in zip(got, HELD_OUT) if g != k]


def test_rules_use_raw_statistics(rules):
    """Every class has rules, and every condition is a threshold on a line's own statistic."""
    assert {label for label, _ in rules} == set(quality.ORDER)
    assert all(c.feature in quality.LINE for _, rule in rules for c in rule)


def test_very_long_text(spark, rules):
    assert kinds(spark, rules, ["word " * 200_000]) == ["junk"]


def test_very_long_lines(spark, rules):
    texts = ["=" * 300_000, "ab;" * 100_000, "7f " * 100_000, "a" * 300_000, "{" * 10 + "x=1;" * 50_000, "The cat sat on the mat and was not seen again. " * 5_000]
    assert kinds(spark, rules, texts) == ["junk", "junk", "junk", "junk", "junk", "prose"]
