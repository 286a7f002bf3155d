import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmere.llm import mixing, tokens

TEXTS = ["", None, " ", "a", "Größe  \n\n x", "=" * 5000, "ab " * 3000, "x" * 3000 + "  \n y", "it's they'll " * 500, "​﻿🙂" * 700, "<|endoftext|> ordinary"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id bigint, text string, key int")


@pytest.mark.parametrize(("chunk", "overlap"), [(65536, 2048), (300, 60), (64, 16)])
def test_equal_to_whole_texts(spark, chunk, overlap):
    enc = tokens._encoding(tokens.vocabulary_path())
    got = {r.doc_id: list(r.ids) for r in tokens.encode(frame(spark, TEXTS), chunk=chunk, overlap=overlap).collect()}
    assert got == {i: enc.encode_ordinary(t) if t else [] for i, t in enumerate(TEXTS)}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab c\n'tl1.é  "), max_size=400), min_size=1, max_size=8))
def test_random_texts(spark, texts):
    enc = tokens._encoding(tokens.vocabulary_path())
    got = {r.doc_id: list(r.ids) for r in tokens.encode(frame(spark, texts), chunk=48, overlap=16).collect()}
    assert got == {i: enc.encode_ordinary(t) for i, t in enumerate(texts)}


def test_decoding_gives_the_text(spark):
    ids = tokens.encode(frame(spark, TEXTS), chunk=300, overlap=60)
    assert {r.doc_id: r.text for r in tokens.decode(ids).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert tokens.encode(frame(spark, TEXTS).limit(0)).count() == 0


def test_counts(spark):
    enc = tokens._encoding(tokens.vocabulary_path())
    assert {r.doc_id: r.tokens for r in tokens.token_counts(frame(spark, TEXTS)).collect()} == {i: len(enc.encode_ordinary(t)) if t else 0 for i, t in enumerate(TEXTS)}


def test_counts_of_long_texts_keep_columns(spark):
    enc = tokens._encoding(tokens.vocabulary_path())
    got = tokens.token_counts(frame(spark, TEXTS).withColumnRenamed("key", "source"), keep=("source",), chunk=300, overlap=60).collect()
    assert {(r.doc_id, r.source, r.tokens) for r in got} == {(i, 5, len(enc.encode_ordinary(t)) if t else 0) for i, t in enumerate(TEXTS)} and len(got) == len(TEXTS)


def test_blocks_take_the_chunk_path(spark):
    """Blocks of the real documents exceed the production chunk, are cut, and equal whole-text encoding."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    b = tokens.blocks(docs)
    whole = {r.block: r.text for r in b.collect()}
    enc = tokens._encoding(tokens.vocabulary_path())
    got = tokens.encode(b, key="block", count_pieces=True).collect()
    assert {r.block: list(r.ids) for r in got} == {k: enc.encode_ordinary(t) for k, t in whole.items()}
    long = {k for k, t in whole.items() if len(t) > tokens.CHUNK}
    assert long and all(r.pieces > 1 for r in got if r.block in long)
    assert tokens.blocks(docs.limit(0)).count() == 0


TARGETS = [("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 2), ("absent", 0.1, 5), ("zero", 0.0, 0)]


def sized(spark, n=4000):
    rows = [(i, "a" if i % 10 < 7 else "b" if i % 10 < 9 else "c", 20 + i * 37 % 400) for i in range(n)] + [(n, None, 10), (n + 1, "unlisted", 10), (n + 2, "a", 0), (n + 3, "zero", 50)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint")


def test_mix_meets_its_shares(spark):
    d = sized(spark)
    t = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    m = mixing.mix(d, t)
    s = {r.source: r for r in mixing.shares(m, d, t).collect()}
    assert {k: round(r.actual_share, 2) for k, r in s.items()} == {"a": 0.5, "b": 0.3, "c": 0.2, "absent": 0.0, "zero": 0.0}
    assert all(r.most_copies <= r.max_repeats for r in s.values())
    assert m.count() == m.select("doc_id").distinct().count()
    for n in (1, 3, 7):
        assert sorted(map(tuple, m.collect())) == sorted(map(tuple, mixing.mix(d.repartition(n), t).collect()))


def test_mix_of_given_size_and_edges(spark):
    d, t = sized(spark), spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    total = mixing.mix(d, t, 100_000).selectExpr("sum(tokens * copies) as n").first().n
    assert abs(total - 100_000) < 1500
    assert mixing.mix(d.limit(0), t).count() == 0
    assert mixing.mix(d, t.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "a", 7)], "doc_id bigint, source string, tokens bigint")
    assert [(r.doc_id, r.copies) for r in mixing.mix(one, t).collect()] == [(1, 1)]
