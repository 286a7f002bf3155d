"""Problem 7: the whole corpus as token ids of a public byte-level tokenizer.

Texts up to a chunk are encoded as they are. A longer text is cut into overlapping chunks
that different tasks pre-tokenise in parallel. Pre-tokenisation reads left to right and looks
only ahead, so two neighbouring chunks that share one boundary agree from there on: the
text is cut at the first shared boundary of each overlap, and the pieces between the cuts are
encoded independently. From an overlap without a shared boundary on, the rest of
the text stays one piece, so the ids equal those of the whole text in every case. Decoding concatenates raw bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK, OVERLAP = 65_536, 2_048  # characters


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Place of a vocabulary file of the installed public collection."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def _encoding(path: str):
    """The tokenizer of a rank file, once per worker process."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _pattern():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


def _encode(path: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(path)
        for b in batches:
            ids = [enc.encode_ordinary(t) if t else [] for t in b.column("text").to_pylist()]
            out = pa.array(ids, pa.list_(pa.int32())) if keep_ids else pa.array([len(x) for x in ids], pa.int64())
            rest = [(n, b.column(n)) for n in b.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([c for _, c in rest] + [out], names=[n for n, _ in rest] + ["ids" if keep_ids else "tokens"])

    return run


def _boundaries(chunk: int, overlap: int):
    """Match starts behind no blank, in the first and in the last ``overlap`` characters of a chunk, as text positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = _pattern()
        for b in batches:
            heads, tails = [], []
            for off, text, final in zip(b.column("off").to_pylist(), b.column("chunk").to_pylist(), b.column("final").to_pylist()):
                n, head, tail, sure = len(text), [], [], True
                for m in pattern.finditer(text):
                    at = m.start()
                    # Blanks before a cut would no longer see what follows them.
                    clean = not text[at - 1 : at].isspace()
                    # A match up to the chunk's end may go on beyond it; its start is still a boundary.
                    if sure and clean and at < overlap:
                        head.append(off + at)
                    if sure and clean and at >= chunk:
                        tail.append(off + at)
                    sure = final or m.end() <= n - 3  # the pattern looks at most that far ahead
                heads.append(head)
                tails.append(tail)
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("k"), pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))], names=["key", "k", "head", "tail"])

    return run


def pieces(docs: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, at, text): independent pieces of every text of more than ``chunk`` characters."""
    n = F.length("text")
    long = docs.filter(n > chunk)
    cut = long.select("key", "text", F.explode(F.sequence(F.lit(0), n - 1, F.lit(chunk))).alias("off"))
    cut = cut.select("key", (F.col("off") / chunk).cast("int").alias("k"), "off", F.expr(f"substring(text, off + 1, {chunk + overlap})").alias("chunk"), (F.col("off") + chunk + overlap >= n).alias("final"))
    # Each chunk may go to another task: a long text isn't the work of one.
    cut = cut.repartition("key", "k")
    found = cut.mapInArrow(_boundaries(chunk, overlap), f"key {docs.schema['key'].dataType.simpleString()}, k int, head array<int>, tail array<int>")
    left = found.select("key", (F.col("k") + 1).alias("k"), "tail")
    shared = left.join(found.select("key", "k", "head"), ["key", "k"]).select("key", "k", F.array_min(F.array_intersect("tail", "head")).alias("at"))
    # A chunk's boundaries hold from its first cut on; behind an overlap without one, none are known to.
    unbroken = F.min(F.col("at").isNotNull()).over(Window.partitionBy("key").orderBy("k"))
    shared = shared.withColumn("unbroken", unbroken).filter("unbroken").select("key", "at")
    cuts = shared.groupBy("key").agg(F.array_sort(F.collect_list("at")).alias("cuts"))  # one entry a chunk
    p = long.join(cuts, "key", "left").withColumn("cuts", F.concat(F.array(F.lit(0)), F.coalesce("cuts", F.array().cast("array<int>"))))
    p = p.select("key", "text", F.posexplode("cuts").alias("i", "at"), F.col("cuts"))
    return p.select("key", "at", F.expr("substring(text, at + 1, coalesce(get(cuts, i + 1), length(text)) - at)").alias("text"))


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP, count_pieces: bool = False) -> DataFrame:
    """(key, ids): token ids of each row's text, no special tokens; null and empty text: an empty list.

    Repeated rows come out as often as they came in if their keys differ; ``key`` must be
    unique. The rank file's ``path`` must be readable on every executor. ``count_pieces`` adds
    ``pieces``, the number of independently encoded pieces of the text.
    """
    path = path or vocabulary_path()
    kind = docs.schema[key].dataType.simpleString()
    d = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    short = d.filter(F.coalesce(F.length("text"), F.lit(0)) <= chunk).mapInArrow(_encode(path, True), f"key {kind}, ids array<int>").withColumn("pieces", F.lit(1))
    parts = pieces(d, chunk, overlap).repartition("key", "at").mapInArrow(_encode(path, True), f"key {kind}, at int, ids array<int>")
    whole = parts.groupBy("key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "ids"))), lambda x: x["ids"])).alias("ids"), F.count("*").cast("int").alias("pieces"))
    return short.unionByName(whole).select(F.col("key").alias(key), "ids", *["pieces"] * count_pieces)


def blocks(docs: DataFrame, size: int = 200) -> DataFrame:
    """(block, text): the texts of ``size`` consecutive ids as one, parted by an empty line.

    A block holds at most ``size`` documents as ids are unique; null and empty texts take no part in it.
    """
    rows = docs.filter("text <> ''").select(F.floor(F.col("doc_id") / size).alias("block"), F.struct("doc_id", "text").alias("d"))
    return rows.groupBy("block").agg(F.array_join(F.transform(F.array_sort(F.collect_list("d")), lambda x: x["text"]), "\n\n").alias("text"))


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, keep: tuple[str, ...] = (), chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, *keep, tokens): sizes alone, for texts of any length, with the row's columns ``keep``."""
    path = path or vocabulary_path()
    kind = docs.schema[key].dataType.simpleString()
    d = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *[F.col(c).alias(f"k_{c}") for c in keep])
    kept = "".join(f", k_{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    short = d.filter(F.coalesce(F.length("text"), F.lit(0)) <= chunk).mapInArrow(_encode(path, False), f"key {kind}{kept}, tokens bigint")
    parts = pieces(d.select("key", "text"), chunk, overlap).repartition("key", "at").mapInArrow(_encode(path, False), f"key {kind}, at int, tokens bigint")
    long = parts.groupBy("key").agg(F.sum("tokens").alias("tokens"))
    if keep:
        long = long.join(d.filter(F.length("text") > chunk).drop("text"), "key")
    out = short.unionByName(long)
    return out.select(F.col("key").alias(key), *[F.col(f"k_{c}").alias(c) for c in keep], "tokens")


def decode(ids: DataFrame, key: str = "doc_id", path: str | None = None) -> DataFrame:
    """(key, text) of (key, ids): the tokens' raw bytes, concatenated, as UTF-8."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(path)
        for b in batches:
            text = [b"".join(enc.decode_tokens_bytes(x)).decode("utf-8", errors="replace") for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(text, pa.string())], names=[key, "text"])

    return ids.select(key, "ids").mapInArrow(run, f"{key} {ids.schema[key].dataType.simpleString()}, text string")
