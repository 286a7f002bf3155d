"""Problem 6: text of scanned pages repaired into continuous paragraphs.

Three steps, each on all rows. Lines of page matter are removed where the text doesn't run on
into them: a line's form (digits and confusable characters folded) that comes back, with
neighbours it doesn't continue, stands at a page's edge. Word pairs inside the lines of the whole
corpus tell whether a line continues its neighbours. Page numbers, continuation and print marks are known by
their words as well. Words divided at line
or page ends are joined; whether the hyphen stays is decided by the counts of both spellings
in the whole corpus. Misread words are found with anagram hashes: the hash of a word is a sum
over its characters, so replacing a confusable sequence changes it by a constant. A rare word
is joined by equality of hash plus that constant with the frequent words, and the candidates
are verified and ranked. Only distinct words enter that join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import let
from ..session import cut_lineage

# Fixed values: (as read, as printed) sequences that scanners confuse.
_SHAPES = ["l 1", "I l", "I 1", "i 1", "0 o", "0 O", "5 s", "5 S", "8 B", "9 g", "6 b", "2 Z", "t f", "e c", "u v", "rn m", "cl d", "vv w", "P F", "h b", "6 G", "nn m", "a o"]
_ONE_WAY = ["! i", "! l", "| l", "| I", "à a", "á a", "â a", "ä a", "å a", "è e", "é e", "ê e", "ì i", "í i", "ò o", "ó o", "ö o", "ù u", "ú u", "ü u", "ñ n", "ç c", "i l", "l i", "( c", "$ s", "@ a", "q g", "li h", "ii u", "ri n", "n ri", "l t", "ﬁ fi", "ﬂ fl", "ﬀ ff", "c o", "n r", "in m", "ni m", "iii m"]
CONFUSIONS = sorted({p for s in _SHAPES for a, b in [s.split()] for p in ((a, b), (b, a))} | {tuple(s.split()) for s in _ONE_WAY})

# The same confusions as a folding of single characters, for recognising fixed page words.
_FOLD_FROM = "tpev019!|i5àáâäåèéêìíòóöùúü8q"
_FOLD_TO = "ffcuolgllls" + "aaaaa" + "ccc" + "ll" + "ooo" + "uuu" + "bg"
RATIO = 5  # a word is corrected to one at least so many times as frequent


_HYPHEN = r"[-\x{2010}\x{2011}\x{00AD}\x{00AC}]"


def fold(text: Column) -> Column:
    return F.translate(F.lower(text), _FOLD_FROM, _FOLD_TO)


def _folded(word: str) -> str:
    return word.lower().translate(str.maketrans(_FOLD_FROM, _FOLD_TO))


_SPACE = " \t\r\f\v\u00a0\ufeff\u200b"


def lines_of(text: Column) -> Column:
    return F.transform(F.split(text, r"\r\n|\n|\r|\f|\x{2028}|\x{2029}", -1), lambda x: F.btrim(x, F.lit(_SPACE)))


def is_numbered(line: Column) -> Column:
    """Page numbers, continuation marks, print and fax stamps: known by their words wherever they stand."""
    return let(F.struct(line.alias("t"), fold(line).alias("f")), lambda x: _numbered(x["t"], x["f"]))


def _numbered(line: Column, f: Column) -> Column:
    n = r"[0-9olgsbz]{1,4}"  # digits, also folded ones
    page, pg, of = _folded("page"), _folded("pg"), _folded("of")
    number = rf"^[\W_]*(?:{page}|{pg}|{_folded('p')})?[.:]?\s*{n}(?:\s*(?:/|{of}|o.|.f)\s*{n})?[\W_]*$"
    marks = rf"^[\W_]*(?:{_folded('continued')}|{_folded('cont')}\.?)(?: (?:on|from) {_folded('next')}.*| on .*{page}.*)?[\W_]*$"
    stamps = rf"^(?:{_folded('printed')} .*\d|{_folded('fax')}: ?.*\d|.*{page}: ?{n})$"
    has_digit = line.rlike(r"\d|^[\W_]*[lIO][\W_]*$")
    # Most lines hold neither a digit nor the words of a mark: two plain searches settle them.
    marked = F.contains(f, F.lit(_folded("cont"))) & f.rlike(marks)
    return (line != "") & ((has_digit & (f.rlike(number) | f.rlike(stamps))) | marked)


LEAST_TIMES, LEAST_BREAKS = 3, 0.6  # times a form must come back; share of its telling places where the text doesn't run on


def _form(line: Column) -> Column:
    """A line without what differs from page to page (numbers, case, misread characters); null for lines that are text by a sentence end or a divided word."""
    text = line.rlike(r"[.!?:;,][\W_]*$|[.!?] +\p{L}|" + _HYPHEN + r"\s*$") | ~line.rlike(r"\p{L}\P{L}{0,3}\p{L}")
    return F.when(~text, fold(F.regexp_replace(F.regexp_replace(line, r"(?<![\p{L}\d])\d+(?![\p{L}\d])", "#"), r"[^\p{L}\p{N}#!|]+", " ")))


def _page_forms(lines: DataFrame) -> DataFrame:
    """(form) of the lines that come back at page edges, from ``id``, ``ls`` (array of struct(t, numbered, form)).

    Lines with a sentence end or a divided word in them are text. At a place the text runs on from the line before or into the
    next if a line of the corpus holds the pair of words there, or if the pair comes back over the same line break (fixed
    paragraphs); it breaks off if not. At the beginning and the end of a text, after a hyphen and after a sentence end nothing can be
    told. A form is page matter if the text runs on at few of its places and breaks off on both sides at two or more.
    """
    word = lambda line, last: F.lower(F.regexp_extract(line, r"([\p{L}\p{N}]+)[^\p{L}\p{N}]*$" if last else r"^[^\p{L}\p{N}]*([\p{L}\p{N}]+)", 1))
    kept = lines.select("id", F.filter("ls", lambda x: ~x["numbered"]).alias("k"))
    at = kept.select(F.posexplode("k").alias("i", "x"), "k").filter("x.form is not null").select("x.form", "x.t", F.get("k.t", F.col("i") - 1).alias("before"), F.get("k.t", F.col("i") + 1).alias("after"))
    back = at.groupBy("form").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_TIMES)
    at = cut_lineage(
        at.join(back, "form").withColumn("place", F.monotonically_increasing_id()).select(
            "form",
            "n",
            "place",
            F.explode(
                F.array(
                    F.struct(F.col("before").isNull().alias("edge"), F.col("before").rlike(_HYPHEN + r"\s*$|[.!?][\W_]*$").alias("open"), F.xxhash64(word(F.col("before"), True), word(F.col("t"), False)).alias("pair")),
                    F.struct(F.col("after").isNull().alias("edge"), F.lit(False).alias("open"), F.xxhash64(word(F.col("t"), True), word(F.col("after"), False)).alias("pair")),
                )
            ).alias("s"),
        ).select("form", "n", "place", "s.*")
    )
    words = lambda x: F.filter(F.split(F.lower(x["t"]), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    pairs = lambda w: F.zip_with(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    inside = lines.select(F.explode(F.array_distinct(F.flatten(F.transform("ls", lambda x: let(words(x), pairs))))).alias("pair")).distinct()
    across = at.filter("not edge").groupBy("form", "pair").agg(F.count("*").alias("m"), F.first("n").alias("n")).filter((F.col("m") >= LEAST_TIMES) & (F.col("m") > 0.2 * F.col("n"))).select("pair")
    runs = at.select("pair").distinct().join(inside, "pair", "left_semi").unionByName(across).distinct().withColumn("runs", F.lit(True))
    sides = at.join(runs, "pair", "left").withColumn("broken", F.when(~F.col("edge") & ~F.col("open"), F.col("runs").isNull()))
    places = sides.groupBy("form", "place").agg(F.count_if("broken").alias("broken"), F.count_if(~F.col("broken")).alias("runs"))
    share = F.avg(F.when(F.col("runs") + F.col("broken") > 0, (F.col("runs") == 0).cast("int"))).alias("share")
    return places.groupBy("form").agg(share, F.count_if(F.col("broken") == 2).alias("both")).filter(f"share >= {LEAST_BREAKS} and both >= 2").select("form")


SPLIT = rf"(?<!\S)(\S*[\p{{L}}\d]){_HYPHEN} *\n([\p{{L}}\d!|][^\s\n]*)"


def _trim(token: Column) -> Column:
    """Punctuation around a word goes; a leading sign that may stand for a letter stays before letters."""
    return F.regexp_replace(token, r"^[^\p{L}\p{N}]*?(?=[!|]\p{Ll}|[\p{L}\p{N}]|$)|(?<=[\p{L}\p{N}])[^\p{L}\p{N}]+$", "")


TOKEN = r"(?:[!|](?=\p{Ll}))?[\p{L}\p{N}](?:\S*[\p{L}\p{N}])?"  # a word without the punctuation around


def body(df: DataFrame, text: str) -> DataFrame:
    """Add ``page_lines`` and ``body`` (the other lines, by newline, hyphens at ends intact) to the rows.

    Repeated rows count each; rows are told apart by their place in the input alone.
    """
    judged = F.transform(F.filter(lines_of(F.col(text)), lambda x: x != ""), lambda x: let(F.struct(x.alias("t"), is_numbered(x).alias("n")), lambda y: F.struct(y["t"].alias("t"), y["n"].alias("numbered"), F.when(~y["n"], _form(y["t"])).alias("form"))))
    lines = cut_lineage(df.withColumn("ls", judged).drop(text)).withColumn("id", F.monotonically_increasing_id())
    forms = cut_lineage(_page_forms(lines))
    # A row's own page forms, as many as its lines, come back to it.
    own = lines.select("id", F.explode(F.array_compact(F.array_distinct("ls.form"))).alias("form")).join(forms, "form").groupBy("id").agg(F.collect_set("form").alias("forms"))
    df = lines.join(own, "id", "left")
    flagged = F.when(F.col("forms").isNull(), F.transform("ls", lambda x: F.struct(x["t"].alias("t"), x["numbered"].alias("p")))).otherwise(
        F.transform("ls", lambda x: F.struct(x["t"].alias("t"), (x["numbered"] | F.coalesce(F.array_contains("forms", x["form"]), F.lit(False))).alias("p")))
    )
    both = let(flagged, lambda a: F.struct(F.transform(F.filter(a, lambda x: x["p"]), lambda x: x["t"]).alias("page_lines"), F.array_join(F.transform(F.filter(a, lambda x: ~x["p"]), lambda x: x["t"]), "\n").alias("body")))
    df = df.withColumn("__both", both)
    return df.withColumns({"page_lines": F.col("__both.page_lines"), "body": F.col("__both.body")}).drop("__both", "ls", "forms", "id")


def words(rows: DataFrame, once: bool = False) -> DataFrame:
    """(keys, token) of ``words``. ``once``: each word once a row."""
    return rows.select("source_table", "row_id", F.explode(F.array_distinct("words") if once else F.col("words")).alias("token"))


def anagram_hash(token: Column) -> Column:
    """Sum of fifth powers of the characters' codes: equal for anagrams, additive for replacements."""
    return F.aggregate(F.split(token, ""), F.lit(0).cast("bigint"), lambda s, c: s + _power(c))


def _power(c: Column) -> Column:
    code = F.pmod(F.ascii(c), F.lit(1000)).cast("bigint")
    return code * code * code * code * code


def _hash_of(text: str) -> int:
    return sum((ord(c) % 1000) ** 5 for c in text)


def corrections(lexicon: DataFrame) -> DataFrame:
    """(token, right) for rare words that differ from a frequent one by confusions alone.

    ``lexicon``: token, n. Up to two confusions at once; among candidates the fewest
    confusions win, then the most frequent word, then the first in order.
    """
    table = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(_hash_of(b) - _hash_of(a)).cast("bigint").alias("d"), F.lit(max(len(a), len(b))).alias("c")) for a, b in CONFUSIONS])
    # Only words that some other is RATIO times as frequent as can be wrong.
    most = lexicon.agg(F.max("n").alias("most"))
    w = lexicon.filter((F.length("token") >= 2) & F.col("token").rlike(r"[\p{L}\d]")).join(F.broadcast(most)).filter(F.col("n") * RATIO <= F.col("most")).drop("most")
    w = w.withColumn("fit", F.filter(table, lambda x: F.contains(F.col("token"), x["a"])))
    single = F.transform("fit", lambda x: F.struct(x["d"].alias("d"), x["c"].alias("c"), F.lit(1).alias("k")))
    double = F.flatten(F.transform("fit", lambda x: F.transform("fit", lambda y: F.struct((x["d"] + y["d"]).alias("d"), (x["c"] + y["c"]).alias("c"), F.lit(2).alias("k")))))
    base = anagram_hash(F.col("token"))
    probes = w.select("token", "n", base.alias("h"), F.explode(F.array_distinct(F.concat(single, double))).alias("p"))
    probes = probes.select("token", "n", (F.col("h") + F.col("p.d")).alias("h"), F.col("p.c").alias("cost"), F.col("p.k").alias("k"))
    targets = lexicon.filter((F.length("token") >= 1) & (F.col("n") >= RATIO)).select(F.col("token").alias("right"), F.col("n").alias("m"), anagram_hash(F.col("token")).alias("h"))
    hit = probes.join(targets, "h").filter((F.col("m") >= RATIO * F.col("n")) & (F.col("token") != F.col("right")) & (F.levenshtein("token", "right") <= F.col("cost")) & _alike(F.col("token"), F.col("right")))
    return hit.groupBy("token").agg(F.min(F.struct("k", (-F.col("m")).alias("m"), "right")).alias("b"), F.first("n").alias("n")).select("token", F.col("b.right").alias("right"))


def _alike(wrong: Column, right: Column) -> Column:
    """Plain numbers are never turned into other plain numbers, nor capitalisation alone changed."""
    return ~(wrong.rlike(r"^[\d.,-]+$") & right.rlike(r"^[\d.,-]+$")) & (F.lower(wrong) != F.lower(right))


def repaired(rows: DataFrame) -> dict[str, DataFrame]:
    """The stages for (source_table, row_id, text): rows with body, lexicon, corrections, splits.

    Null, empty and blank texts have no lines and give nothing. Repeated rows count again in
    the corpus counts. Texts are read whole.
    """
    rows = body(rows.select("source_table", "row_id", "text").filter("text is not null"), "text")
    # The whole words of the body, without those at divided line ends.
    rows = cut_lineage(rows.withColumn("words", F.regexp_extract_all(F.regexp_replace("body", SPLIT, " "), F.lit(TOKEN), F.lit(0))))
    lexicon = cut_lineage(words(rows).groupBy("token").agg(F.count("*").alias("n")))
    pieces = rows.select("source_table", "row_id", F.regexp_extract_all("body", F.lit(SPLIT), F.lit(1)).alias("a"), F.regexp_extract_all("body", F.lit(SPLIT), F.lit(2)).alias("b"))
    pieces = pieces.select("source_table", "row_id", F.explode(F.arrays_zip("a", "b")).alias("p")).select("source_table", "row_id", F.col("p.a").alias("a"), F.col("p.b").alias("b"))
    both = pieces.select("a", "b").distinct().withColumns({"plain": _trim(F.concat("a", "b")), "kept": _trim(F.concat_ws("-", "a", "b"))})
    fix = corrections(lexicon.unionByName(_unknown(both, lexicon)))
    fix = cut_lineage(fix)
    right = lambda c: _lookup(_lookup(both, c, fix.select("token", F.col("right").alias("v")), c + "_r"), c + "_r", lexicon.select("token", F.col("n").alias("v")), c + "_n")
    both = right("plain")
    both = _lookup(_lookup(both, "kept", fix.select("token", F.col("right").alias("v")), "kept_r"), "kept_r", lexicon.select("token", F.col("n").alias("v")), "kept_n")
    both = both.withColumn("word", F.when(F.coalesce("kept_n", F.lit(0)) > F.coalesce("plain_n", F.lit(0)), F.col("kept_r")).otherwise(F.col("plain_r")))
    both = both.withColumn("as_read", F.when(F.coalesce("kept_n", F.lit(0)) > F.coalesce("plain_n", F.lit(0)), F.col("kept")).otherwise(F.col("plain")))
    splits = pieces.join(both.select("a", "b", "word", "as_read"), ["a", "b"])
    return {"rows": rows, "tokens": words(rows, once=True), "lexicon": lexicon, "fix": fix, "splits": splits}


def _unknown(both: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Joined words the lexicon lacks, as rare words to correct."""
    c = both.select(F.explode(F.array("plain", "kept")).alias("token")).distinct().filter("token <> ''")
    return c.join(lexicon.select("token"), "token", "left_anti").withColumn("n", F.lit(0).cast("bigint"))


def _lookup(df: DataFrame, column: str, table: DataFrame, out: str) -> DataFrame:
    """``table``'s ``v`` for the value of ``column``; for strings the value itself where absent."""
    joined = df.join(table.withColumnsRenamed({"token": "__t", "v": "__v"}), F.col(column) == F.col("__t"), "left")
    value = F.coalesce("__v", F.col(column)) if dict(table.dtypes)["v"] == "string" else F.col("__v")
    return joined.withColumn(out, value).drop("__t", "__v")


def found(rows: DataFrame) -> DataFrame:
    """(source_table, row_id, kind, found), each distinct row once."""
    s = repaired(rows)
    pages = s["rows"].select("source_table", "row_id", F.lit("page_line").alias("kind"), F.explode("page_lines").alias("found"))
    split = s["splits"].select("source_table", "row_id", F.lit("split_word").alias("kind"), F.col("word").alias("found"))
    both = s["splits"].filter("word <> as_read").select("source_table", "row_id", F.lit("misread").alias("kind"), F.col("word").alias("found"))
    misread = s["tokens"].join(s["fix"], "token").select("source_table", "row_id", F.lit("misread").alias("kind"), F.col("right").alias("found"))
    return reduce(DataFrame.unionByName, [pages, split, both, misread]).distinct()


def paragraphs(rows: DataFrame) -> DataFrame:
    """(source_table, row_id, repaired): words whole and right, page matter gone, lines joined.

    The corrections of a row are gathered per row: as many as its own wrong words.
    """
    s = repaired(rows)
    swaps = s["tokens"].join(s["fix"], "token").select("source_table", "row_id", F.struct(F.col("token").alias("x"), F.col("right").alias("y")).alias("w")).distinct()
    swaps = swaps.groupBy("source_table", "row_id").agg(F.sort_array(F.collect_list("w")).alias("swaps"))
    joins = s["splits"].select("source_table", "row_id", F.struct("a", "b", "word", "as_read").alias("j")).distinct().groupBy("source_table", "row_id").agg(F.sort_array(F.collect_list("j")).alias("joins"))
    r = s["rows"].select("source_table", "row_id", "body").join(swaps, ["source_table", "row_id"], "left").join(joins, ["source_table", "row_id"], "left")
    quoted = lambda t: F.concat(F.lit(r"\Q"), t, F.lit(r"\E"))
    text = F.aggregate(
        F.coalesce("joins", F.array()),
        F.col("body"),
        lambda t, j: F.regexp_replace(t, F.concat(quoted(j["a"]), F.lit(_HYPHEN + r" *\n"), quoted(j["b"])), _literal(F.replace(F.when(F.contains(j["as_read"], F.lit("-")), F.concat_ws("-", j["a"], j["b"])).otherwise(F.concat(j["a"], j["b"])), j["as_read"], j["word"]))),
    )
    text = F.regexp_replace(text, r"\s*\n\s*", " ")
    text = F.aggregate(F.coalesce("swaps", F.array()), text, lambda t, w: F.regexp_replace(t, F.concat(F.lit(r"(?<![\p{L}\p{N}])"), quoted(w["x"]), F.lit(r"(?![\p{L}\p{N}])")), _literal(w["y"])))
    return r.select("source_table", "row_id", text.alias("repaired"))


def _literal(text: Column) -> Column:
    """Text as a replacement string: backslashes and dollars stand for themselves."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))


def reports(impressions: DataFrame, backgrounds: DataFrame) -> DataFrame:
    a = impressions.select(F.lit("technologist_impression").alias("source_table"), F.col("impression_row_id").alias("row_id"), F.col("raw_text").alias("text"))
    return a.unionByName(backgrounds.select(F.lit("eeg_background").alias("source_table"), F.col("background_row_id").alias("row_id"), F.col("raw_background_text").alias("text")))
