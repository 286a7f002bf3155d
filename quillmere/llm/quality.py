"""Problem 9: statistics of each document's text that tell prose from lists, tables and junk.

All statistics are native expressions over the whole text, of the document and of each of its
lines. What a line's statistics mean is learned: an ordered rule list is induced by incremental
reduced-error pruning on lines of labelled texts (``labelled.py``, a bounded sample composed for
the purpose), and its thresholds become one SQL CASE expression that names the kind of every
line in the same pass. A document is of the kind that holds more than half of its characters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.temporal import let, once
from . import labelled

SAMPLE = 4000  # labelled texts the rules are induced on
CHOICE, LISTS = 1500, 5  # labelled texts that choose among so many rule lists

# Frequent words of English, German, Spanish and French.
COMMON = sorted(
    set(
        """the of and to in is was with for on that at by this as are were be from no not it an or which has had have there within without during
        der die das und in den von zu mit ist im auf des ein eine nicht sich wurde dem für als keine bei oder über einer zeigte
        el la los las de y en que un una no se con por para del al es fue su sin durante o más hubo
        le les des et du une dans est pas sur pour par avec au ne qui ce il sans sont on aux lors""".split()
    )
)

_LINE_END = r"\r\n|[\n\r\f\x{0085}\x{2028}\x{2029}]"
_BULLET = r"^\s*(?:[-*+•‣◦▪▫●○·–—>»✓☐☑]|\(?\d{1,3}[.)]|\(?[A-Za-z][.)]|\[[ xX]?\]|\(?[ivx]{1,4}[.)])\s+\S"
# Signs beyond ASCII that the languages use, and vowels.
_NATIVE = "äöüßéèêëàâçîïôûùñáíóúæøåœÄÖÜÉÈÀÂÇÑÁÍÓÚÆØÅ‘’“”«»–—•…°µ¿¡"
_VOWELS = "aeiouyáéíóúàèùâêîôûäöüåøæëï"
_ENDS = list(".!?;:,…")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _signs(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def _delimiters(line: Column, sign: str) -> Column:
    """Signs of a line in which none is followed by a blank."""
    return F.when(F.contains(line, F.lit(sign + " ")) | F.contains(line, F.lit(sign + "\t")), 0).otherwise(_signs(line, sign))


def _base(line: Column) -> Column:
    """What several statistics of a line share: t text, b without blanks, w words, n characters, k tokens (1 at least)."""
    bare = F.regexp_replace(line, r"\s+", "")
    return let(bare, lambda b: F.struct(line.alias("t"), b.alias("b"), F.greatest(F.length(b), F.lit(1)).alias("n"), F.greatest(_count(line, r"\S+"), F.lit(1)).alias("k"), F.filter(F.split(F.lower(line), r"[^\p{L}\p{N}_]+"), lambda w: w != "").alias("w")))


def _beyond(text: Column) -> Column:
    """Characters beyond ASCII."""
    return F.length(text) - _without(text, r"[^\x00-\x7F]+")


# Statistics of a line, from ``_base``.
LINE = {
    "letters": lambda x: _without(x["t"], r"\P{L}+") / x["n"],
    "digits": lambda x: (F.length(x["t"]) - _without(x["t"], "[0-9]+")) / x["n"],
    "tokens": lambda x: x["k"],
    "token_length": lambda x: x["n"] / x["k"],
    "length": lambda x: F.length(x["t"]),
    "tabs": lambda x: _signs(x["t"], "\t"),
    "gaps": lambda x: F.when(F.contains(x["t"], F.lit("  ")), _count(x["t"], r"\S {2,}(?=\S)")).otherwise(0),
    "wide_gaps": lambda x: F.when(F.contains(x["t"], F.lit("   ")), _count(x["t"], r"\S {3,}(?=\S)")).otherwise(0),
    "pipes": lambda x: _signs(x["t"], "|"),
    "delimiters": lambda x: F.greatest(*[_delimiters(x["t"], s) for s in ";,~"]),
    "marked": lambda x: x["t"].rlike(_BULLET).cast("int"),
    "ended": lambda x: F.substring(F.rtrim(x["b"], F.lit("'\"»”)")), -1, 1).isin(_ENDS).cast("int"),
    "words": lambda x: F.size(x["w"]),
    "distinct": lambda x: F.size(F.array_distinct(x["w"])) / F.greatest(F.size(x["w"]), F.lit(1)),
    "common": lambda x: F.size(F.filter(x["w"], lambda w: w.isin(COMMON))) / F.greatest(F.size(x["w"]), F.lit(1)),
    "foreign": lambda x: F.when(F.octet_length(x["t"]) > F.length(x["t"]), _beyond(F.translate(x["t"], _NATIVE, "")) / x["n"]).otherwise(0.0),
    "switches": lambda x: _count(x["t"], r"\p{L}\d|\d\p{L}|\p{Ll}\p{Lu}") / x["k"],
    "vowelless": lambda x: F.size(F.filter(x["w"], lambda w: F.length(w).between(4, 24) & ~w.rlike(f"[{_VOWELS}]"))) / F.greatest(F.size(x["w"]), F.lit(1)),
    "pairs": lambda x: F.when(x["n"] < 4 * x["k"], _count(x["t"], r"(?<!\S)[0-9A-Fa-f]{2}(?!\S)") / x["k"]).otherwise(0.0),
    "others": lambda x: F.length(F.replace(x["b"], F.substring(x["b"], 1, 1), F.lit(""))) / x["n"],
    "heading": lambda x: x["t"].rlike(r"^\p{Lu}[\p{Lu} /&-]+$").cast("int"),
}
FEATURES = list(LINE)


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, _LINE_END, -1), lambda x: x.rlike(r"\S"))


def line_statistics(line: Column, only: set[str] | None = None) -> Column:
    """struct of the line's statistics as doubles, with ``chars``, its non-blank characters.

    No pattern repeats a group without a bound: lines may be of any length. ``only`` limits the work to the named ones.
    """
    wanted = [n for n in FEATURES if only is None or n in only]
    return let(_base(line), lambda x: F.struct(F.length(x["b"]).alias("chars"), *[LINE[n](x).cast("double").alias(n) for n in wanted]))


MEASURES = ["mean_word_length", "symbol_ratio", "digit_ratio", "ended_share", "common_share", "distinct_share", "repeat_share", "words_a_line", "chars_a_line", "item_share", "short_share", "cell_share"]


def statistics(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics of each row's text: (key, chars, words, ...), zero or null-safe for null and empty texts.

    ``ended_share`` counts lines, the other shares of lines are weighed by non-blank characters. Texts are read whole; a
    single long line is one line. Other columns are ignored, repeated rows come out again.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    facts = F.transform(lines_of(t), lambda x: line_statistics(x, {"marked", "ended", "tokens", "gaps", "tabs", "pipes", "delimiters"}))
    d = df.select(F.col(key), t.alias("__t"), F.regexp_extract_all(F.lower(t), F.lit(r"\p{L}[\p{L}'’]*"), F.lit(0)).alias("__w"), facts.alias("__l"), F.split(F.btrim(F.lower(t)), r"\s+").alias("__r"))
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x["chars"])
    d = d.withColumns({"chars": total(F.col("__l")), "words": F.size("__w"), "lines": F.size("__l")})
    safe = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0)).cast("double")
    weight = lambda test: total(F.filter("__l", test))
    c, w, n = F.col("chars"), F.col("words"), F.col("lines")
    m = F.size("__r") - 1
    measured = {
        "chars": c,
        "words": w,
        "lines": n,
        "mean_word_length": safe(F.aggregate("__w", F.lit(0), lambda s, x: s + F.length(x)), w),
        "symbol_ratio": safe(F.length("__t") - _without(F.col("__t"), r"[^\p{L}\p{N}\s]+"), c),
        "digit_ratio": safe(F.length("__t") - _without(F.col("__t"), r"\p{N}+"), c),
        "ended_share": safe(F.size(F.filter("__l", lambda x: x["ended"] > 0)), n),
        "common_share": safe(F.size(F.filter("__w", lambda x: x.isin(COMMON))), w),
        "distinct_share": safe(F.size(F.array_distinct("__w")), w),
        "repeat_share": safe(F.aggregate(F.zip_with(F.slice("__r", F.lit(1), m), F.slice("__r", F.lit(2), m), lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x), F.size("__r")),
        "words_a_line": safe(w, n),
        "chars_a_line": safe(c, n),
        "item_share": safe(weight(lambda x: x["marked"] > 0), c),
        "short_share": safe(weight(lambda x: (x["tokens"] <= 7) & (x["ended"] == 0)), c),
        "cell_share": safe(weight(lambda x: (x["gaps"] > 1) | (x["tabs"] > 0) | (x["pipes"] > 1) | (x["delimiters"] > 1)), c),
    }
    return once(d, F.struct(*[v.alias(k) for k, v in measured.items()]), {k: k for k in measured}).select(key, *measured)


ORDER = ["junk", "table", "list"]  # classes in the order their rules are tried; the rest is prose


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, FEATURES.index(self.feature)]
        return v > self.threshold if self.above else v <= self.threshold

    def sql(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}D"


def _covers(rule: list[Condition], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _edges(x: np.ndarray, most: int = 255) -> list[np.ndarray]:
    """Candidate thresholds of each feature: the middles between its values, thinned to ``most`` by quantiles."""
    out = []
    for v in x.T:
        u = np.unique(v)
        e = (u[1:] + u[:-1]) / 2
        if len(e) > most:
            q = np.unique(np.quantile(v, np.linspace(0, 1, most + 2)[1:-1]))
            e = np.unique(e[np.clip(np.searchsorted(e, q), 0, len(e) - 1)])
        out.append(np.round(e, 6))
    return out


def _grow(bins: np.ndarray, edges: list[np.ndarray], y: np.ndarray, w: np.ndarray, deepest: int = 6) -> list[Condition]:
    """Add the condition of the greatest information gain until hardly any other class is covered."""
    rule: list[Condition] = []
    live = np.ones(len(y), dtype=bool)
    while len(rule) < deepest:
        p0, n0 = w[y & live].sum(), w[~y & live].sum()
        if n0 <= 0.003 * p0 or p0 == 0:
            break
        best, gain = None, 1e-9
        for j, e in enumerate(edges):
            if not len(e):
                continue
            at = bins[live, j]
            p = np.cumsum(np.bincount(at, w[live] * y[live], len(e) + 1))[:-1]  # weight at or below each threshold
            n = np.cumsum(np.bincount(at, w[live] * ~y[live], len(e) + 1))[:-1]
            for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                ok = pp > 1e-9
                g = np.where(ok, pp * (np.log2(np.where(ok, pp, 1) / np.maximum(pp + nn, 1e-12)) - np.log2(p0 / (p0 + n0))), -1)
                k = int(np.argmax(g))
                if g[k] > gain:
                    best, gain = (j, k, above), g[k]
        if best is None:
            break
        j, k, above = best
        rule.append(Condition(FEATURES[j], above, float(edges[j][k])))
        live &= bins[:, j] > k if above else bins[:, j] <= k
    return rule


def _prune(rule: list[Condition], x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[list[Condition], float]:
    """The beginning of the rule with the best worth on lines it was not grown on, and its precision there."""

    def shares(r: list[Condition]) -> float:
        m = _covers(r, x)
        p, n = w[y & m].sum(), w[~y & m].sum()
        return p / (p + n) if p + n else 0.0

    best = max((rule[:k] for k in range(len(rule), 0, -1)), key=shares)
    return best, shares(best)


Rules = list[tuple[str, list[Condition]]]


def induce(x: np.ndarray, labels: np.ndarray, seed: int = 7, least: float = 0.7, most: int = 40) -> Rules:
    """The ordered rule list: per class, rules are grown on two thirds, pruned on one third, and
    kept while ``least`` of what they cover there is right. Classes weigh the same, however many lines they have."""
    rng = np.random.default_rng(seed)
    counts = {k: (labels == k).sum() for k in np.unique(labels)}
    w = np.array([1.0 / counts[k] for k in labels])
    edges = _edges(x)
    bins = np.stack([np.searchsorted(e, v, side="left") for e, v in zip(edges, x.T)], axis=1)
    rules: Rules = []
    left = np.ones(len(x), dtype=bool)
    for label in ORDER:
        while (labels[left] == label).any() and len(rules) < most:
            rows = np.flatnonzero(left)
            rng.shuffle(rows)
            cut = len(rows) * 2 // 3
            grow, prune = rows[:cut], rows[cut:]
            rule = _grow(bins[grow], edges, labels[grow] == label, w[grow]) if (labels[grow] == label).any() else []
            if not rule:
                break
            rule, right = _prune(rule, x[prune], labels[prune] == label, w[prune])
            if right < least:
                break
            rules.append((label, rule))
            left &= ~_covers(rule, x)
    return rules


def _named(rules: Rules, x: np.ndarray) -> np.ndarray:
    out, left = np.full(len(x), "prose", dtype=object), np.ones(len(x), dtype=bool)
    for label, rule in rules:
        m = _covers(rule, x) & left
        out[m] = label
        left &= ~m
    return out


def case_sql(rules: Rules, row: str = "") -> str:
    """The rule list as SQL over columns, or over the fields of ``row``."""
    if not rules:
        return "'prose'"
    arms = " ".join(f"when {' and '.join(row + c.sql() for c in rule)} then '{label}'" for label, rule in rules)
    return f"case {arms} else 'prose' end"


def _measured(spark: SparkSession, texts: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Statistics, labels, characters and text numbers of the lines of labelled texts, in order."""
    d = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, text string").repartition(8)
    d = d.select("i", F.posexplode(F.transform(lines_of(F.col("text")), lambda x: line_statistics(x))).alias("at", "x")).select("i", "at", "x.*")
    p = d.toPandas().sort_values(["i", "at"])  # bounded by the sample
    return p[FEATURES].to_numpy(float), np.array([texts[i][1] for i in p["i"]], dtype=object), p["chars"].to_numpy(float), p["i"].to_numpy()


def learned(spark: SparkSession, sample: int = SAMPLE, choice: int = CHOICE) -> Rules:
    """The best of LISTS rule lists from at most ``sample`` labelled texts, chosen on ``choice`` others.

    Both are measured by the same expressions that are applied to the corpus.
    """
    grown, chosen = labelled.parts(sample), labelled.parts(choice, seed=99)
    x, y, n, i = _measured(spark, grown + chosen)
    a = i < len(grown)

    def worth(rules: Rules) -> float:
        """Mean share of each class's characters that come out as it."""
        got = _named(rules, x[~a])
        return float(np.mean([np.average(got[y[~a] == k] == k, weights=n[~a][y[~a] == k]) for k in (*ORDER, "prose")]))

    return max((induce(x[a], y[a], seed) for seed in range(7, 7 + LISTS)), key=worth)


def _kinds(text: Column, rules: Rules) -> Column:
    """array<struct(k, n)> of the text's lines: kind and non-blank characters, by the rules' CASE."""
    used = {c.feature for _, rule in rules for c in rule}
    return F.transform(lines_of(text), lambda x: line_statistics(x, used))


def _with_kind(d: DataFrame, lines: str, rules: Rules) -> DataFrame:
    """Add ``kind`` from the line statistics: the kind with more than half of the characters, else 'prose'; null without any."""
    d = d.withColumn("__k", F.expr(f"transform({lines}, x -> named_struct('k', {case_sql(rules, 'x.')}, 'n', x.chars))"))
    held = lambda k: F.aggregate(F.filter("__k", lambda x: x["k"] == k) if k else F.col("__k"), F.lit(0).cast("bigint"), lambda s, x: s + x["n"])
    sums = F.struct(held(None).alias("chars"), *[held(k).alias(k) for k in ORDER])

    def most(s: Column) -> Column:
        out = F.when(s["chars"] == 0, None)
        for k in ORDER:
            out = out.when(s[k] * 2 > s["chars"], k)
        return out.otherwise("prose")

    return once(d, F.struct(let(sums, most)), {"kind": "kind"}).drop("__k", lines)


def classify(df: DataFrame, rules: Rules, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics with ``kind``: 'prose', 'list', 'table', 'junk', null for a text without characters."""
    d = df.select(F.col(key), F.col(text).alias("__text"))
    kinds = _with_kind(d.select(key, _kinds(F.coalesce("__text", F.lit("")), rules).alias("__x"), "__text"), "__x", rules)
    s = statistics(kinds.select(F.struct(F.col(key).alias("key"), "kind").alias("both"), "__text"), "both", "__text")
    return s.select(F.col("both.key").alias(key), *[c for c in s.columns if c != "both"], "both.kind")


def found(df: DataFrame) -> DataFrame:
    rules = learned(df.sparkSession)
    d = df.select("doc_id", _kinds(F.coalesce("text", F.lit("")), rules).alias("__x"))
    return _with_kind(d, "__x", rules).filter("kind in ('list', 'table', 'junk')").select("doc_id", "kind")
