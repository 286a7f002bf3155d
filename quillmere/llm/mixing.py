"""Problem 8: sources mixed to target shares of the tokens by entropy balancing.

Every document of a usable source gets a rate, the expected number of its copies. The rates
are those nearest (in relative entropy) to one common rate for all documents that give each
source its tokens: exponentially tilted by length, r = min(cap, base * exp(lambda * x)). The
dual is convex with one lambda per source. A rate depends on source and length alone, so all
documents are reduced once to counts by source and length; each Newton step is one
distributed aggregation over those. Its sums are decimals, which don't depend on the order of
the rows, so the mix is the same for any partitioning. Rates become whole copies by hashing, with a
per-source shift chosen from a histogram so the tokens meet the target within one document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

STEPS, TOLERANCE, BINS = 40, 1e-9, 4096
STEEPEST = 60.0  # exponent of the tilt beyond which every document is at its cap


def sizes(sized: DataFrame) -> DataFrame:
    """(source, tokens, n): how many documents of each length a source has."""
    return cut_lineage(sized.filter("tokens > 0").groupBy("source", "tokens").agg(F.count("*").alias("n")))


def plan(counted: DataFrame, targets: DataFrame, total: float | None = None) -> list[dict]:
    """One entry per source of ``targets``: goal share and goal tokens.

    Sources without a positive share, repeats or tokens can't take part; the shares of the
    others are scaled to 1. ``total`` defaults to the largest mix in which every one of them
    reaches its share within its repeats.
    """
    size = counted.groupBy("source").agg(F.sum(F.col("tokens") * F.col("n")).alias("tokens"), F.max("tokens").alias("longest"))
    listed = targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    rows = [r.asDict() for r in listed.join(size, "source", "left").orderBy("source").collect()]  # one row a listed source
    usable = [r for r in rows if r["source"] is not None and (r["target_share"] or 0) > 0 and (r["max_repeats"] or 0) > 0 and (r["tokens"] or 0) > 0]
    whole = sum(r["target_share"] for r in usable)
    for r in usable:
        r["goal_share"] = r["target_share"] / whole
    if usable:
        room = min(r["max_repeats"] * r["tokens"] / r["goal_share"] for r in usable)
        total = room if total is None else min(total, room)
    for r in rows:
        r.setdefault("goal_share", 0.0)
        r["goal"] = r["goal_share"] * (total or 0)
    return rows


def _of(values: dict[str, float], source: Column) -> Column:
    """The source's value: one constant map, whatever the number of sources."""
    return F.try_element_at(F.create_map(*[F.lit(x) for k, v in values.items() for x in (k, float(v))]), source)


def _rate(entries: list[dict], lambdas: dict[str, float], base: float) -> Column:
    s = F.col("source")
    scaled = F.col("tokens") / _of({e["source"]: e["longest"] for e in entries}, s)
    tilted = base * F.exp(F.least(_of(lambdas, s) * scaled, F.lit(STEEPEST)))
    return F.least(tilted, _of({e["source"]: e["max_repeats"] for e in entries}, s))


def solve(counted: DataFrame, entries: list[dict]) -> tuple[dict[str, float], float]:
    """The lambdas by safeguarded Newton iterations, and the common base rate."""
    base = sum(e["goal"] for e in entries) / sum(e["tokens"] for e in entries)
    full = [e["source"] for e in entries if e["goal"] >= e["max_repeats"] * e["tokens"] * (1 - TOLERANCE)]
    # A source that needs all its repeats has no finite lambda: every document is at the cap.
    lam = {e["source"]: STEEPEST * e["longest"] if e["source"] in full else 0.0 for e in entries}
    low = {e["source"]: -math.inf for e in entries}
    high = {e["source"]: math.inf for e in entries}
    by = {e["source"]: e for e in entries}
    exact = lambda x: F.sum(x.cast("decimal(38,9)"))
    for _ in range(STEPS):
        r, x, n = _rate(entries, lam, base), F.col("tokens").cast("double"), F.col("n")
        cap, scale = _of({s: e["max_repeats"] for s, e in by.items()}, F.col("source")), _of({s: e["longest"] for s, e in by.items()}, F.col("source"))
        got = counted.groupBy("source").agg(exact(r * x * n).alias("f"), exact(F.when(r < cap, r * x * x * n / scale).otherwise(0.0)).alias("d")).collect()  # one row a source
        worst = 0.0
        for g in got:
            s = g["source"]
            if s in full:
                continue
            gap, slope = float(g["f"]) - by[s]["goal"], float(g["d"])
            worst = max(worst, abs(gap) / by[s]["goal"])
            if abs(gap) <= TOLERANCE * by[s]["goal"]:
                continue
            low[s], high[s] = (lam[s], high[s]) if gap < 0 else (low[s], lam[s])
            step = lam[s] - gap / slope if slope > 0 else math.nan
            step = min(max(step, lam[s] - 8), lam[s] + 8) if step == step else step
            if not low[s] < step < high[s]:
                step = (low[s] + high[s]) / 2 if math.isfinite(low[s]) and math.isfinite(high[s]) else lam[s] + (4 if gap < 0 else -4)
            lam[s] = step
        if worst <= 1e-6:
            break
    return lam, base


def mix(sized: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """(doc_id, source, tokens, rate, copies) of every document with a copy in the mix.

    ``sized``: doc_id, source, tokens. Documents of unlisted or null sources, and empty ones,
    have no copies. ``copies`` never exceeds the source's max_repeats. Which documents get the
    extra copy depends on a hash of doc_id alone, so a rerun gives the same mix.
    """
    sized = cut_lineage(sized.select("doc_id", "source", "tokens"))
    counted = sizes(sized)
    entries = [e for e in plan(counted, targets, total) if e["goal"] > 0]
    if not entries:
        return sized.filter("false").select("doc_id", "source", "tokens", F.lit(0.0).alias("rate"), F.lit(0).alias("copies"))
    listed = F.col("source").isin([e["source"] for e in entries])
    lam, base = solve(counted.filter(listed), entries)
    u = (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))).alias("u")
    used = sized.filter(listed & (F.col("tokens") > 0))
    d = cut_lineage(used.select("doc_id", "source", "tokens", _rate(entries, lam, base).alias("rate"), u).withColumn("edge", F.col("u") - (F.col("rate") - F.floor("rate"))))
    s = F.col("source")
    cap = _of({e["source"]: e["max_repeats"] for e in entries}, s)
    # Documents with edge < shift get one more copy: the shift that meets the goal, refined bin by bin.
    lo, hi = {e["source"]: -1.0 for e in entries}, {e["source"]: 1.0 for e in entries}
    floors = counted.filter(listed).groupBy("source").agg(F.sum(F.floor(_rate(entries, lam, base)) * F.col("tokens") * F.col("n")).alias("t"))
    below = {r["source"]: float(r["t"]) for r in floors.collect()}  # one row a source
    for _ in range(3):
        width = {k: (hi[k] - lo[k]) / BINS for k in lo}
        inside = (F.col("edge") >= _of(lo, s)) & (F.col("edge") < _of(hi, s)) & (F.floor("rate") < cap)
        bins = d.filter(inside).groupBy("source", F.floor((F.col("edge") - _of(lo, s)) / _of(width, s)).alias("bin")).agg(F.sum("tokens").alias("t")).collect()  # at most BINS rows a source
        for e in entries:
            k, at = e["source"], below[e["source"]]
            last = None
            for b, t in sorted((r["bin"], r["t"]) for r in bins if r["source"] == k):
                if at + t > e["goal"]:
                    last = b
                    break
                at += t
            if last is None:
                last = BINS
            below[k], lo[k], hi[k] = at, lo[k] + last * width[k], lo[k] + min(last + 1, BINS) * width[k]
            if hi[k] <= lo[k]:
                hi[k] = lo[k]
    extra = ((F.col("edge") < _of(lo, s)) & (F.floor("rate") < cap)).cast("int")
    out = d.withColumn("copies", (F.floor("rate") + extra).cast("int"))
    return out.filter("copies > 0").select("doc_id", "source", "tokens", "rate", "copies")


def shares(mixed: DataFrame, sized: DataFrame, targets: DataFrame) -> DataFrame:
    """What each listed source really contributes: shares, tokens, documents, copies; absent sources with 0."""
    have = sized.groupBy("source").agg(F.sum("tokens").alias("source_tokens"))
    got = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"), F.count("*").alias("docs"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"))
    t = targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    r = t.join(have, "source", "left").join(got, "source", "left")
    total = got.agg(F.sum("mixed_tokens").alias("all_tokens"))
    r = r.join(F.broadcast(total))  # a single row
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    actual = F.coalesce(F.col("mixed_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share")
    return r.select("source", "target_share", "max_repeats", zero("source_tokens"), zero("mixed_tokens"), actual, zero("docs"), zero("copies"), zero("most_copies"))
