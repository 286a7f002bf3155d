"""Problem 1: free-entered values to the closest entry of a reference list, in SQL.

Exact names, unique name beginnings (cut-off entries) and phrases that contain a whole name
are equality joins. Misspellings go through a partition-based pigeonhole join: a reference
string of tolerance k is cut into k + 1 segments; a string within k edits must contain one
of them unchanged, at a place shifted by at most k. Substrings of the value at those places
join by equality, and the built-in levenshtein verifies the candidates. What no join reaches
comes out through an anti-join with term -1.

The reference list may be of any size: nothing is hinted or collected, so it is broadcast
only when its measured size allows. Values are reduced to distinct ones before any join.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from ..session import cut_lineage

# Dose units, forms, frequencies and remarks that do not change a term's meaning.
_UNITS = "mg/ml|mcg/ml|mg|mcg|ug|g|gm|kg|ml|l|meq|units?|iu|mmol|%|percent"
_FORMS = (
    "tablets?|tabs?|capsules?|caps?|oral soln|oral solution|oral susp|oral suspension|solution|soln|suspension|susp|syrup|chewable|"
    "injection|inj|patch|drops?|spray|inhaler|nebulizer|cream|xr|er|sr|cr|dr|ir|la|xl|odt|hcl|hydrochloride|sodium salt|"
    "extended release|delayed release|generic|brand|24 ?hr|12 ?hr|oral|po|iv|im|sl|pr"
)
_OFTEN = (
    "once a day|twice a day|three times a day|twice daily|once daily|every morning|every evening|every night|every other day|every day|"
    "at bedtime|at night|in the morning|nightly|daily|weekly|monthly|bid|tid|qid|qd|qod|qhs|qam|qpm|hs|prn|as needed|q ?\\d+ ?h(?:rs?|ours?)?|"
    "\\d+ ?x ?(?:/|per|a) ?(?:day|week)|\\d-\\d-\\d(?:-\\d)?"
)
_LEADS = (
    "history of|hx of|hx:?|cont\\\\.?|continue[sd]?|h/o|known|s/p|status post|past medical history of|pmh of|pmh|rx:?|taking|takes|takes:?|on|current:?|currently on|"
    "dx:?|diagnosis:?|diagnosed with|probable|possible|suspected|chronic hx of|tablets?|tabs?|capsules?|caps?"
)
_TAILS = (
    "on treatment|stable|followed|refill(?:ed)?|resolved|controlled|well controlled|unchanged|in remission|mild|moderate|severe|"
    "(?:dx|diagnosed)(?: in)? \\d{4}|since (?:age )?\\d+|x ?\\d+ ?(?:yrs?|years?|months?|mos?)|for \\d+ (?:yrs?|years?|months?)|\\d+ (?:yrs?|years?) ago|per (?:pt|patient|chart)"
)

# Each step: (pattern, replacement), applied in order to the lower-cased value.
_STEPS = [
    ("[\\u00ae\\u2122\\u00a9]", ""),
    ("\\\\[[^\\\\]]*\\\\]", " "),
    ("^\\\\s*(?:[*\\u2022+>-]+|\\\\(?\\\\d{1,2}[.)])\\\\s+", ""),
    # Each match begins where the one before ended, so any number of leading words goes.
    (f"\\\\G\\\\s*(?:{_LEADS})\\\\s+", ""),
    (f"(?<![a-z0-9])\\\\d[\\\\d,.]*\\\\s*(?:{_UNITS})(?![a-z])", " "),
    (f"(?<![a-z0-9])(?:{_OFTEN})(?![a-z0-9])", " "),
    (f"(?<=[a-z.)] ?)(?:[\\\\s,-]+)(?:{_FORMS})(?![a-z])", " "),
    (f"[\\\\s,;(-]+(?:{_TAILS})\\\\)?\\\\s*(?=$|[,;)])", " "),
]


def _cleaned(column: str, again: bool = True) -> str:
    """SQL of the value without doses, forms, frequencies and remarks."""
    x = f"lower(translate({column}, '\\t\\n\\r\\u00a0', '    '))"
    for pattern, to in _STEPS + (_STEPS[-2:] if again else []):
        pattern = pattern.replace("\\\\", "\\").replace("'", "\\'")
        x = f"regexp_replace({x}, r'{pattern}', '{to}')"
    return x


def _plain(x: str) -> str:
    """Letters and digits of any script, single blanks."""
    return f"trim(regexp_replace(regexp_replace({x}, r\"[^\\p{{L}}\\p{{N}}]+\", ' '), ' +', ' '))"


def _bare(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def match_terms(values: DataFrame, terms: DataFrame) -> DataFrame:
    """(source_table, row_id, term_id) of every value that is neither null nor blank.

    ``values``: source_table, row_id, kind, value. ``terms``: term_id, kind, canonical_name,
    aliases ('|'-joined, may be null or empty). Other columns are ignored.

    The best match wins in the order: exact name, spelling within the tolerance (fewest
    edits first), unique beginning of a name, whole name inside the value. Among equals, the
    same first letter, then the lowest term_id. A beginning shared by several terms counts
    where it begins just one canonical name. Digits must agree where entries differ in
    their digits alone. Tolerances: 0 below 5 characters, 1 below 7, 2 below 12, else 3. No match gives -1.
    Repeated rows each come out; an empty list of terms gives -1 for every value.
    """
    spark = values.sparkSession

    def sql(text: str, **frames: DataFrame) -> DataFrame:
        """``$name`` stands for a frame; braces are plain characters."""
        return spark.sql(re.sub(r"\$([a-z])\b", r"{\1}", text.replace("{", "{{").replace("}", "}}")), **frames)

    given = sql("select source_table, row_id, kind, value from $v where trim(translate(value, '\\t\\n\\r\\u00a0', '    ')) <> ''", v=values)
    refs = sql(
        f"""
        select term_id, kind, ref, main, length(ref) as n,
               count(*) over (partition by kind, regexp_replace(ref, '[0-9]', '')) > 1 as numbered,
               case when length(ref) < 5 then 0 when length(ref) < 7 then 1 when length(ref) < 12 then 2 else 3 end as k
        from (select term_id, kind, ref, max(main) as main
              from (select term_id, kind, {_plain('lower(name)')} as ref, pos = 0 as main
                    from $t lateral view posexplode(split(concat_ws('|', canonical_name, aliases), '[|]')) as pos, name)
              where ref <> '' group by term_id, kind, ref)
        """,
        t=terms,
    )
    # Candidate readings of a distinct value: without the bracketed part, the bracketed part
    # itself, and the parts around a comma in reverse order.
    readings = sql(
        f"""
        select distinct kind, value, rank, c, length(c) as n from (
          select kind, value, rank, {_plain('text')} as c from (
            select kind, value, pos as rank, text from (
              select kind, value, {_cleaned('value')} as x, lower(value) as w from (select distinct kind, value from $g))
            lateral view posexplode(array(
              regexp_replace(x, r'\\([^)]*\\)?', ' '),
              regexp_extract(x, r'\\(([^)]*)', 1),
              case when x like '%,%' then concat(regexp_extract(x, ',([^,]*)', 1), ' ', regexp_extract(x, '^([^,]*),', 1)) else '' end,
              w)) as pos, text))
        where c <> ''
        """,
        g=given,
    )
    # Both are read by several joins: written once to the shared folder, they keep the plan small.
    refs, readings = cut_lineage(refs), cut_lineage(readings)
    exact = sql("select r.kind, value, term_id, 0 as tier, rank as cost, r.c, ref from $r r join $t t on r.kind = t.kind and r.c = t.ref", r=readings, t=refs)
    open_ = sql("select r.* from $r r left anti join $e e on r.kind = e.kind and r.value = e.value", r=readings, e=exact)
    open_ = cut_lineage(open_)

    segments = sql(
        """
        select kind, term_id, ref, numbered, n, k, i, cast(start as int) as start, cast(least(n + 1, following) - start as int) as len, substring(ref, cast(start as int), cast(following - start as int)) as seg
        from (select *, i * n div (k + 1) + 1 as start, (i + 1) * n div (k + 1) + 1 as following
              from $t lateral view explode(sequence(0, k)) as i)
        where k > 0
        """,
        t=refs,
    )
    layout = sql("select distinct kind, n, k, i, start, len from $s", s=segments)
    probes = sql(
        """
        select distinct kind, c, n, i, substring(c, p, len) as seg from (
          select o.kind, o.c, l.n, l.i, l.len, explode(sequence(greatest(1, l.start - l.k), greatest(1, l.start + l.k))) as p
          from (select distinct kind, c, explode(sequence(greatest(1, n - 3), n + 3)) as size from $o where n >= 4) o
          join $l l on o.kind = l.kind and o.size = l.n
          where abs(length(o.c) - l.n) <= l.k)
        where p + len - 1 <= length(c)
        """,
        o=open_,
        l=layout,
    )
    close = sql(
        f"""
        select kind, c, term_id, ref, levenshtein(c, ref) as d from (
          select distinct p.kind, p.c, s.term_id, s.ref, s.k, s.numbered
          from $p p join $s s on p.kind = s.kind and p.n = s.n and p.i = s.i and p.seg = s.seg)
        where levenshtein(c, ref) <= k and ({_bare('c')} = {_bare('ref')} or not numbered and levenshtein(c, ref) = 1)
        """,
        p=probes,
        s=segments,
    )
    fuzzy = sql("select o.kind, o.value, term_id, 1 as tier, d * 10 + rank as cost, o.c, ref from $o o join $c c on o.kind = c.kind and o.c = c.c", o=open_, c=close)

    beginnings = sql(
        """
        select kind, b, coalesce(min(term_id) filter (where main), min(term_id)) as term_id, min(ref) as ref from (
          select kind, term_id, ref, main, substring(ref, 1, m) as b from $t lateral view explode(sequence(4, greatest(4, n - 1))) as m where n > 4)
        group by kind, b having count(distinct term_id) = 1 or count(distinct term_id) filter (where main) = 1
        """,
        t=refs,
    )
    begun = sql("select o.kind, value, term_id, 2 as tier, rank as cost, o.c, ref from $o o join $b b on o.kind = b.kind and o.c = b.b", o=open_, b=beginnings)
    # Phrases of as many words as some entry of the kind has, whatever that number is.
    phrases = sql(
        """
        select kind, value, rank, explode(array_distinct(transform(sequence(1, size(w) - m + 1), a -> array_join(slice(w, a, m), ' ')))) as c
        from (select o.kind, o.value, o.rank, split(o.c, ' ') as w, l.m from $o o
              join (select distinct kind, size(split(ref, ' ')) as m from $t where n >= 5) l on o.kind = l.kind)
        where size(w) >= m
        """,
        o=open_,
        t=refs,
    )
    inside = sql("select p.kind, value, term_id, 3 as tier, 100 - n + rank as cost, p.c, ref from $p p join $t t on p.kind = t.kind and p.c = t.ref where n >= 5", p=phrases, t=refs)
    best = sql(
        """
        select kind, value, min_by(term_id, struct(tier, cost, case when left(c, 1) = left(ref, 1) then 0 else 1 end, term_id)) as term_id
        from (select * from $e union all select * from $f union all select * from $b union all select * from $i)
        group by kind, value
        """,
        e=exact,
        f=fuzzy,
        b=begun,
        i=inside,
    )
    best = cut_lineage(best)
    matched = sql("select g.source_table, g.row_id, b.term_id from $g g join $b b on g.kind = b.kind and g.value = b.value", g=given, b=best)
    missing = sql("select g.source_table, g.row_id, cast(-1 as bigint) as term_id from $g g left anti join $b b on g.kind = b.kind and g.value = b.value", g=given, b=best)
    return matched.unionByName(missing)


def clinical_values(medications: DataFrame, comorbidities: DataFrame) -> DataFrame:
    return medications.selectExpr("'medications' as source_table", "medication_row_id as row_id", "'medication' as kind", "name as value").unionByName(
        comorbidities.selectExpr("'comorbidities' as source_table", "comorbidity_row_id as row_id", "'condition' as kind", "condition_name as value")
    )
