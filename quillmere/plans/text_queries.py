"""Queries over annotation, report and document text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars
from ..functions import text as tx
from ..operators import nested, sections, statistics
from ..sources import files
from .registry import Registry

R = Registry()

_LABEL_SQL = "nullif(concat_ws('|', " + ", ".join("case when " + " or ".join(f"contains(lower(text), '{k}')" for k in keys) + f" then '{name}' end" for name, keys in tx.LABELS) + "), '')"
_TAG_SQL = "concat_ws('|', " + ", ".join("case when " + " or ".join(f"contains(lower(text), '{k}')" for k in keys) + f" then '{name}' end" for name, keys in tx.SIDES + [(r, [r]) for r in tx.REGIONS]) + ")"
_FLAG_SQL = ", ".join(f"cast(regexp_matches(lower(coalesce(raw_description, '')), '{p}') as integer) as {n}" for n, p in tx.FLAGS)


@R.query(f"""select label, count(*) as n from (select unnest(string_split(coalesce({_LABEL_SQL}, 'other'), '|')) as label
             from annotations where trim(text) <> '') group by label""")
def label_histogram(t):
    d = t.annotations.filter(F.trim("text") != "").select(F.explode(F.split(tx.annotation_labels(F.col("text")), r"\|")).alias("label"))
    return d.groupBy("label").agg(F.count("*").alias("n"))


@R.query(f"select annotation_id, {_TAG_SQL} as tags from annotations where text is not null")
def region_tags(t):
    return t.annotations.filter("text is not null").select("annotation_id", tx.region_tags(F.col("text")).alias("tags"))


@R.query(f"select epileptiform_row_id, {_FLAG_SQL} from eeg_epileptiform")
def epileptiform_flags(t):
    return t.eeg_epileptiform.select("epileptiform_row_id", *[c.alias(n) for n, c in tx.flags(F.col("raw_description")).items()])


_MORPH, _PLACE = ["is_spike", "is_sharp_wave", "is_spike_wave", "is_polyspike"], ["is_generalized", "is_focal", "is_bilateral", "is_left"]


@R.query(f"""with f as (select {_FLAG_SQL} from eeg_epileptiform),
             a as (select *, row_number() over () as i from f)
             select r.flag as row_flag, c.flag as column_flag, count(*) as n
             from (unpivot (select i, {', '.join(_MORPH)} from a) on {', '.join(_MORPH)} into name flag value v) r
             join (unpivot (select i, {', '.join(_PLACE)} from a) on {', '.join(_PLACE)} into name flag value v) c on r.i = c.i
             where r.v = 1 and c.v = 1 group by 1, 2""")
def cooccurrence_grid(t):
    d = t.eeg_epileptiform.select(*[c.alias(n) for n, c in tx.flags(F.col("raw_description")).items()])
    return statistics.cooccurrence(d, _MORPH, _PLACE)


_DOC_RULES = [
    ("background", ["posterior dominant rhythm", "background", "amplitude"], 3),
    ("seizure", ["seizure", "event"], 2),
    ("medication", ["mg", "dose"], 2),
    ("history", ["history", "past"], 3),
]


def _score_sql(column: str) -> str:
    parts = [f"({' + '.join(f"cast(regexp_matches({column}, '(?i){p}') as integer)" for p in ps)}) * {w}" for _, ps, w in _DOC_RULES]
    best = f"greatest({', '.join(parts)})"
    arms = " ".join(f"when {x} = {best} then '{n}'" for x, (n, _, _) in zip(parts, _DOC_RULES))
    return f"{best} as score, case when {best} = 0 then null {arms} end as name"


@R.query(f"select doc_id, {_score_sql('text')} from documents where text is not null")
def page_classifier(t):
    c = tx.weighted_class(F.col("text"), _DOC_RULES)
    return t.documents.filter("text is not null").select("doc_id", c.alias("c")).select("doc_id", "c.score", "c.name")


_PAGES = """pages as (select study_id, page_start, doc_id, text, case when regexp_matches(text, '(?i)history') then 'history' when regexp_matches(text, '(?i)event button') then 'events' end as kind,
             length(text) as chars from documents where study_id is not null and page_start is not null and text is not null)"""
_FILLED = """filled as (select *, coalesce(last_value(kind ignore nulls) over (partition by study_id order by page_start, doc_id rows between 12 preceding and current row), 'unknown') as k from pages),
             runs as (select *, sum(case when k is not distinct from lag_k and rn > 1 then 0 else 1 end) over (partition by study_id order by page_start, doc_id) as island
                      from (select *, lag(k) over w as lag_k, row_number() over w as rn from filled window w as (partition by study_id order by page_start, doc_id)))"""


def _pages(t):
    c = F.col("text")
    kind = F.when(c.rlike("(?i)history"), "history").when(c.rlike("(?i)event button"), "events")
    return t.documents.filter("study_id is not null and page_start is not null and text is not null").select("study_id", "page_start", "doc_id", "text", kind.alias("kind"), F.length("text").alias("chars"))


@R.query(f"""with {_PAGES}, {_FILLED} select study_id, cast(island as bigint) as island, k as kind, min(page_start) as page_start, max(page_start) as page_end, count(*) as n_pages,
             cast(sum(chars) as bigint) as total_chars, max(case when kind is null then 0 else 3 end) as max_score,
             case when max(case when kind is null then 0 else 3 end) >= 3 then 'medium' else 'low' end as confidence from runs group by 1, 2, 3""")
def segment_sections(t):
    d = _pages(t).withColumn("score", F.when(F.col("kind").isNull(), 0).otherwise(3))
    return sections.sections(d, "study_id", ["page_start", "doc_id"], "kind", "page_start", "chars", "score")


# The reference's patterns know all white space and letters and let a dot meet every character but a line feed.
_PAGE_FLAGS = "idU"


def _page_sql() -> str:
    """SQL columns score and name of the page rules over ``text``."""
    hits = lambda ps: " + ".join("cast(regexp_matches(text, '(?i)" + p.replace(r"\s", r"[\s\pZ\x0b\x85]").replace(r"\d", r"\p{Nd}").replace(r"\w", r"[\pL\pM\p{Nd}\p{Pc}]") + "') as integer)" for p in ps)
    parts = [f"({hits(ps)}) * {w}" for _, ps, w in sections.PAGE_RULES]
    names = "[" + ", ".join(f"'{n}'" for n, _, _ in sections.PAGE_RULES) + "]"
    return f"list_max([{', '.join(parts)}]) as score, case when list_max([{', '.join(parts)}]) > 0 then {names}[list_position([{', '.join(parts)}], list_max([{', '.join(parts)}]))] end as name"


@R.query(f"select doc_id, {_page_sql()} from documents where text is not null")
def page_types(t):
    """The ten page rules on every page."""
    c = tx.weighted_class(F.col("text"), sections.PAGE_RULES, _PAGE_FLAGS)
    return t.documents.filter("text is not null").select("doc_id", c.alias("c")).select("doc_id", "c.score", "c.name")


@R.query(f"""with pages as (select study_id, page_start, doc_id, name as kind, score, length(text) as chars
             from (select *, {_page_sql()} from documents where study_id is not null and page_start is not null and text is not null)), {_FILLED}
             select study_id, cast(island as bigint) as island, k as kind, min(page_start) as page_start, max(page_start) as page_end, count(*) as n_pages, cast(sum(chars) as bigint) as total_chars,
             max(score) as max_score, case when max(score) >= 6 then 'high' when max(score) >= 3 then 'medium' else 'low' end as confidence from runs group by 1, 2, 3""")
def packet_sections(t):
    """Packets segmented by the ten page rules, with their scores."""
    c = tx.weighted_class(F.col("text"), sections.PAGE_RULES, _PAGE_FLAGS)
    pages = t.documents.filter("study_id is not null and page_start is not null and text is not null")
    d = pages.select("study_id", "page_start", "doc_id", F.length("text").alias("chars"), c.alias("c")).select("study_id", "page_start", "doc_id", "chars", F.col("c.name").alias("kind"), "c.score")
    return sections.sections(d, "study_id", ["page_start", "doc_id"], "kind", "page_start", "chars", "score")


@R.query(f"""with {_PAGES}, spans as (select study_id, min(page_start) as page_start, max(page_start) as page_end from pages where kind is not null group by 1),
             n as (select s.study_id, s.page_start, s.page_end, p.page_start as p, p.doc_id, p.text, cast((row_number() over (partition by s.study_id order by p.page_start, p.doc_id) - 1) // 200 as integer) as part
                   from spans s join pages p on s.study_id = p.study_id and p.page_start between s.page_start and s.page_end)
             select study_id, page_start, page_end, part, string_agg(text, chr(12) order by p, doc_id) as section_text from n group by 1, 2, 3, 4""")
def section_text(t):
    """The pages of a range as text, in parts of 200 pages."""
    p = _pages(t)
    spans = p.filter("kind is not null").groupBy("study_id").agg(F.min("page_start").alias("page_start"), F.max("page_start").alias("page_end"))
    return sections.text_of_range(spans, p, "study_id", "page_start", "text", "doc_id")


@R.query(r"""select impression_row_id, nullif(trim(regexp_extract(raw_text, '(?is)because of(.*?)(?:over|[.]|\z)', 1), concat(' ', chr(9), chr(10), chr(13), chr(12))), '') as reason
             from technologist_impression where raw_text is not null""")
def extract_between_fields(t):
    return t.technologist_impression.filter("raw_text is not null").select("impression_row_id", tx.between(F.col("raw_text"), "because of", ["over", "[.]"]).alias("reason"))


@R.query(r"""select annotation_id, unnest(regexp_extract_all(text, '[0-9]{3}-[0-9]{3}-[0-9]{4}')) as phone from annotations""")
def extract_all_events(t):
    return t.annotations.select("annotation_id", F.explode(F.regexp_extract_all("text", F.lit("[0-9]{3}-[0-9]{3}-[0-9]{4}"), F.lit(0))).alias("phone"))


@R.query(r"""select count(*) as rows, cast(sum(len(regexp_extract_all(text, '[0-9]+'))) as bigint) as numbers from annotations where text is not null""")
def pattern_counts(t):
    return t.annotations.filter("text is not null").agg(F.count("*").alias("rows"), F.sum(F.regexp_count("text", F.lit("[0-9]+"))).cast("bigint").alias("numbers"))


@R.query(r"""with l as (select doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))) as no, string_split(text, chr(10)) as a from documents where text is not null),
             m as (select doc_id, no - 1 as line_no, a[no] as line, regexp_matches(a[no], '^(HISTORY|ASSESSMENT AND PLAN)') as opens from l),
             g as (select *, sum(case when opens then 1 else 0 end) over (partition by doc_id order by line_no) as record from m)
             select doc_id, cast(record as bigint) as record, cast(min(line_no) as integer) as line_no, arg_min(regexp_extract(line, '([0-9]+) mg', 1), line_no) filter (where regexp_matches(line, '[0-9]+ mg')) as dose
             from g where record > 0 group by 1, 2""")
def line_state_machine(t):
    lines = t.documents.filter("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    c = F.col("line")
    return sections.attach_state(lines, "doc_id", "line_no", c.rlike("^(HISTORY|ASSESSMENT AND PLAN)"), {"dose": F.nullif(F.regexp_extract(c, "([0-9]+) mg", 1), F.lit(""))})


@R.query(r"""select annotation_id, regexp_replace(regexp_replace(text, '[0-9]{3}-[0-9]{3}-[0-9]{4}', '[phone]', 'g'), '[0-9]{8,}', '[id]', 'g') as masked from annotations where text is not null""")
def scrub_numbers(t):
    c = F.regexp_replace(F.regexp_replace("text", "[0-9]{3}-[0-9]{3}-[0-9]{4}", "[phone]"), "[0-9]{8,}", "[id]")
    return t.annotations.filter("text is not null").select("annotation_id", c.alias("masked"))


# SQL patterns have no look-around: the character beside a match is matched and put back, twice, as neighbours may share one.
_PHONE_SQL = r"(^|[^A-Za-z0-9_])(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]\d{3}[-.\s]\d{4}\b"


@R.query(rf"""select annotation_id, regexp_replace(regexp_replace(regexp_replace(text, '{_PHONE_SQL}', '\1[PHONE]', 'g'), '{_PHONE_SQL}', '\1[PHONE]', 'g'),
             '(?i)\b\d{{1,5}}\s+[A-Z][a-zA-Z]+(?:\s+[A-Z][a-zA-Z]+){{0,3}}\s+(?:St|Ave|Blvd|Dr|Rd|Ln|Ct|Way|Pl|Cir|Pkwy)\b[.]?', '[ADDRESS]', 'g') as masked from annotations where text is not null""")
def scrub_contacts(t):
    """Phones and street addresses masked."""
    return t.annotations.filter("text is not null").select("annotation_id", tx.scrub_contacts(F.col("text")).alias("masked"))


@R.query()
def sanitised_log(t):
    return t.studies.select("study_row_id", tx.sanitise_log(F.concat_ws(" ", "study_id", "tech_comments", "source_pdf")).alias("line"))


@R.query(r"""with w as (select annotation_id, unnest(string_split_regex(text, '[^A-Za-z]+')) as tok from annotations where text is not null),
             names as (select distinct lower(n) as n from (select last_name as n from recordings union all select first_name from recordings) where length(n) >= 4 and regexp_matches(n, '^[A-Za-z]+$'))
             select annotation_id, count(*) as n_names from w join names on lower(tok) = n group by 1""")
def scrub_names_dictionary(t):
    """Dictionary words per annotation: tokens join the names by equality, no alternation of thousands."""
    r = t.recordings
    known = r.select(F.explode(F.array("last_name", "first_name")).alias("n")).filter((F.length("n") >= 4) & F.col("n").rlike("^[A-Za-z]+$")).select(F.lower("n").alias("n")).distinct()
    tokens = t.annotations.filter("text is not null").select("annotation_id", F.explode(F.split("text", "[^A-Za-z]+")).alias("tok")).select("annotation_id", F.lower("tok").alias("n"))
    return tokens.join(known, "n").groupBy("annotation_id").agg(F.count("*").alias("n_names"))


_AMBIGUOUS_SQL = ", ".join(f"'{n}'" for n in ["nan", *tx.AMBIGUOUS_NAMES])


@R.query(rf"""with d as (select distinct regexp_replace(lower(n), '^[^\pL\pN_]+|[^\pL\pN_]+$', '', 'g') as n from (select last_name as n from recordings union all select first_name from recordings)),
             names as (select n, regexp_extract(n, '[\pL\pN_]+') as w from d where length(n) >= 4 and n not in ({_AMBIGUOUS_SQL})),
             words as (select annotation_id, unnest(list_distinct(regexp_extract_all(lower(text), '[\pL\pN_]+'))) as w from annotations where text is not null),
             hits as (select annotation_id, '(?i)(^|[^\pL\pN_])(?:' || string_agg(regexp_escape(n), '|' order by length(n) desc, n) || ')($|[^\pL\pN_])' as p from words join names using (w) group by 1)
             select annotation_id, case when p is null then text else regexp_replace(regexp_replace(text, p, '\1[NAME]\2', 'g'), p, '\1[NAME]\2', 'g') end as scrubbed
             from annotations left join hits using (annotation_id) where text is not null""")
def scrub_names_text(t):
    """Every annotation with the dictionary's names replaced: words meet the names' first words by equality, each row replaces its own hits."""
    a = t.annotations.filter("text is not null").select("annotation_id", "text")
    known = t.recordings.select(F.explode(F.array("last_name", "first_name")).alias("n")).select(tx.dictionary_name(F.col("n")).alias("n")).filter("n is not null").distinct()
    known = known.select("n", F.regexp_extract("n", r"(?U)(\w+)", 1).alias("w"))
    hits = a.select("annotation_id", F.explode(tx.words(F.col("text"))).alias("w")).join(known, "w").groupBy("annotation_id").agg(F.collect_set("n").alias("names"))
    return a.join(hits, "annotation_id", "left").select("annotation_id", tx.scrub_any(F.col("text"), F.coalesce("names", F.array().cast("array<string>"))).alias("scrubbed"))


_OWN_SQL = r"regexp_replace(regexp_replace({0}, '(?i)(^|[^\pL\pN_])' || regexp_escape({1}) || '($|[^\pL\pN_])', '\1[NAME]\2', 'g'), '(?i)(^|[^\pL\pN_])' || regexp_escape({1}) || '($|[^\pL\pN_])', '\1[NAME]\2', 'g')"


@R.query(rf"""with own as (select folder_name, min(last_name) as a, min(first_name) as b from recordings where last_name <> '' group by 1), d as (select annotation_id, text, a, b from annotations left join own using (folder_name) where text is not null),
             one as (select annotation_id, text, a, b, case when length(a) >= 2 and contains(lower(text), lower(a)) then {_OWN_SQL.format('text', 'a')} else text end as s from d)
             select annotation_id, case when a is null then text when length(b) >= 2 and contains(lower(s), lower(b)) then {_OWN_SQL.format('s', 'b')} else s end as scrubbed from one""")
def scrub_own_names(t):
    """The folder's own names in its annotations; each folder brings its words once."""
    own = t.recordings.filter("last_name <> ''").groupBy("folder_name").agg(F.min("last_name").alias("a"), F.min("first_name").alias("b"))
    d = t.annotations.filter("text is not null").join(own, "folder_name", "left")
    return d.select("annotation_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(tx.scrub_words(F.col("text"), F.array("a", "b"))).alias("scrubbed"))


@R.query("""select background_row_id, case when raw_background_text is null or raw_background_text = '' then '' when regexp_matches(raw_background_text, '(?i)(^|[^\\pL\\d_])symmetric($|[^\\pL\\d_])') then 'symmetric'
             when regexp_matches(raw_background_text, '(?i)(^|[^\\pL\\d_])asymmetric($|[^\\pL\\d_])') then 'asymmetric' else '' end as pdr_symmetry,
             case when regexp_extract(raw_background_text, '([0-9]+(?:\\.[0-9]+)?)\\s*(?:-\\s*([0-9]+(?:\\.[0-9]+)?))?\\s*Hz', 2) = '' or raw_background_text is null
             then coalesce(regexp_extract(raw_background_text, '([0-9]+(?:\\.[0-9]+)?)\\s*(?:-\\s*([0-9]+(?:\\.[0-9]+)?))?\\s*Hz', 1), '')
             else concat(regexp_extract(raw_background_text, '([0-9]+(?:\\.[0-9]+)?)\\s*(?:-\\s*([0-9]+(?:\\.[0-9]+)?))?\\s*Hz', 1), '-', regexp_extract(raw_background_text, '([0-9]+(?:\\.[0-9]+)?)\\s*(?:-\\s*([0-9]+(?:\\.[0-9]+)?))?\\s*Hz', 2)) end as pdr_frequency_hz,
             case when raw_background_text is null or raw_background_text = '' then '' when regexp_matches(raw_background_text, '(?i)(^|[^\\pL\\d_])reactive($|[^\\pL\\d_])') then 'reactive'
             when regexp_matches(raw_background_text, '(?i)(^|[^\\pL\\d_])non.reactive($|[^\\pL\\d_])') then 'non_reactive' else '' end as pdr_reactivity from eeg_background""".replace("\\\\", "\\"))
def rhythm_fields(t):
    return t.eeg_background.select("background_row_id", *[c.alias(n) for n, c in tx.rhythm(F.col("raw_background_text")).items()])


@R.query("""select impression_row_id, case when coalesce(raw_text, '') = '' then '' when regexp_matches(raw_text, '(?i)within normal limits|is normal|was normal') then 'normal'
             when regexp_matches(raw_text, '(?i)abnormal') then 'abnormal' when regexp_matches(raw_text, '(?i)question') then 'questionably_abnormal' else 'indeterminate' end as impression from technologist_impression""")
def ordered_rule_class(t):
    return t.technologist_impression.select("impression_row_id", tx.impression_class(F.col("raw_text")).alias("impression"))


@R.query(r"""select study_row_id, case when coalesce(test_type_raw, '') = '' then '' else regexp_extract(test_type_raw, '(?i)(\d+)\s*(?:Hr|Hour)', 1) end as hours,
             case when coalesce(test_type_raw, '') = '' then '' when regexp_matches(test_type_raw, '(?i)video|VEEG') then 'true' else 'false' end as has_video,
             case when coalesce(test_type_raw, '') = '' then '' when regexp_matches(test_type_raw, '(?i)ambulatory|amb') then 'true' else 'false' end as is_ambulatory from studies""")
def test_type_fields(t):
    return t.studies.select("study_row_id", *[c.alias(n) for n, c in tx.test_type(F.col("test_type_raw")).items()])


@R.query(r"""select epileptiform_row_id from eeg_epileptiform where raw_description is not null and not regexp_matches(raw_description, '(?i)^(no|none)')""")
def negation_filter(t):
    """Findings that begin with a negation go, as do words that merely begin like one."""
    return t.eeg_epileptiform.filter(F.col("raw_description").isNotNull() & ~F.col("raw_description").rlike("(?i)^(no|none)")).select("epileptiform_row_id")


@R.query("""select study_row_id from studies where not (eeg_start_date is null and eeg_end_date is null and tech_comments is null and patient_dob is null)""")
def ghost_filter(t):
    return t.studies.filter("not (eeg_start_date is null and eeg_end_date is null and tech_comments is null and patient_dob is null)").select("study_row_id")


@R.query(r"""select background_row_id, case when regexp_matches(pdr_frequency_hz, '^\s*[0-9.]+\s*-\s*[0-9.]+\s*$')
             then (try_cast(string_split(pdr_frequency_hz, '-')[1] as double) + try_cast(string_split(pdr_frequency_hz, '-')[2] as double)) / 2 else try_cast(trim(pdr_frequency_hz) as double) end as hz,
             try_cast(regexp_extract(pdr_frequency_hz, '^\s*([0-9]+(?:\.[0-9]+)?)', 1) as double) as low_hz from eeg_background""")
def range_midpoint(t):
    c = F.col("pdr_frequency_hz")
    return t.eeg_background.select("background_row_id", tx.midpoint(c).alias("hz"), tx.lower_bound(c).alias("low_hz"))


@R.query(r"""select medication_row_id, lower(trim(trim(regexp_replace(regexp_extract(concat(regexp_replace(trim(name), '\b[0-9]{1,2}[/-][0-9]{1,2}([/-][0-9]{2,4})?\b|\b[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\b', '', 'g'), '('), '^(.*?)(?:[(,;]| [0-9])', 1), '\s+', ' ', 'g'), ' -'))) as term
             from medications where name is not null""")
def vocab_normalise(t):
    return t.medications.filter("name is not null").select("medication_row_id", F.lower(tx.term_name(F.col("name"))).alias("term"))


@R.query(r"""select doc_id, left(text, 500) as head, length(text) > 500 as was_cut from documents where text is not null""")
def clean_truncate(t):
    """Input limit of an extraction step: the head and whether more was there (the feature itself)."""
    return t.documents.filter("text is not null").select("doc_id", F.substring("text", 1, 500).alias("head"), (F.length("text") > 500).alias("was_cut"))


_INPUT_CHARS = 20_000  # the reference's limit of one extraction input


@R.query(f"""select doc_id, left(text, {_INPUT_CHARS}) as head, length(text) > {_INPUT_CHARS} as was_cut, length(text) as n_chars from documents where text is not null""")
def extraction_input(t):
    """Input of an extraction step: whole texts up to the reference's limit, a flag and the true length beyond."""
    c = F.col("text")
    return t.documents.filter("text is not null").select("doc_id", F.substring(c, 1, _INPUT_CHARS).alias("head"), (F.length(c) > _INPUT_CHARS).alias("was_cut"), F.length(c).cast("bigint").alias("n_chars"))


_ENDS_SQL = tx.FINDING_ENDS.removeprefix(r"(?i)(?:^|\s)")
_YEAR_SQL = r"(^|[^A-Za-z0-9_.])(?:19|20)\d{2}($|[^A-Za-z0-9_.])"


@R.query(rf"""with c as (select epileptiform_row_id, trim(case when regexp_matches(raw_description, '(?i)^\s?{_ENDS_SQL}') or not regexp_matches(raw_description, '(?is)^.+?\s{_ENDS_SQL}') then raw_description
                       else regexp_extract(raw_description, '(?is)^(.+?)\s{_ENDS_SQL}', 1) end, ' ') as x from eeg_epileptiform), k as (select epileptiform_row_id, rtrim(left(x, 3000), case when length(x) > 3000 then ' ' else '' end) as x from c)
             select epileptiform_row_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '{_YEAR_SQL}', '\1\2', 'g'), '{_YEAR_SQL}', '\1\2', 'g'), '[~"“”]', '', 'g'), '\s+', ' ', 'g'), ' -–—.,;') as finding from k""")
def clean_findings(t):
    """Findings cut at the next heading and lone years removed."""
    c = tx.strip_years(tx.truncate_at(F.col("raw_description")))
    return t.eeg_epileptiform.select("epileptiform_row_id", c.alias("finding"))


@R.query(r"""with l as (select doc_id, unnest(string_split(text, chr(10))) as line from documents where text is not null)
             select doc_id, trim(regexp_extract(line, '^([A-Z][A-Za-z]+): (.*)$', 1)) as field, trim(regexp_extract(line, '^([A-Z][A-Za-z]+): (.*)$', 2)) as value from l where regexp_matches(line, '^([A-Z][A-Za-z]+): (.*)$')""")
def kv_line_fields(t):
    p = "^([A-Z][A-Za-z]+): (.*)$"
    lines = t.documents.filter("text is not null").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).filter(F.col("line").rlike(p))
    return lines.select("doc_id", F.trim(F.regexp_extract("line", p, 1)).alias("field"), F.trim(F.regexp_extract("line", p, 2)).alias("value"))


@R.query(r"""select concat_ws('/', folder_name, source_file, cast(annotation_id as varchar)) as file, cast(3 as integer) as line_no, round(onset_sec, 3) as onset_sec, cast(0 as double) as duration_sec,
             trim(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'), ' '), '"') as text from annotations where onset_sec is not null""")
def comment_sections(t):
    """[Comments] rows of small sectioned files, one rebuilt from each annotation, parsed again."""
    a = t.annotations.filter("onset_sec is not null").select(F.concat_ws("/", "folder_name", "source_file", F.col("annotation_id").cast("string")).alias("file"), "onset_sec", F.regexp_replace(F.coalesce("text", F.lit("")), "\\s+", " ").alias("x"))
    body = F.array(F.lit("[Patient]"), F.lit("x=1"), F.lit("[Comments]"), F.format_string("%.3f,0,0,0,%s", "onset_sec", "x"), F.lit("[End]"))
    lines = a.select("file", F.posexplode(body).alias("line_no", "line"))
    return files.comment_rows(lines, "file", "line_no", "line")


@R.query(r"""with p as (select doc_id, string_split(replace(text, chr(10) || chr(10), chr(12)), chr(12)) as a from documents where text is not null)
             select doc_id, len(case when len(a) > 1 and trim(a[len(a)]) = '' then a[1:len(a) - 1] else a end) as n_pages from p""")
def page_split(t):
    c = tx.split_pages(F.replace(F.col("text"), F.lit("\n\n"), F.lit("\f")))
    return t.documents.filter("text is not null").select("doc_id", F.size(c).cast("bigint").alias("n_pages"))


@R.query(r"""with l as (select doc_id, string_split(text, chr(10)) as a from documents where text is not null),
             e as (select doc_id, unnest(a) as line, generate_subscripts(a, 1) as no from l)
             select doc_id, arg_max(line, no) as line from e where regexp_matches(line, '[0-9]+ mg') group by 1""")
def latest_matching_line(t):
    lines = t.documents.filter("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return files.last_matching(lines, "doc_id", "line_no", "line", "[0-9]+ mg")


@R.query(r"""with s as (select doc_id, string_split(text, chr(10)) as a from documents where text is not null)
             select doc_id, list_avg(list_transform(a, lambda x: length(x))) < 50 or len(list_filter(a, lambda x: length(x) < 20)) > 0.5 * len(a) as needs_ocr from s""")
def ocr_trigger(t):
    a = F.split("text", "\n")
    mean = F.aggregate(a, F.lit(0), lambda s, x: s + F.length(x)) / F.size(a)
    return t.documents.filter("text is not null").select("doc_id", ((mean < 50) | (F.size(F.filter(a, lambda x: F.length(x) < 20)) > 0.5 * F.size(a))).alias("needs_ocr"))


@R.query(r"""with m as (select study_row_id, regexp_replace(study_id, '[0-9]{4,}', '#', 'g') as s, eeg_start_date as e, regexp_replace(tech_comments, '[0-9]{4,}', '#', 'g') as c, regexp_replace(source_pdf, '[0-9]{4,}', '#', 'g') as f, regexp_replace(scanning_technologist, '[0-9]{4,}', '#', 'g') as g from studies)
             select study_row_id, '{' || concat_ws(',', '"study_id":' || to_json(s), '"visit":{' || concat_ws(',', '"eeg_start_date":' || to_json(e), '"tech_comments":' || to_json(c)) || '}', '"files":[' || coalesce(to_json(f), 'null') || ',' || coalesce(to_json(g), 'null') || ']') || '}' as packet from m""")
def nested_scrub(t):
    """Numbers masked in every text leaf of packets, dates kept by name."""
    d = t.studies.select("study_row_id", F.struct("study_id", F.struct("eeg_start_date", "tech_comments").alias("visit"), F.array("source_pdf", "scanning_technologist").alias("files")).alias("packet"))
    return nested.scrub_leaves(d, "packet", lambda c: F.regexp_replace(c, "[0-9]{4,}", "#"), ["eeg_start_date"]).select("study_row_id", F.to_json("packet").alias("packet"))


@R.query("""select event_id, coalesce(json_valid(props), false) as parsed, case when json_valid(props) then 'a' end as note from events""")
def json_repair(t):
    """Cut-off JSON completed: every event's properties, cut after a few characters, parse again."""
    d = t.events.select("event_id", F.concat(F.lit('{"items": ['), F.col("props"), F.lit(', {"note": "a')).alias("raw"))
    return nested.lenient_json(d, "raw", "fixed").select("event_id", F.col("fixed").isNotNull().alias("parsed"), F.get_json_object("fixed", "$.items[1].note").alias("note"))


@R.query("""select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events""")
def json_fanout(t):
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@R.query(r"""with l as (select unnest(string_split(channel_labels, '|')) as label from recordings where channel_labels is not null),
             c as (select trim(label) as label, lower(regexp_replace(trim(label), '^EEG ', '')) as low from l)
             select label, case when low in ('ecg','ecg1','ecg2','ecgl','ecgr') then 'ECG' when low in ('eog','loc','roc') then 'EOG' when low in ('emg','chin1','chin2') then 'EMG'
             when low in ('digi','osat','pr','flow','snore','pos','chest','abd') then 'MISC' when low = 'edf annotations' then 'ANNO' when regexp_matches(low, 'ecg|ekg') then 'ECG' when contains(low, 'eog') then 'EOG'
             when contains(low, 'emg') then 'EMG' when regexp_matches(low, 'dc|digi') then 'MISC' else 'EEG' end as kind, count(*) as n from c group by 1, 2""")
def typed_lookup(t):
    d = t.recordings.filter("channel_labels is not null").select(F.explode(F.split("channel_labels", r"\|")).alias("label")).select(F.trim("label").alias("label"))
    return d.groupBy("label", tx.channel_type(F.col("label")).alias("kind")).agg(F.count("*").alias("n"))


@R.query(r"""select event_id, coalesce(cast(try_cast(json_extract_string(props, '$.k') as bigint) as varchar), '') as k_text, round(value / 1048576, 2) as mb, round(value / 3600, 2) as h,
             coalesce(nullif(case when event_id % 3 = 0 then '' else event_type end, ''), 'none') as filled from events""")
def safe_casts(t):
    k = F.get_json_object("props", "$.k")
    return t.events.select("event_id", scalars.safe_int(k).alias("k_text"), scalars.megabytes(F.col("value")).alias("mb"), scalars.hours(F.col("value")).alias("h"), scalars.first_filled(F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type")), F.lit("none")).alias("filled"))


