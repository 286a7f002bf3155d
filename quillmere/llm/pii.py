"""Problem 3: personal information in free text, found and replaced JVM-side.

Detection is a chain of regular expressions; each kind is cut out of the text before the
next is looked for, so a number inside an address is not read as a phone number. It is a
map-only plan: no shuffle, no Python worker, no broadcast.

Numbers and dates get format-preserving pseudonyms: their digits run through a keyed Feistel
network and return to the places of the old ones, so equal values stay equal across
documents while separators, length and layout stay. Names, addresses and e-mail addresses
get a typed tag with 64 bits of a keyed hash (HMAC-SHA-256). The permutations can be undone with the key.

A case is replaced where it was found: its pass leaves a mark of its own in the text, and the
marks become placeholders in the end, so no other place of the text changes.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import days_from_civil, expand_year, let, valid_civil

ROUNDS = 10
MARKS = "\u0002\u0005\u0006\u0007\u000e\u000f"  # what each pass leaves in place of a match, the names last
CUT, OWN = MARKS[0], "\u0010"  # OWN: a control character that was in the text itself

# No repetition of a group is unbounded and every scan starts at a word: texts may be of any length.
# --- patterns: group 1 is the value -------------------------------------------------

_DOT = r"(?:\.|\s?\(dot\)\s?|\s?\[dot\]\s?|\sdot\s)"
EMAIL = rf"(?i)(?<![a-z0-9_+%.-])((?:[a-z0-9_+%-]{{1,64}}{_DOT}){{0,30}}[a-z0-9_+%-]{{1,64}}\s?(?:@|\(at\)|\[at\]|\{{at\}}|\sat(?=\s[a-z0-9-]+\sdot\s))\s?[a-z0-9-]{{1,64}}(?:{_DOT}[a-z0-9-]{{1,64}}){{1,30}})"

_STREET = (
    "street|st\\.?|road|rd\\.?|avenue|ave\\.?|boulevard|blvd\\.?|lane|ln\\.?|drive|dr\\.?|court|ct\\.?|terrace|ter\\.?|mews|way|place|pl\\.?|square|sq\\.?|"
    "close|crescent|circle|parkway|pkwy\\.?|highway|hwy\\.?|alley|row|walk|grove|gardens?|hill|green|park"
)
_AFTER = r"(?=$|[,;.\n/|)?!]| \d{5}| last | - | / |  |\x02)"
_TOWN = rf"\p{{Lu}}\p{{Ll}}{{1,40}}(?:[ -]\p{{Lu}}\p{{Ll}}{{1,40}}){{0,2}}"
_UNIT = r"(?:(?:, ?| )(?:(?i:apt|apartment|unit|suite|ste|floor|fl|room|rm)\.? ?#?|# ?)\w{1,5})"
_PLACE = rf"(?:,? {_TOWN},? (?:[A-Z]{{2}} )?\d{{5}}(?:-\d{{4}})?(?!\d)|, {_TOWN}{_AFTER}|,? \d{{5}}(?!\d))"
ADDRESS = (
    rf"((?<![\w-])(?i:p\.? ?o\.? ?box|post office box|postfach) \d+{_PLACE}?"
    rf"|(?<![\w.:/-])\d{{1,5}}[A-Za-z]? (?:(?!(?i:am|pm|before|after|by|of|at|for|from|with|on|in|to|and)\b)\p{{L}}[\p{{L}}'-]{{1,40}} ){{1,3}}(?i:{_STREET})(?![\p{{L}}\d]){_UNIT}?{_PLACE}?(?:{_UNIT})?"
    rf"|(?<!\p{{L}})\p{{Lu}}[\p{{L}}-]{{0,40}}(?i:stra(?:ß|ss)e|str\.|weg|gasse|platz|allee|ring|damm) \d{{1,4}}[a-z]?(?:, \d{{5}} {_TOWN})?)"
)

_LABEL = (
    r"ssn(?: on file)?|social security(?: (?:no|number|nr|num)\b\.?)?|soc\.? ?sec\.?(?: (?:no|number)\b\.?)?|social|"
    r"mrn|med(?:ical)?\.? rec(?:ord)?\.?(?: (?:no|number)\b\.?)?|record (?:no|number)\b\.?|chart (?:no|number)\b\.?|"
    r"passport(?: (?:no|number)\b\.?)?|driver'?s? lic(?:en[sc]e)?\.?(?: (?:no|number)\b\.?)?|lic(?:en[sc]e)?\.?(?: (?:no|number)\b\.?)|dl(?: no)?\.?|"
    r"ins(?:urance)?\.? ?(?:id|no|number|policy)\b\.?|member ?(?:id|no|number)\b\.?|policy(?: (?:no|number|id)\b\.?)?|patient id|pt id|medicare|medicaid"
)
ID_NUMBER = rf"(?<![\p{{L}}\d])(?i:{_LABEL})\s?[:#=]?\s?((?:[A-Z]{{1,4}}[ -]?)?(?=(?:\d[ -]?){{3}}\d)\d++(?:[ -]\d++){{0,60}}(?:[A-Z](?![\p{{L}}]))?)(?![\d])"
BARE_ID = r"(?<![\w+.-])(\d{3}-\d{2}-\d{4})(?![\w-])"

PHONE = (
    r"(?<![\w+-])(?<!\d\.)((?:\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){1,4}"
    r"|(?:1[ .-])?\(\d{3}\) ?\d{3}[ .-]?\d{4}|(?:1[ .-])?\d{3} ?[/.-] ?\d{3}[ .-]\d{4}|\d{3} \d{3} \d{4}|0\d{2,4} \d{3,4} \d{3,4}|\d{10}|\d{3}-\d{4})"
    r"(?:,? ?(?i:x|ext\.?|extension) ?\d{1,6})?)(?![\d]|-\d)"
)

_ROLE = (
    r"[Pp]t|[Pp]atient|PT|PATIENT|[Dd]r|DR|[Dd]octor|[Mm]r|[Mm]rs|[Mm]s|[Mm]iss|[Pp]rof|RN|LPN|MD|PA|NP|[Nn]urse|[Tt]ech|[Tt]echnologist|[Tt]echnician|[Mm]om|[Mm]other|[Dd]ad|[Ff]ather|"
    r"[Hh]usband|[Ww]ife|[Ss]pouse|[Pp]artner|[Ss]ister|[Bb]rother|[Ss]on|[Dd]aughter|[Aa]unt|[Uu]ncle|[Gg]rand(?:mother|father|ma|pa|son|daughter)|"
    r"[Cc]ousin|[Nn]iece|[Nn]ephew|[Cc]aregiver|[Gg]uardian|[Ee]mergency contact|[Nn]eighbou?r|[Ff]riend|[Rr]oommate|[Ff]ianc[eé]e?|[Aa]ide"
)
# No token of a name: roles, relations, event words and terms named after persons.
_NO = (
    r"(?!(?:Mother|Father|Mom|Dad|Husband|Wife|Spouse|Sister|Brother|Son|Daughter|Caregiver|Family|Parents?|Patient|Pt|Nurse|Doctor|Dr|Mr|Mrs|Ms|Miss|Tech|Technologist|RN|LPN|MD|REEGT|RPSGT|CLTM|"
    r"AM|PM|Hz|NT|REM|HV|EEG|EKG|ECG|EMG|MRI|CT|ID|SSN|MRN|SN|PDR|PLEDs?|GPDs?|LPDs?|REC|START|XLEvent|PushButton|Start|Recording|Recorder|Segment|Clip|Marker|Impedances?|Spikes?|Seizure|Eyes|Open|Closed|"
    r"Jacksonian|Todd|Rolandic|Breach|Video|Battery|Event|Leads?|Photic|Diary|Sleep|Technical|Frequent|No|Stage|File|Case|Gain|Burst|Push|Button|Home|Phone|Fax|Cell)\b)"
)
_W = rf"{_NO}\p{{Lu}}\p{{L}}{{1,40}}+(?:['’](?!s\b)\p{{L}}{{1,40}})?(?:-\p{{Lu}}\p{{L}}{{1,40}}){{0,3}}"
_I = r"\p{Lu}\.?(?![\p{L}\d])"
_ONE = rf"(?:{_I} ?){{0,2}}{_W}(?: (?:{_W}|{_I}|(?:von|van|de|der|la|del|bin)(?= \p{{Lu}}))){{0,9}}"
_TURNED = rf"{_W}(?: {_W})?, {_W}(?: {_I})?(?! \p{{Lu}}\p{{Ll}}|['’]s phone| \()"
_LOWER = r"(?!(?:and|or|the|a|an|his|her|their|who|was|is|has|had|not|did|in|on|at|to|ate|for|by|with|of)\b)\p{Ll}{2,40}(?: \p{Ll}\.?)? (?!(?:and|or|the|at|in|on|to|said|says|called|notified|was|is)\b)\p{Ll}{3,40}"
_CLIENT = r"(?:[Pp]t|[Pp]atient|PT|PATIENT|[Ee]mergency contact|[Cc]aregiver|[Gg]uardian|[Pp]arent|[Cc]ontact)\.? "
_TITLES = rf"(?:(?:{_ROLE})\.? ){{1,2}}"
_BEFORE = r"(?:[Bb]y|[Ww]ith|[Ww]/|[Aa]sk|[Aa]sked|[Tt]old|[Pp]er|[Cc]alled|[Pp]aged|[Nn]otified|[Vv]ia|[Ff]rom|[Cc]\.?c\.?|[Aa]ttn:?|[Nn]ame:?) (?:the )?"
_BEYOND = r"(?=(?:['’]s)?(?: phone)?(?: \([A-Z]{2,6}\))?(?:,? (?:at bedside|notified|says?|said|called|calls|reports|reported|states?|stated|at hookup|at lunch|present|arrived|asked|in room|phone\b)|: ))"
_CRED = r"(?=(?:['’]s phone| \((?:R?\.? ?EEG ?T\.?|REEGT|RPSGT|CLTM|RN|MD|PA|NP|RET)\)|,? (?:REEGT|RPSGT|CLTM)\b))"
NAME = (
    rf"(?<![\p{{L}}\d'’-])(?:{_CLIENT}({_TURNED})|{_BEFORE}(?:{_CLIENT})({_LOWER})|(?:{_CLIENT})({_LOWER}){_BEYOND}"
    rf"|{_TITLES}({_ONE})|{_BEFORE}({_TURNED})|{_BEFORE}({_ONE})|({_ONE}){_BEYOND}|({_ONE}){_CRED})"
)

KINDS = [("EMAIL", EMAIL), ("ADDRESS", ADDRESS), ("ID_NUMBER", ID_NUMBER), ("ID_NUMBER", BARE_ID), ("PHONE", PHONE)]

# A cheap test that any text with a case passes: digits enough, a number before words, an at-sign, or a capital at a
# word's start.
HINT = r"\d[\d .()/-]{5,}|\d[a-z]? \p{L}+ \p{L}{2}|@|(?i:\Wat\W|\b(?:box|pt|patient|contact)\b)|(?:^|[ \n(])\p{Lu}[\p{L}.]"


def _passes(df: DataFrame, text: str, whole: bool = False) -> DataFrame:
    """Add ``__left``, the text with a mark for each case, and the values of each pass in order: ``__k0`` ...

    ``whole`` adds ``__w0`` ..., the matches the values end, and keeps the text's own marks as OWN, listed in ``__own``.
    """
    t = F.col(text)
    hinted = F.coalesce(t.rlike(HINT), F.lit(False))
    if whole:
        df = df.withColumn("__own", F.regexp_extract_all(t, F.lit(f"[{MARKS}{OWN}]"), F.lit(0)))
        t = F.when(F.size("__own") > 0, F.regexp_replace(t, f"[{MARKS}{OWN}]", OWN)).otherwise(t)
    df = df.withColumn("__left", t if whole else F.when(hinted, t)).withColumn("__hint", hinted)
    for k, (_, pattern) in enumerate(KINDS):
        got = f"__k{k}"
        df = df.withColumn(got, F.when(F.col("__hint"), F.regexp_extract_all("__left", F.lit(pattern), F.lit(1))))
        if whole:
            df = df.withColumn(f"__w{k}", F.when(F.size(got) > 0, F.regexp_extract_all("__left", F.lit(pattern), F.lit(0))))
        df = df.withColumn("__left", F.when(F.size(got) > 0, F.regexp_replace("__left", pattern, MARKS[k])).otherwise(F.col("__left")))
    # One pass for names: the whole match comes out, its groups are read from it again.
    k = len(KINDS)
    named = F.col("__hint") & F.col("__left").rlike(r"\p{Lu}|(?i:\b(?:pt|patient|contact)\b)")
    df = df.withColumn(f"__k{k}", F.when(named, F.regexp_extract_all(F.regexp_replace("__left", NAME, "\u0003$1$2$3$4$5$6$7$8\u0004"), F.lit("\u0003([^\u0004]+)\u0004"), F.lit(1))))
    if whole:
        df = df.withColumn(f"__w{k}", F.when(F.size(f"__k{k}") > 0, F.regexp_extract_all("__left", F.lit(NAME), F.lit(0))))
        df = df.withColumn("__left", F.when(F.size(f"__k{k}") > 0, F.regexp_replace("__left", NAME, MARKS[k])).otherwise(F.col("__left")))
    return df.drop("__hint")


PASSES = [kind for kind, _ in KINDS] + ["NAME"]


def find(df: DataFrame, text: str, out: str = "pii") -> DataFrame:
    """Add ``out``: array of struct(kind, value), values exactly as in the text.

    Null, empty and blank texts give an empty array; repeated mentions repeat. Texts of any
    length are scanned whole. Other columns stay, one named ``out`` is replaced.
    """
    df = _passes(df, text)
    empty = F.array().cast("array<struct<kind:string,value:string>>")
    found = F.filter(F.concat(*[F.coalesce(_tagged(f"__k{k}", kind), empty) for k, kind in enumerate(PASSES)]), lambda x: x["value"] != "")
    return df.withColumn(out, found).drop("__left", *[f"__k{k}" for k in range(len(PASSES))])


def _tagged(column: str, kind: str) -> Column:
    return F.transform(F.col(column), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))


# --- pseudonyms ---------------------------------------------------------------------


def keyed_hash(message: Column, key: str) -> Column:
    """HMAC-SHA-256 of the message as hexadecimal digits."""
    secret = key.encode()
    secret = (hashlib.sha256(secret).digest() if len(secret) > 64 else secret).ljust(64, b"\0")
    inner, outer = bytes(x ^ 0x36 for x in secret), bytes(x ^ 0x5C for x in secret)
    return F.sha2(F.concat(F.lit(outer), F.unhex(F.sha2(F.concat(F.lit(inner), F.encode(message, "UTF-8")), 256))), 256)


def _prf(key: str, tweak: Column, half: Column, width: Column) -> Column:
    """Keyed round function: a number of at most ``width`` decimal digits."""
    h = F.conv(F.substring(keyed_hash(F.concat_ws("|", tweak, half.cast("string")), key), 1, 15), 16, 10).cast("decimal(20,0)")
    return (h % F.rpad(F.lit("1"), width + 1, "0").cast("decimal(20,0)")).cast("bigint")


def permute_digits(digits: Column, key: str, inverse: bool = False) -> Column:
    """A digit string of 2 digits or more through a keyed Feistel network of its own length.

    Beyond 34 digits it is permuted in even blocks, each with its place as a tweak. Single
    digits and anything with other characters come back unchanged.
    """

    def block(d: Column, place: Column) -> Column:
        n = F.length(d)
        u = F.floor(n / 2).cast("int")
        v = n - u
        start = F.struct(F.substring(d, F.lit(1), u).cast("bigint").alias("a"), F.substring(d, u + 1, v).cast("bigint").alias("b"))
        sign = -1 if inverse else 1

        def step(s: Column, i: Column) -> Column:
            pu, pv = F.rpad(F.lit("1"), u + 1, "0").cast("bigint"), F.rpad(F.lit("1"), v + 1, "0").cast("bigint")
            tweak = F.concat_ws("|", i.cast("string"), n.cast("string"), place)
            a = F.pmod(s["a"] + sign * _prf(key, tweak, s["b"], u), pu)
            b = F.pmod(s["b"] + sign * _prf(key, tweak, s["a"], v), pv)
            return F.when(i % 2 == 0, F.struct(a.alias("a"), s["b"].alias("b"))).otherwise(F.struct(s["a"].alias("a"), b.alias("b")))

        order = F.sequence(F.lit(ROUNDS), F.lit(1)) if inverse else F.sequence(F.lit(1), F.lit(ROUNDS))
        return F.aggregate(order, start, step, lambda s: F.concat(F.lpad(s["a"].cast("string"), u, "0"), F.lpad(s["b"].cast("string"), v, "0")))

    def body(d: Column) -> Column:
        n = F.length(d)
        parts = F.ceil(n / 34).cast("int")
        edge = lambda i: F.floor(i * n / parts).cast("int")
        cut = F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.struct(i.cast("string").alias("i"), F.substr(d, edge(i) + 1, edge(i + 1) - edge(i)).alias("d")))
        return F.array_join(F.transform(cut, lambda x: block(x["d"], x["i"])), "")

    return F.when(digits.rlike(r"^\d{2,}$"), let(digits, body)).otherwise(digits)


def permute_in_format(value: Column, key: str, inverse: bool = False) -> Column:
    """All digits of ``value`` beyond a country code permuted, every other character kept."""
    code = F.regexp_extract(value, r"^(\+\d{1,3}(?=[ .-]))?", 1)
    rest = F.substr(value, F.length(code) + 1)
    fresh = permute_digits(F.regexp_replace(rest, r"[^0-9]", ""), key, inverse)
    both = F.struct(code.alias("c"), rest.alias("r"), fresh.alias("f"))
    return let(
        both,
        lambda x: F.concat(
            x["c"],
            F.aggregate(
                F.split(x["r"], ""),
                F.struct(F.lit("").alias("o"), F.lit(1).alias("i")),
                lambda s, ch: F.when(ch.rlike("^[0-9]$"), F.struct(F.concat(s["o"], F.substring(x["f"], s["i"], F.lit(1))).alias("o"), (s["i"] + 1).alias("i"))).otherwise(
                    F.struct(F.concat(s["o"], ch).alias("o"), s["i"].alias("i"))
                ),
                lambda s: s["o"],
            ),
        ),
    )


DATE_SPAN = 36525  # days from 1926-01-01 that dates are permuted within; earlier and later centuries likewise
_FIRST = -16071  # 1926-01-01


def permute_date(day: Column, key: str, inverse: bool = False) -> Column:
    """A day number permuted within its century by cycle walking."""
    walk = lambda s, _: F.when(s["i"] > 0, F.when(s["n"].cast("int") < DATE_SPAN, s).otherwise(_hop(s, key, inverse))).otherwise(_hop(s, key, inverse))
    offset = F.pmod(day - _FIRST, F.lit(DATE_SPAN))
    start = F.struct(F.lpad(offset.cast("string"), 5, "0").alias("n"), F.lit(0).alias("i"))
    # A hop leaves the century with probability 0.63, so 96 hops suffice for all but a share of 1e-19.
    return F.aggregate(F.sequence(F.lit(1), F.lit(96)), start, walk, lambda s: s["n"].cast("int") + (day - offset))


def _hop(s: Column, key: str, inverse: bool) -> Column:
    return F.struct(permute_digits(s["n"], key + "/date", inverse).alias("n"), (s["i"] + 1).alias("i"))


def placeholder(kind: str, value: Column, key: str) -> Column:
    if kind in ("PHONE", "ID_NUMBER"):
        return F.concat(F.lit(f"[{kind} "), permute_in_format(value, key), F.lit("]"))
    return F.concat(F.lit(f"[{kind}-"), F.upper(F.substring(keyed_hash(F.concat(F.lit(kind + "|"), F.lower(value)), key), 1, 16)), F.lit("]"))


def redact(df: DataFrame, text: str, key: str, out: str = "redacted", inverse_dates: bool = False) -> DataFrame:
    """Add ``out``: the text with every case replaced by its typed placeholder and every date by another.

    ``key`` keeps pseudonyms equal across documents. Only the found places change; a word that
    contains a found value stays. Null texts stay null, others keep all else.
    """
    df = _passes(df, text, whole=True)
    df = df.withColumn("__left", shift_dates(F.col("__left"), key, inverse_dates))
    for k, kind in enumerate(PASSES):
        # A match ends with its value: what stands before it, such as a label or a title, stays.
        df = df.withColumn("__left", F.when(F.size(f"__w{k}") > 0, _fill(F.col("__left"), MARKS[k], F.zip_with(f"__w{k}", f"__k{k}", _swapped(kind, key)))).otherwise(F.col("__left")))
    df = df.withColumn("__left", F.when(F.size("__own") > 0, _fill(F.col("__left"), OWN, F.col("__own"))).otherwise(F.col("__left")))
    return df.withColumn(out, F.col("__left")).drop("__left", "__own", *[f"__{x}{k}" for x in "kw" for k in range(len(PASSES))])


def _swapped(kind: str, key: str):
    return lambda w, v: F.concat(F.substr(w, F.lit(1), F.length(w) - F.length(v)), placeholder(kind, v, key))


def _fill(text: Column, mark: str, values: Column) -> Column:
    """Each mark of the text replaced by its value, in order."""
    return let(F.struct(F.split(text, mark, -1).alias("s"), values.alias("v")), lambda x: F.concat(F.get(x["s"], F.lit(0)), F.array_join(F.zip_with(x["v"], F.slice(x["s"], 2, F.size(x["s"])), lambda a, b: F.concat(a, b)), "")))


_MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
_MONTH = "Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sept?(?:ember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?"
_YEAR = r"(?:1[6-9]|2[01])\d{2}"
# Groups of one notation each: year first, year last, day and month's name, month's name and day.
_NOTATIONS = [
    rf"({_YEAR})([-/.])(\d{{1,2}})(?:\2)(\d{{1,2}})",
    rf"(\d{{1,2}})([-/.])(\d{{1,2}})(?:\2)({_YEAR}|(?<=\d\d[.]\d\d[.]|[/-])\d{{2}})",
    rf"(\d{{1,2}})(?:st|nd|rd|th)?([-\s/.]{{1,3}}(?:of )?)((?i:{_MONTH}))([-\s/.,]{{1,3}})({_YEAR}|\d{{2}})",
    rf"((?i:{_MONTH}))([.]?\s)(\d{{1,2}})(?:st|nd|rd|th)?(,?\s)({_YEAR})",
]
DATE = r"(?<![\p{L}\d./-])(?:" + "|".join([_NOTATIONS[0], _NOTATIONS[1].replace(r"\2", r"\6"), *_NOTATIONS[2:]]) + r")(?![\p{L}\d]|[/-]\d|\.\d)"


def shift_dates(text: Column, key: str, inverse: bool = False) -> Column:
    """Every date with a year permuted within its notation: order, separators, widths and the style of month names stay.

    With slash or hyphen the month comes first where that gives a date, else the day; dotted, the day comes first. Two-digit
    years lie in 1926-2025. Impossible dates and dates without a year stay.
    """
    return _replace_each(text, DATE, lambda v: _fresh_date(v, key, inverse))


def _fresh_date(v: Column, key: str, inverse: bool) -> Column:
    out = v
    for i in reversed(range(4)):
        out = F.when(v.rlike(f"^(?:{_NOTATIONS[i]})$"), _in_notation(v, i, key, inverse)).otherwise(out)
    return out


def _in_notation(v: Column, i: int, key: str, inverse: bool) -> Column:
    g = lambda n: F.regexp_extract(v, f"^(?:{_NOTATIONS[i]})$", n)
    whole = lambda x: x.try_cast("int")
    if i < 2:
        year, one, two = (g(1), g(3), g(4)) if i == 0 else (g(4), g(1), g(3))
        m, d = whole(one), whole(two)
        day_first = (F.lit(False) if i == 0 else (g(2) == ".") | (m > 12)) & (d <= 12)
        parts = F.struct(year.alias("y"), F.when(day_first, d).otherwise(m).alias("m"), F.when(day_first, m).otherwise(d).alias("d"), day_first.alias("turned"), ((F.length(one) == 1) | (F.length(two) == 1)).alias("bare"))
    else:
        name, day = (g(3), g(1)) if i == 2 else (g(1), g(3))
        m = F.array_position(F.array(*[F.lit(x[:3].lower()) for x in _MONTHS]), F.lower(F.substring(name, 1, 3))).cast("int")
        parts = F.struct(g(5).alias("y"), m.alias("m"), whole(day).alias("d"), F.lit(False).alias("turned"), (F.length(day) == 1).alias("bare"), name.alias("name"))

    def fresh(p: Column) -> Column:
        day = days_from_civil(F.when(F.length(p["y"]) == 2, expand_year(p["y"])).otherwise(whole(p["y"])), p["m"], p["d"])
        return F.when(valid_civil(F.when(F.length(p["y"]) == 2, expand_year(p["y"])).otherwise(whole(p["y"])), p["m"], p["d"]), let(F.struct(F.date_from_unix_date(permute_date(day, key, inverse)).alias("n"), p.alias("p")), shown)).otherwise(v)

    def shown(x: Column) -> Column:
        n, p = x["n"], x["p"]
        pad = lambda c: F.when(p["bare"], c.cast("string")).otherwise(F.lpad(c.cast("string"), 2, "0"))
        y, m, d = F.year(n), pad(F.month(n)), pad(F.dayofmonth(n))
        y = F.when(F.length(p["y"]) == 2, F.lpad((y % 100).cast("string"), 2, "0")).otherwise(y.cast("string"))
        if i < 2:
            one, two = F.when(p["turned"], d).otherwise(m), F.when(p["turned"], m).otherwise(d)
            return F.concat_ws("", y, g(2), one, g(2), two) if i == 0 else F.concat_ws("", one, g(2), two, g(2), y)
        full = F.element_at(F.array(*map(F.lit, _MONTHS)), F.month(n))
        name = F.when((F.length(p["name"]) > 3) & (F.lower(p["name"]) != "sept"), full).otherwise(F.substring(full, 1, 3))
        name = F.when(p["name"] == F.upper(p["name"]), F.upper(name)).when(p["name"] == F.lower(p["name"]), F.lower(name)).otherwise(name)
        end = F.when(v.rlike(r"\d(?:st|nd|rd|th)"), F.when(F.dayofmonth(n).isin(1, 21, 31), "st").when(F.dayofmonth(n).isin(2, 22), "nd").when(F.dayofmonth(n).isin(3, 23), "rd").otherwise("th")).otherwise("")
        return F.concat_ws("", d, end, g(2), name, g(4), y) if i == 2 else F.concat_ws("", name, g(2), d, end, g(4), y)

    return let(parts, fresh)


def _replace_each(text: Column, pattern: str, f) -> Column:
    both = F.struct(F.split(text, pattern, -1).alias("s"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    swapped = let(both, lambda x: F.concat(F.get(x["s"], F.lit(0)), F.array_join(F.zip_with(F.transform(x["m"], f), F.slice(x["s"], 2, F.size(x["s"])), lambda a, b: F.concat(a, b)), "")))
    return F.when(text.rlike(pattern), swapped).otherwise(text)


SOURCES = [("annotations", "annotation_id", "text"), ("studies", "study_row_id", "tech_comments"), ("eeg_epileptiform", "epileptiform_row_id", "raw_description")]


def remarks(tables: dict[str, DataFrame]) -> DataFrame:
    """(source_table, row_id, text) of the three tables with remarks."""
    parts = [tables[t].select(F.lit(t).alias("source_table"), F.col(i).alias("row_id"), F.col(c).alias("text")) for t, i, c in SOURCES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def found(rows: DataFrame) -> DataFrame:
    """(source_table, row_id, kind, value), each distinct row once."""
    f = find(rows, "text").select("source_table", "row_id", F.explode(F.array_distinct("pii")).alias("p"))
    return f.select("source_table", "row_id", "p.kind", "p.value")
