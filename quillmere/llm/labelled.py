"""Labelled documents for the rules of ``quality.py``.

Composed from parts whose kind is known: sentences, items, cells and noise in several
layouts, mixed in drawn proportions. The label is the kind that holds more than half of the
non-blank characters, otherwise 'prose'.
"""

from __future__ import annotations

import random
import textwrap

_SUBJECTS = {
    "en": ["The recording", "The patient", "A second reading", "The mother", "Background rhythm", "The night shift", "Our clinic", "This report", "The amplitude", "Follow-up imaging"],
    "de": ["Die Aufzeichnung", "Der Patient", "Die Grundaktivität", "Der Befund", "Die Mutter", "Das Team"],
    "es": ["El registro", "La paciente", "El ritmo de fondo", "La familia", "El informe", "El equipo"],
    "fr": ["L'enregistrement", "Le patient", "Le rythme de fond", "La famille", "Le rapport", "L'équipe"],
}
_REST = {
    "en": ["shows no change in comparison with the study of last year", "was reviewed at the end of the week and is stable", "has remained within the limits that we expect for this age", "does not explain the episodes described at home", "is of good quality in all of the channels", "was tired after the drive and slept for most of the afternoon", "contains several runs of slow activity over the left side", "would be repeated if the symptoms return"],
    "de": ["zeigt im Vergleich zum Vorjahr keine wesentliche Änderung", "wurde am Ende der Woche noch einmal geprüft", "ist für das Alter noch im Bereich der Norm", "war nach der Fahrt müde und schlief am Nachmittag", "erklärt die zu Hause beschriebenen Ereignisse nicht"],
    "es": ["no muestra cambios en comparación con el estudio del año pasado", "se revisó al final de la semana y sigue estable", "está dentro de los límites de la edad", "no explica los episodios descritos en casa", "durmió bien durante la mayor parte de la tarde"],
    "fr": ["ne montre pas de changement par rapport à l'année dernière", "a été revu à la fin de la semaine et reste stable", "est dans les limites de la normale pour l'âge", "n'explique pas les épisodes décrits à la maison", "a bien dormi pendant une grande partie de l'après-midi"],
}
_ITEMS = ["check leads", "lights off", "eyes open", "sleep onset", "phone call", "button press", "spike left side", "marker 12", "gain 50", "file 3 of 8", "stage 2", "electrode T4 loose", "aspirin 100 mg twice daily", "iron 250 mg at bedtime", "vitamin C 50 mg", "staring", "a fall on the stairs", "loss of balance for a minute", "impedance 7 kOhm", "@event 9", "nurse in room", "walks to bathroom", "chewing", "ward phone 12", "page the doctor?", "T3-T5 ok", "O1-O2", "high blood pressure", "kidney stones", "heart murmur", "back pain", "dizziness", "migraine", "weak left arm", "chronic cough", "poor appetite", "night sweats", "broken wrist", "double vision", "fever", "attention problems since first grade", "took the morning dose two hours late", "walks slowly along the corridor", "left arm and face feel numb at times", "cramps in both legs after climbing stairs", "vitamin D 1,000 units once a week", "tape replaced over the right ear", "sits up and looks at the camera", "iron deficiency of unknown cause", "operation on the left knee 2009", "magnesium citrate 300 mg every evening", "pain behind the right eye for an hour", "talks on the phone with a relative"]
_HEADS = ["Time", "Rate", "Lead", "Status", "Count", "Value", "Flag", "Hour", "Start", "Level", "Entry", "Name"]


def _sentence(r: random.Random, lang: str) -> str:
    s = f"{r.choice(_SUBJECTS[lang])} {r.choice(_REST[lang])}"
    if r.random() < 0.3:
        s += {"en": ", and ", "de": ", und ", "es": ", y ", "fr": ", et "}[lang] + s[0].lower() + s[1:]
    if r.random() < 0.25:
        s = {"en": "At 9:40 on 3/14/2022, ", "de": "Um 9:40 Uhr am 14.3.2022: ", "es": "A las 9:40, ", "fr": "À 9h40, "}[lang] + s[0].lower() + s[1:]
    if r.random() < 0.3:
        s += {"en": " near {}, where {} events lasted {} s", "de": " bei {}, wo {} Ereignisse {} s dauerten", "es": " cerca de {}, con {} episodios de {} s", "fr": " près de {}, où {} événements ont duré {} s"}[lang].format(r.choice(["T3-T5", "O1-O2", "F8-T4", "Fz-Cz"]), r.randint(2, 60), r.randint(2, 90))
    return s + r.choice([".", ".", ".", ".", "?", "; see above."])


def prose(r: random.Random, size: int) -> str:
    lang = r.choice(["en", "en", "en", "de", "es", "fr"])
    out: list[str] = []
    while sum(map(len, out)) < size or not out:
        out.append(_sentence(r, lang))
    style = r.random()
    if style < 0.15:
        return "\n".join(out)
    text = " ".join(out)
    if style < 0.4:
        return textwrap.fill(text, r.choice([56, 64, 68, 70, 72, 78]))
    if style < 0.5:
        return text.lower().replace(".", "").replace(",", "")
    if style < 0.6:
        k = len(out) // 2
        return "HISTORY\n" + " ".join(out[:k]) + "\n\nPLAN\n" + " ".join(out[k:])
    return text


def items(r: random.Random, size: int) -> str:
    plain = r.random() < 0.4
    bank = [x for x in _ITEMS if not any(c.isdigit() for c in x)] if plain else _ITEMS
    if r.random() < 0.15:
        # Codes with or without a remark, one to a line.
        bank = [f"{code}{end}" for code in r.sample(["C3-P3", "F7-T7", "Fz-Cz", "O1-O2", "P4-O2", "A12", "BX 7", "K-204", "Fp1", "Room 3", "T8"], 6) for end in ("", " ok", " loose", " moved", " re-set")]
    bank = r.sample(bank, r.randint(4, len(bank)))
    ends = r.choice([[""], [""], ["?"], ["?", "!"], ["."]])
    mark = r.choice(["- ", "* ", "• ", "– ", "n. ", "n) ", "(n) ", "a) ", "[ ] ", "", "", "  - "])
    out: list[str] = []
    while sum(map(len, out)) < size or not out:
        k = len(out) + 1
        lead = mark.replace("n", str(k)) if "n" in mark else mark.replace("a", "abcdefghijklmnopqrstuvwxyz"[k % 26]) if mark == "a) " else mark
        body = r.choice(bank)
        out.append(lead + (body.capitalize() if r.random() < 0.3 else body) + (" " + r.choice(["ok", "again", "left", "x2"]) if r.random() < 0.2 else "") + (r.choice(ends) if r.random() < 0.3 else ""))
    return "\n".join(out)


def _cell(r: random.Random) -> str:
    return r.choice([str(r.randint(0, 5000)), f"{r.uniform(0, 200):.{r.randint(0, 2)}f}", f"{r.randint(0, 23):02d}:{r.randint(0, 59):02d}", r.choice(["ok", "H", "L", "N", "on", "off"]), r.choice(["C3-P3", "F7-T7", "O1-O2", "Fz-Cz"]), "", r.choice(["low", "high", "after meal"])])


def cells(r: random.Random, size: int) -> str:
    n, style = r.randint(3, 7), r.choice(["|", "\t", ",", ";", "aligned", "bare |", "two"])
    if style == "two":
        n = 2
    rows, out = [[r.choice(_HEADS) for _ in range(n)]], 0
    while out < size:
        row = [_cell(r) for _ in range(n)]
        row[0] = row[0] or "1"
        rows.append(row)
        out += sum(map(len, row))
    if style == "|":
        return "\n".join("| " + " | ".join(x) + " |" for x in rows)
    if style in ("aligned", "two"):
        return "\n".join("".join(c.ljust(r_ + 3) for c, r_ in zip(x, [10] * n)).rstrip() for x in rows)
    return "\n".join((" | " if style == "bare |" else style).join(x) for x in rows)


def noise(r: random.Random, size: int) -> str:
    style = r.randrange(9)
    if style == 0:
        signs = "".join(r.sample("{}[]<>|\\/~^_=*#;:.,!1li", 14)) + " "
        return "".join(r.choice(signs) for _ in range(size))
    if style == 1:
        return " ".join(f"{r.randrange(256):02x}" for _ in range(size // 3 + 6))
    if style == 2:
        letters = "".join(r.sample("bcdfghjklmnpqrstvwxzBCDGHJKLMQ0123456789'", 24))
        return " ".join("".join(r.choice(letters) for _ in range(r.randint(1, 9))) for _ in range(size // 6 + 6))
    if style == 3:
        return "\n".join(r.choice(["=", "-", "*", ".", "_", "|", "~ ", "□ ", "#"]) * r.randint(12, 40) for _ in range(size // 26 + 3))
    if style == 4:
        word = r.choice(["test", "null", "spike", "xx", "delta ", "TEST", "undefined", "ok"]).strip()
        return r.choice([" ", " ", "\n", ", "]).join([word] * (size // (len(word) + 1) + 12))
    if style == 5:
        return "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(size)) + "=="
    if style == 6:
        signs = "Ã©Â¿½€™ãþðøÂâ�¶§¤ "
        return "".join(r.choice(signs) for _ in range(size))
    if style == 7:
        return r.choice(["BLANK", "void", "xyz", "empty", "nodata"]) * (size // 5 + 10)
    return " ".join(str(r.randrange(10 ** r.randint(3, 9))) for _ in range(size // 7 + 6))


def _spoilt(r: random.Random, text: str) -> str:
    """Prose as it comes: odd blanks, an indented line, a tab, a far end, a cut."""
    style = r.randrange(6)
    if style == 0:
        return text.replace(". ", ".  ")
    if style == 1:
        return text + " " * r.randint(3, 60) + r.choice(["end", "page 2", "R."])
    if style == 2:
        return "\t" + text
    if style == 3:
        return "   " + text.replace(", ", " ,", 1)
    if style == 4:
        return text[: max(12, len(text) * 2 // 3)]
    return text.upper()


MAKERS = {"prose": prose, "list": items, "table": cells, "junk": noise}


def parts(n: int, seed: int = 20) -> list[tuple[str, str]]:
    """``n`` texts of one kind each, (text, kind), from a few characters to a page; half of them prose."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        kind = "prose" if i % 2 else r.choice(["list", "table", "junk", "junk"])
        size = int(10 ** r.uniform(1.1, 3.1))
        text = MAKERS[kind](r, size)
        if kind == "junk":
            text = text[: max(12, size)]
        out.append((_spoilt(r, text) if kind == "prose" and r.random() < 0.2 else text, kind))
    return out


def compose(n: int, seed: int = 20) -> list[tuple[str, str]]:
    """``n`` documents with their labels, the same for the same arguments."""
    r = random.Random(seed)
    makers = {"list": items, "table": cells, "junk": noise}
    out = []
    for _ in range(n):
        if r.random() < 0.34:
            parts = [("prose", prose(r, r.randint(60, 1500)))]
        else:
            kind, size = r.choice(list(makers)), r.randint(150, 1500)
            share = 1.0 if r.random() < 0.5 else r.choice([r.uniform(0.06, 0.44), r.uniform(0.56, 0.95)])
            parts = [(kind, makers[kind](r, int(size * share)))]
            if share < 1:
                parts.insert(r.randrange(2), ("prose", prose(r, int(size * (1 - share)))))
        count: dict[str, int] = {}
        for kind, text in parts:
            count[kind] = count.get(kind, 0) + len("".join(text.split()))
        top = max(count, key=lambda k: count[k])
        label = top if count[top] * 2 > sum(count.values()) else "prose"
        out.append((r.choice(["\n\n", "\n"]).join(t for _, t in parts), label))
    return out
