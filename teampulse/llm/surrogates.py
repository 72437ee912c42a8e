"""Personal data replaced by keyed surrogates, in SQL functions only.

Entities are found by patterns: mail addresses, phone numbers, card numbers with a
right check digit, social security numbers, IPv4 addresses, secrets and names after a
title, which are then replaced wherever the same text has them or their last word.  Each gets a replacement of its own kind that keeps script, case, length and
punctuation; given names of the lists stay given names of the same gender and script.

A replacement is a keyed permutation of the values of one form, so two values never
share a replacement and one value has the same everywhere, with no table to join:
every character moves within its own class (digits, vowels, consonants, ... of its
script) by a keyed hash of the characters already written, once forwards and once
backwards, and the first one always changes.  Numbers are permuted without punctuation, so one number in two formats
keeps its identity; letters are permuted in lower case and get their case back.  The
form of an entity is kept, so that values of different forms stay apart too.

``checked`` stores its rows and then looks for collisions over all entities; it
changes the key and starts again if there is one, and fails after a few keys.  Names
that differ in hyphens and spaces only are one value.

Defined cases: NULL texts stay NULL, empty ones empty; a text without an entity stays
as it is; of overlapping patterns the first from the left counts, then the first in
the list; repeated rows are replaced alike; an empty table gives no rows; other
columns, whatever their names, are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teampulse.llm.common import plain_names, stored

KEY = "surrogates-1"
#: Keys that are tried before an error.
KEYS = 4

# Titles with their gender, given names by gender and script, classes of characters.
TITLES = ["Mr", "Mrs", "Ms", "Miss", "Sir", "Lord", "Lady", "Madam", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora", "Господин", "Госпожа", "Κύριος", "Κυρία",
          "Dr", "Doctor", "Prof", "Professor", "Mx", "Rev", "Mme", "Mlle", "Mademoiselle", "Sr", "Sra", "Srta", "Señorita", "Dra", "Доктор", "Профессор", "Δρ"]
#: Small words inside a name.
PARTICLES = ["de", "del", "della", "di", "da", "dos", "du", "la", "le", "van", "von", "der", "den", "ten", "ter", "bin", "al"]
GIVEN = [
    ["james", "john", "robert", "michael", "william", "david", "richard", "thomas", "charles", "daniel", "paul", "mark", "george", "peter", "hans", "karl", "jean", "pierre", "juan", "carlos"],
    ["mary", "patricia", "jennifer", "linda", "elizabeth", "barbara", "susan", "jessica", "sarah", "karen", "anna", "emma", "laura", "julia", "greta", "ingrid", "claire", "sophie", "maria", "carmen"],
    ["иван", "пётр", "сергей", "алексей", "дмитрий", "николай", "михаил", "андрей"],
    ["анна", "мария", "ольга", "елена", "наталья", "татьяна", "ирина", "светлана"],
    ["γιώργος", "νίκος", "δημήτρης", "κώστας", "γιάννης"],
    ["μαρία", "ελένη", "αικατερίνη", "βασιλική", "σοφία"],
]
CLASSES = [
    "0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "àáâãäåæèéêëìíîïòóôõöøùúûüœ", "çñßšžłćńśź",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "αεηιουωάέήίόύώ", "βγδζθκλμνξπρστφχψ",
]
HEX = ["0123456789abcdef"]

_W = r"\p{L}\p{N}"
_TITLE = "(?:(?:" + "|".join(TITLES) + r")\.? ){1,3}"
# possessive, so that the matcher does not recurse over long runs
_PART = r"(?:\p{Lu}['’]\p{L}[\p{L}\p{M}]*+|\p{Lu}[\p{L}\p{M}]++(?:['’]\p{Lu}[\p{L}\p{M}]*+)*+|(?:\p{Lu}\.)++(?= \p{Lu}))"
_NAME = rf"{_PART}(?:[ -](?!{_TITLE}\p{{Lu}})(?:(?:{'|'.join(PARTICLES)}) )*+{_PART})*+"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_SECRET = r"(?:api[_-]?key|access[_-]?key|token|secret|passw(?:or)?d) ?[=:] ?[\"']?"
PATTERNS = [
    rf"(?<![{_W}._%+-])[{_W}._%+-]+@(?:[{_W}-]+\.)+\p{{L}}{{2,}}",
    rf"(?<![{_W}])(?i:{_SECRET})(?=[A-Za-z+/_.-]*\d)[A-Za-z0-9+/_.-]{{8,}}",
    rf"(?<![{_W}]){_TITLE}{_NAME}",
    rf"(?<![{_W}])(?:[0-9a-f]{{32,}}|[0-9A-F]{{32,}}|AKIA[0-9A-Z]{{16}}|gh[a-z]_[A-Za-z0-9]{{36,}})(?![{_W}])",
    rf"(?<![{_W}.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[{_W}])",
    r"(?<![\p{L}\p{N}+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)",
    rf"(?<![{_W}+-])\d(?:[ -]?\d){{12,18}}(?![{_W}])",
    rf"(?<![{_W}-])\d{{3}}-\d{{2}}-\d{{4}}(?![{_W}-])",
    rf"(?<![{_W}])(?:\(\d{{3}}\) ?|\d{{3}}[ .-])\d{{3}}[ .-]\d{{4}}(?![{_W}])",
]
ENTITY = "|".join(PATTERNS)
TITLED = PATTERNS[2]
#: A cheap test that every entity passes.
CUE = rf"[@0-9]|{_TITLE}"


def _hash(key: str, text: Column) -> Column:
    return F.conv(F.substring(F.sha2(F.concat(F.lit(key), text).cast("binary"), 256), 1, 15), 16, 10).cast("long")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _pass(text: Column, key: str, classes: list[str], lead: Column, moves: bool) -> Column:
    """Moves each character within its class by a hash of what is written before it.

    The character at ``lead`` moves by one place or more if ``moves``, else it stays.
    """

    def step(out: Column, c: Column) -> Column:
        by, first = _hash(key, out), F.length(out) + 1 == lead

        def moved(k: str) -> Column:
            at = F.instr(F.lit(k), c)
            turn = F.when(first, (1 + F.pmod(by, F.lit(len(k) - 1))) if moves else F.lit(0).cast("long")).otherwise(by)
            return F.when(at > 0, F.substring(F.lit(k), F.pmod(at - 1 + turn, F.lit(len(k))).cast("int") + 1, F.lit(1)))

        return F.concat(out, F.coalesce(*map(moved, classes), c))

    return F.aggregate(_chars(text), F.lit(""), step)


def permuted(text: Column, key: str, classes: list[str] = CLASSES) -> Column:
    """A keyed permutation of the texts of one form, which leaves none as it is.

    The first character of a class changes on the way forwards and stays on the way
    back.
    """
    lead = F.regexp_instr(text, F.lit("[" + "".join(classes) + "]"))
    forwards = _pass(text, key + "/forwards", classes, lead, True)
    return F.reverse(_pass(F.reverse(forwards), key + "/backwards", classes, F.length(text) + 1 - lead, False))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _filled(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))
    step = lambda s, c: F.when(
        c.rlike(r"^\d$"), F.struct(F.concat(s["out"], F.substring(digits, s["n"] + 1, F.lit(1))).alias("out"), (s["n"] + 1).alias("n"))
    ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["n"].alias("n")))
    return F.aggregate(_chars(form), start, step, lambda s: s["out"])


def _cased(form: Column, text: Column) -> Column:
    """``text`` with upper case where ``form`` has it; both have the same length."""
    return F.array_join(F.zip_with(_chars(form), _chars(text), lambda f, c: F.when(f != F.lower(f), F.upper(c)).otherwise(c)), "")


def _check_sum(digits: Column) -> Column:
    """Sum of a card number's digits, with every second from the right doubled, modulo ten."""
    each = F.transform(F.reverse(_chars(digits)), lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10


def _word(word: Column, key: str) -> Column:
    """A name's word: a listed given name moves within its list, any other is permuted until it is no listed one."""
    listed = [F.when(F.array_contains(F.lit(names), word), F.element_at(F.lit(names), (F.pmod(F.array_position(F.lit(names), word) - 1 + shift, F.lit(len(names))) + 1).cast("int")))
              for names, shift in ((names, 1 + sum(map(ord, key)) % (len(names) - 1)) for names in GIVEN)]
    every = F.lit([n for names in GIVEN for n in names])
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(8)), permuted(word, key + "/name"), lambda w, _: F.when(F.array_contains(every, w), permuted(w, key + "/name")).otherwise(w))
    return F.coalesce(*listed, walked)


def entity(found: Column, key: str = KEY, names: Column | None = None) -> Column:
    """kind, value and surrogate in normal form, and ``out``, the replacement in the form that was found.

    ``names`` are names without a title.
    """
    known = F.lit(False) if names is None else F.array_contains(names, found)
    lower, digits = F.lower(found), _digits(found)
    part = lambda kind, value, surrogate, out: F.struct(F.lit(kind).alias("kind"), value.alias("value"), surrogate.alias("surrogate"), out.alias("out"))

    top = F.regexp_extract(lower, r"\.\p{L}+$", 0)
    mail = F.concat(permuted(F.regexp_replace(lower, r"\.\p{L}+$", ""), key + "/mail"), top)

    lead = F.regexp_extract(found, r"^([^=:]*[=:] ?[\"']?|AKIA|gh[a-z]_|)", 1)
    secret = F.substring(found, F.length(lead) + 1, F.length(found))
    plain = F.lower(secret)
    hidden = F.when(plain.rlike("^[0-9a-f]+$"), permuted(plain, key + "/hex", HEX)).otherwise(permuted(plain, key + "/secret"))
    hidden = _cased(secret, hidden)

    title = F.regexp_extract(found, "^" + _TITLE, 0)
    name = F.substring(found, F.length(title) + 1, F.length(found))
    words = F.transform(F.split(F.lower(name), "[ -]"), lambda w: _word(w, key))
    capital = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))
    shown = F.zip_with(F.split(name, "[ -]"), words, lambda f, w: F.when(F.length(f) == F.length(w), _cased(f, w)).otherwise(capital(w)))
    gaps = F.split(name, r"[^ -]+")
    named = F.array_join(F.transform(shown, lambda w, i: F.concat(F.get(gaps, i), w)), "")

    bytes_ = F.transform(F.split(found, r"\."), lambda x: x.cast("int"))

    def turned(of: Column, way: str) -> Column:
        def step(out: Column, b: Column) -> Column:
            by, n = _hash(f"{key}/ip/{way}", F.array_join(out.cast("array<string>"), ".")), F.size(out)
            by = F.when(n == 0, 1 + F.pmod(by, F.lit(255))).otherwise(by) if way == "forwards" else F.when(n == 3, F.lit(0).cast("long")).otherwise(by)
            return F.concat(out, F.array(F.pmod(b + by, F.lit(256)).cast("int")))

        return F.aggregate(of, F.array().cast("array<int>"), step)

    address = F.array_join(F.reverse(turned(F.reverse(turned(bytes_, "forwards")), "backwards")).cast("array<string>"), ".")

    body = permuted(F.substring(digits, F.lit(1), F.length(digits) - 1), key + "/card")
    card = F.concat(body, F.pmod(F.lit(0) - _check_sum(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))

    country = F.regexp_extract(found, r"^\+\d{1,3}(?=[ .(-])|^", 0)
    rest = F.substring(found, F.length(country) + 1, F.length(found))
    number = permuted(_digits(rest), key + "/number")
    phone = F.concat(country, _filled(rest, number))

    return (
        F.when(found.contains("@"), part("mail", lower, mail, _cased(found, mail)))
        .when((title != "") | known, part("name", F.array_join(F.split(F.lower(name), "[ -]"), " "), F.array_join(words, " "), F.concat(title, named)))
        .when(found.rlike(r"^\d+\.\d+\.\d+\.\d+$"), part("ip", found, address, address))
        .when(found.rlike(r"^\+|^\(|^\d{3}[ .-]\d{3}[ .-]\d{4}$"), part("phone", _digits(rest), number, phone))
        .when(found.rlike(r"^\d{3}-\d{2}-\d{4}$"), part("ssn", digits, permuted(digits, key + "/ssn"), _filled(found, permuted(digits, key + "/ssn"))))
        .when(~found.rlike(r"^\d(?:[ -]?\d)+$"), part("secret", secret, hidden, F.concat(lead, hidden)))
        .when(_check_sum(digits) == 0, part("card", digits, card, _filled(found, card)))
        .otherwise(part(None, found, found, found))
    )


def mentioned(text: Column) -> Column:
    """The names that have a title somewhere in the text, whole and their last words, longest first."""
    titled = F.regexp_extract_all(text, F.lit(TITLED), F.lit(0))
    whole = F.transform(titled, lambda m: F.regexp_replace(m, "^" + _TITLE, ""))
    last = F.transform(whole, lambda n: F.regexp_extract(n, "[^ -]+$", 0))
    sized = F.transform(F.array_distinct(F.concat(whole, last)), lambda n: F.struct(F.length(n).alias("size"), n.alias("name")))
    return F.transform(F.sort_array(sized, asc=False), lambda s: s["name"])


def replaced_text(docs: DataFrame, text: str, key: str = KEY) -> DataFrame:
    """All columns of ``docs`` with ``text`` replaced, and an array column ``entities`` of what was found.

    The pieces between matches and the matches come from one pattern, so they alternate.
    """
    hit = F.coalesce(F.col(text).rlike(CUE), F.lit(False))
    none = F.array().cast("array<string>")
    cut = docs.withColumn("known", F.when(F.coalesce(F.col(text).rlike(_TITLE), F.lit(False)), mentioned(F.col(text))).otherwise(none))
    untitled = F.array_join(F.transform("known", lambda n: F.concat(F.lit("\\Q"), n, F.lit("\\E"))), "|")
    pattern = F.concat(F.lit(rf"{ENTITY}|(?<![{_W}])(?:"), untitled, F.lit(rf")(?![{_W}])"))
    cut = cut.withColumn("pattern", F.when(F.size("known") > 0, pattern).otherwise(F.lit(ENTITY)))
    cut = cut.withColumn("found", F.when(hit, F.regexp_extract_all(F.col(text), F.col("pattern"), F.lit(0))).otherwise(none))
    pieces = F.when(F.size("found") > 0, F.split(F.col(text), F.col("pattern"), -1)).otherwise(none)
    cut = cut.withColumn("pieces", pieces)
    cut = cut.withColumn("found", F.transform("found", lambda m: entity(m, key, F.col("known"))))
    rest = F.transform("found", lambda e, i: F.concat(e["out"], F.get("pieces", i + 1)))
    cut = cut.withColumn(text, F.when(F.size("found") > 0, F.concat(F.get("pieces", F.lit(0)), F.array_join(rest, ""))).otherwise(F.col(text)))
    return cut.withColumn("entities", F.filter("found", lambda e: e["kind"].isNotNull())).drop("found", "pieces", "known", "pattern")


def collisions(found: DataFrame) -> DataFrame:
    """kind, surrogate of every surrogate that stands for two values or more."""
    each = found.select(F.explode("entities").alias("e")).select("e.kind", "e.value", "e.surrogate").distinct()
    return each.groupBy("kind", "surrogate").agg(F.count("*").alias("n")).where("n > 1").select("kind", "surrogate")


def checked(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """Columns ``c0``, ``c1``, ... of ``docs`` with ``text`` replaced, and ``entities``, stored and checked for collisions."""
    own, names = plain_names(docs)
    for _ in range(KEYS):
        out = stored(replaced_text(own, own.columns[names.index(text)], key), "surrogates")
        if collisions(out).isEmpty():
            return out
        key += "+"
    raise RuntimeError(f"surrogates collide under {KEYS} keys")


def replaced(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced."""
    return checked(docs, text, key).drop("entities").toDF(*docs.columns)
