"""Surrogates for personal data and secrets.

Entities found in a text are replaced by made-up ones of the same kind: keyed (the
replacement follows from key, kind and the entity's letters and digits, whatever
separators they are written with, so a mention means the same entity everywhere), of the
same format (separators, letter case, digit counts, check digits, prefixes that tell the
kind) and script (each letter is drawn from its own alphabet), and, for titled names, of
the gender that the title tells.

Different entities must stay different: replacements of all distinct entities are
compared over the whole corpus, and where two meet, or one is itself an entity of the
corpus, all but one are drawn again until none do.  DataFrame functions only.

A null text stays null and has no entities; an empty text stays empty; rows that repeat
get the same result; an empty table gives no rows; other columns are passed on by
``replace_entities``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import fresh, kept, nullable_key

#: Titles by gender (fixed values).
MALE = "Mr|Sir|Herr|Monsieur|Señor|Sr|Don"
FEMALE = "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Srta|Doña"
OTHER = "Mx|Dr|Prof"
#: First names by gender (fixed values).
NAMES = {
    "m": "Adam Boris Carl David Emil Felix Georg Henry Ivan Jonas Karim Louis Martin Noah Oscar Paul Ralph Simon Thomas Victor".split(),
    "f": "Alice Bella Clara Diana Emma Flora Greta Helen Irene Julia Karin Laura Maria Nora Olivia Petra Ruth Sofia Teresa Vera".split(),
    "o": "Alex Andrea Blake Casey Charlie Dana Eden Finley Jamie Jordan Kim Lee Morgan Noel Pat Quinn Robin Sam Sasha Taylor".split(),
}
#: Syllables of made-up surnames (fixed values).
SYLLABLES = ("ba be bor dal den dor fal fen gar gol hal hel jor kal ken lar len lin mar mel mor nar nel nor pal per ran rel "
             "ros san sel sor tal tel tor van ver vil wen zan").split()
#: A secret's value.  With fewer letters and digits there may be too few others to draw a distinct one from.
SECRET = r"(?=(?:[+/_.\-!@#$%^*?~=]*[0-9A-Za-z]){4})[0-9A-Za-z+/_.\-!@#$%^*?~=]{6,}"
#: Kinds in the order in which they are tried at a place.  What a secret's keyword has before it
#: (access_token, DB_PASSWORD) is no part of the entity.
PATTERNS = {
    "aws_key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "secret": rf"""(?i:(?:password|passwd|pwd|token|secret(?:[_-]?(?:access[_-]?)?key)?|api[_-]?key)\b["']?[ ]?[=:][ ]?["']?{SECRET}["']?)""",
    "email": r"[0-9\p{L}][0-9\p{L}._%+\-]*@[0-9\p{L}](?:[0-9\p{L}\-]*[0-9\p{L}])?(?:\.[0-9\p{L}](?:[0-9\p{L}\-]*[0-9\p{L}])?)+",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){3,7}(?:[ ]?[A-Z0-9]{1,3})?\b(?<=[0-9][ A-Z0-9]{0,8})",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .\-]?\(?[0-9]{1,4}\)?(?:[ .\-]?[0-9]{2,4}){2,4}|\([0-9]{3}\)[ .\-]?[0-9]{3}[ .\-][0-9]{4}|[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4})(?![0-9])",
    "card": r"(?<![0-9\-])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9\-])",
    "name": rf"\b(?:{MALE}|{FEMALE}|{OTHER})\.?[ ]\p{{Lu}}[\p{{L}}'’]+(?:[ \-]\p{{Lu}}[\p{{L}}'’]+){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without any of this has no entity.
HINT = rf"[0-9@]|AKIA|ASIA|(?i:password|passwd|pwd|token|secret|key)|\b(?:{MALE}|{FEMALE}|{OTHER})\b"
#: Alphabets whose letters are drawn from themselves: first and last code point.
ALPHABETS = [(0x30, 0x39), (0x61, 0x7A), (0x41, 0x5A), (0xE0, 0xF6), (0xC0, 0xD6), (0x3B1, 0x3C9), (0x391, 0x3A1),
             (0x430, 0x44F), (0x410, 0x42F), (0x5D0, 0x5EA), (0x627, 0x64A), (0x904, 0x939), (0x3041, 0x3096),
             (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def entities(text: str | Column) -> Column:
    """Entities of a text in order, as written."""
    t = F.col(text) if isinstance(text, str) else text
    return F.when(t.rlike(HINT), F.regexp_extract_all(t, F.lit(ANY), 0)).otherwise(F.array().cast("array<string>"))


def kind_of(entity: Column) -> Column:
    return reduce(lambda rest, k: F.when(entity.rlike(f"^(?:{PATTERNS[k]})$"), k).otherwise(rest), reversed(PATTERNS), F.lit("card"))


def _core(entity: Column, kind: Column) -> Column:
    """What identifies an entity: its letters and digits in lower case, without the words that name the kind."""
    value = (F.when(kind == "secret", F.regexp_replace(entity, r"""(?i)^[a-z_\-]+["']?[ ]?[=:][ ]?""", ""))
             .when(kind == "name", F.regexp_replace(entity, r"^\p{L}+\.?[ ]", "")).otherwise(entity))
    return F.when(kind.isin("secret", "aws_key"), F.regexp_replace(value, r"[\"']", "")).otherwise(
        F.lower(F.regexp_replace(value, r"[^0-9\p{L}@]|(?<=@.{0,200})-", "")))


def _stream(kind: Column, core: Column, key: str, attempt: Column) -> Column:
    """256 keyed bytes as hex."""
    part = lambda i: F.sha2(F.concat_ws("|", F.lit(key), F.lit(str(i)), attempt.cast("string"), kind, core), 512)
    return F.concat(*[part(i) for i in range(4)])


def _byte(stream: Column, i: Column, width: int = 4) -> Column:
    at = F.pmod(i, F.lit(120)) * width + 1
    return F.conv(F.substr(stream, at.cast("int"), F.lit(width)), 16, 10).cast("int")


def _redrawn(text: Column, keep: Column, stream: Column, hexadecimal: Column) -> Column:
    """Letters and digits after the first ``keep`` characters drawn anew, each from its own alphabet."""
    def letter(state: Column, ch: Column, code: Column, draw: Column) -> Column:
        new = F.when(hexadecimal & ch.between("a", "f"), _char(F.lit(97) + F.pmod(draw, F.lit(6))))
        new = new.when(hexadecimal & ch.between("A", "F"), _char(F.lit(65) + F.pmod(draw, F.lit(6))))
        for first, last in ALPHABETS:
            new = new.when(code.between(first, last), _char(F.lit(first) + F.pmod(draw, F.lit(last - first + 1))))
        return F.struct((state["seen"] + 1).alias("seen"),
                        (state["drawn"] + F.when(code < 0x2E80, F.when(ch.rlike(r"[0-9\p{L}]"), 1).otherwise(0)).otherwise(1)).alias("drawn"),
                        F.concat(state["out"], F.when(state["seen"] < keep, ch).otherwise(F.coalesce(new, ch))).alias("out"))

    def one(state: Column, ch: Column) -> Column:
        return _let(F.ascii(ch), lambda code: _let(_byte(stream, state["drawn"]), lambda draw: letter(state, ch, code, draw)))

    start = F.struct(F.lit(0).alias("seen"), F.lit(0).alias("drawn"), F.lit("").alias("out"))
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), start, one)["out"]


def _char(code: Column) -> Column:
    """A character by code point; char() alone stops at 255."""
    return F.when(code < 128, F.char(code)).otherwise(
        F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def _ip(entity: Column, stream: Column) -> Column:
    """Octets of the same digit counts."""
    octet = lambda x, i: (F.when(F.length(x) == 3, 100 + F.pmod(_byte(stream, i), F.lit(156)))
                          .when(F.length(x) == 2, 10 + F.pmod(_byte(stream, i), F.lit(90)))
                          .otherwise(F.pmod(_byte(stream, i), F.lit(10)))).cast("string")
    return F.array_join(F.transform(F.split(entity, r"\."), octet), ".")


def _luhn(digits: Column, doubled_from: int) -> Column:
    """Sum of digits from the right, every second doubled, starting with the first if ``doubled_from`` is 0."""
    d = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c: c.cast("int"))
    worth = F.transform(d, lambda x, i: F.when(F.pmod(i, F.lit(2)) == doubled_from, F.when(x > 4, 2 * x - 9).otherwise(2 * x)).otherwise(x))
    return F.aggregate(worth, F.lit(0), lambda s, x: s + x)


def _card(entity: Column, stream: Column) -> Column:
    """First digit and separators kept; valid check digits stay valid."""
    drawn = _redrawn(entity, F.lit(1), stream, F.lit(False))
    digits = F.regexp_replace(drawn, "[^0-9]", "")
    body = digits.substr(F.lit(1), F.length(digits) - 1)
    check = F.pmod(10 - F.pmod(_luhn(body, 0), F.lit(10)), F.lit(10)).cast("string")
    valid = F.pmod(_luhn(F.regexp_replace(entity, "[^0-9]", ""), 1), F.lit(10)) == 0
    return F.when(valid, F.concat(drawn.substr(F.lit(1), F.length(drawn) - 1), check)).otherwise(drawn)


def _name(entity: Column, stream: Column) -> Column:
    """Title kept; first names by its gender, the last word a made-up surname; letter case as it was.
    Names in other scripts than Latin are redrawn letter by letter."""
    title = F.regexp_extract(entity, r"^(\p{L}+)\.?[ ]", 1)
    lead = F.regexp_extract(entity, r"^\p{L}+\.?[ ]", 0)
    rest = F.regexp_replace(entity, r"^\p{L}+\.?[ ]", "")
    gender = F.when(title.isin(*MALE.split("|")), "m").when(title.isin(*FEMALE.split("|")), "f").otherwise("o")
    pick = lambda words, i: F.element_at(F.array(*map(F.lit, words)), F.pmod(_byte(stream, i), F.lit(len(words))) + 1)
    surname = F.initcap(F.concat(*[pick(SYLLABLES, F.lit(40 + i)) for i in range(4)]))
    words = F.split(rest, r"[ \-]")
    gaps = F.regexp_extract_all(rest, F.lit(r"[ \-]"), 0)
    given = lambda i: (F.when(gender == "m", pick(NAMES["m"], i)).when(gender == "f", pick(NAMES["f"], i))
                       .otherwise(pick(NAMES["o"], i)))
    new = F.transform(words, lambda w, i: F.concat(
        F.when(i == 0, "").otherwise(F.get(gaps, i - 1)),
        F.when((F.upper(w) == w) & (F.length(w) > 1), F.upper(F.when(i == F.size(words) - 1, surname).otherwise(given(i))))
        .otherwise(F.when(i == F.size(words) - 1, surname).otherwise(given(i)))))
    latin = rest.rlike(r"^[\p{IsLatin} \-'’]+$")
    return F.concat(lead, F.when(latin, F.array_join(new, "")).otherwise(_redrawn(rest, F.lit(0), stream, F.lit(False))))


def surrogate(entity: Column, key: str, attempt: Column) -> Column:
    """The replacement of an entity in a given draw."""
    def drawn(kind: Column, s: Column) -> Column:
        lead = (F.when(kind == "aws_key", 4)
                .when(kind == "secret", F.length(F.regexp_extract(entity, r"""(?i)^[a-z_\-]+["']?[ ]?[=:][ ]?["']?""", 0)))
                .when(kind == "phone", F.length(F.regexp_extract(entity, r"^(?:\+[0-9]{1,3}(?=[^0-9])|\+[0-9])?", 0)))
                .when(kind == "iban", 2).otherwise(0))
        hexadecimal = (kind == "secret") & entity.rlike(r"""[=:][ ]?["']?[0-9a-fA-F]+["']?$""")
        tail = F.when(kind == "email", F.regexp_extract(entity, r"\.[^.@]*$", 0)).otherwise("")
        plain = F.concat(_redrawn(F.substr(entity, F.lit(1), F.length(entity) - F.length(tail)), lead, s, hexadecimal), tail)
        return (F.when(kind == "ip", _ip(entity, s)).when(kind == "card", _card(entity, s))
                .when(kind == "name", _name(entity, s)).otherwise(plain))

    return _let(kind_of(entity), lambda kind: _let(
        _stream(kind, _core(entity, kind), key, attempt), lambda s: drawn(kind, s)))


def _replaced(text: Column, found: Column, new: Column) -> Column:
    """The text with its entities, in order, replaced by ``new``."""
    between = F.split(text, ANY, -1)
    woven = F.zip_with(between, F.concat(new, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    return F.when(F.size(found) > 0, F.array_join(woven, "")).otherwise(text)


def draws(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``entity``, ``attempt`` of the entities whose first draw met another: few or none.

    One narrow row per distinct entity is compared, found by a grouping that folds
    repeats in the map task.  The replacement of one of several that meet stays; one that
    is an entity of the corpus itself goes.
    """
    seen = kept(docs.select(F.explode(entities(text_col)).alias("entity")).groupBy("entity").count().select("entity"))
    identity = lambda c: F.concat_ws("|", kind_of(c), _core(c, kind_of(c)))
    known = kept(seen.select("entity", identity(F.col("entity")).alias("who")).groupBy("who").agg(F.min("entity").alias("entity")))
    state = known.select("who", "entity", F.lit(0).alias("attempt"))
    moved = None
    while True:
        drawn = kept(state.withColumn("new", surrogate(F.col("entity"), key, F.col("attempt")))
                     .withColumn("as", identity(F.col("new"))))
        taken = known.select(F.col("who").alias("as"), F.lit(True).alias("taken"))
        groups = drawn.groupBy("as").agg(F.min("who").alias("first"), F.count(F.lit(1)).alias("n"))
        clash = kept(drawn.join(groups, "as").join(taken, "as", "left")
                     .filter(((F.col("n") > 1) & (F.col("who") != F.col("first"))) | F.col("taken"))
                     .select("who"))
        if clash.isEmpty():
            break
        state = kept(drawn.join(clash.withColumn("again", F.lit(1)), "who", "left")
                     .select("who", "entity", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt")))
        moved = state
    if moved is None:
        return seen.limit(0).select("entity", F.lit(0).alias("attempt"))
    again = moved.filter("attempt > 0").select("who", "attempt")
    return kept(seen.select("entity", identity(F.col("entity")).alias("who")).join(again, "who").select("entity", "attempt"))


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` replaced, and ``entities`` and ``surrogates`` of each text in order (in place
    of columns of these names).

    Replacements are computed beside the text; only texts that hold an entity that was
    drawn again meet a table.
    """
    moved = draws(docs, key, text_col)
    found = docs.withColumn("entities", entities(f"`{text_col}`"))
    first = lambda e: surrogate(e, key, F.lit(0))
    if moved.isEmpty():
        d = found.withColumn("surrogates", F.transform("entities", first))
        return d.withColumn(text_col, _replaced(F.col(f"`{text_col}`"), F.col("entities"), F.col("surrogates")))
    k, th, redrawn = fresh(found, "k", "th", "redrawn")
    keyed = found.withColumn(k, nullable_key(f"`{id_col}`")).withColumn(th, F.xxhash64(f"`{text_col}`"))
    again = (keyed.select(k, th, F.explode("entities").alias("entity")).distinct().join(moved, "entity")
             .groupBy(k, th).agg(F.map_from_entries(F.collect_list(F.struct(
                 "entity", surrogate(F.col("entity"), key, F.col("attempt")).alias("new")))).alias(redrawn)))
    d = keyed.join(kept(again), [k, th], "left").withColumn(
        "surrogates", F.transform("entities", lambda e: F.coalesce(F.col(redrawn)[e], first(e))))
    return (d.withColumn(text_col, _replaced(F.col(f"`{text_col}`"), F.col("entities"), F.col("surrogates")))
            .drop(k, th, redrawn))
