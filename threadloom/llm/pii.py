"""Personal data replaced by keyed surrogates, in DataFrame operations alone.

Entities are found by pattern, brought to a canonical form (so one entity in several spellings stays one) and given a
surrogate drawn from a keyed digest: of the same type and format, a name's part for the same gender and script. A person is
replaced part by part, so a family name alone stays the person it was. The table of all entities is drawn in rounds: what
another entity has taken, or what is a real entity, is drawn again, in a longer form once the format is crowded.
"""

from __future__ import annotations

import secrets
import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import release, spread_join, stage, unstage

#: Titles by gender.
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Signora", "Госпожа", "Κυρία", "Κα"]
MALE = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин", "Κύριος", "Κος"]
NEUTRAL = ["Dr", "Prof", "Professor", "Доктор", "Δρ"]
#: Abbreviations that are titles in capitals only where a full stop follows (MS, DR and SR are much else).
DOTTED = ["MS", "DR", "SR"]
#: Given names by script and gender for the first draws; later draws and family names are built of syllables.
GIVEN = {
    ("latin", "f"): ["Anna", "Clara", "Elena", "Emma", "Irene", "Julia", "Laura", "Lucia", "Maria", "Marta", "Nina", "Nora", "Paula", "Sara", "Sofia", "Vera"],
    ("latin", "m"): ["Adam", "Anton", "Carlo", "David", "Erik", "Felix", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Marco", "Oscar", "Paul", "Simon", "Victor"],
    ("latin", "n"): ["Alex", "Andrea", "Ariel", "Charlie", "Eden", "Jamie", "Jordan", "Kim", "Lou", "Morgan", "Noa", "Robin", "Sam", "Sasha", "Sidney", "Toni"],
    ("cyrillic", "f"): ["Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Юлия"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Иван", "Олег", "Пётр"],
    ("cyrillic", "n"): ["Женя", "Саша", "Валя", "Слава"],
}
SYLLABLES = {"latin": ["bel", "dor", "fen", "gar", "hal", "kin", "lor", "mar", "nel", "ros", "sel", "tan", "ver", "wil", "zan", "mon"], "cyrillic": ["бел", "вор", "гал", "дар", "зор", "кал", "лан", "мар", "нов", "пет", "рог", "сол", "тим", "фед", "чер", "яс"]}
#: Endings of built given names by script and gender.
ENDINGS = {("latin", "f"): ["a", "ia", "ina", "ella"], ("latin", "m"): ["o", "us", "an", "ert"], ("latin", "n"): ["e", "y", "i", "in"], ("cyrillic", "f"): ["а", "ия", "ина", "ица"], ("cyrillic", "m"): ["ий", "ан", "ор", "ей"], ("cyrillic", "n"): ["е", "и", "ю", "о"]}

_AS_WRITTEN = FEMALE + MALE + NEUTRAL
_CAPITALS = [t.upper() for t in _AS_WRITTEN if t.upper() not in DOTTED]
TITLES = "(?:" + "|".join(sorted({*_AS_WRITTEN, *_CAPITALS}, key=lambda t: (-len(t), t))) + r")\.?|(?:" + "|".join(DOTTED) + r")\."
#: A capitalised word of a name, of up to 49 characters; an apostrophe stands before a capital only (O'Brien, but Anna's is
#: Anna).
WORD = r"\p{Lu}(?:[\p{L}\p{M}]|['’](?=\p{Lu})){1,48}+(?![\p{L}\p{M}])"
#: Words joined by hyphens, and a person's name of up to five of these. One capital and a full stop may stand between them.
JOINED = rf"{WORD}(?:-{WORD}){{0,30}}"
NAME = rf"{JOINED}(?: (?:\p{{Lu}}\. )?{JOINED}){{0,4}}"
#: Patterns by type; the first that fits names the type. Each starts at the edge of a run only, and runs of characters are
#: possessive and of any length, so time grows as the text; groups that repeat are bounded (a host has up to 127 labels), as
#: the matcher's stack is.
PATTERNS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@[\p{L}\p{M}\p{N}-]++(?:\.[\p{L}\p{M}\p{N}-]++){0,125}\.\p{L}[\p{L}\p{M}]++",
    "secret": r"\b(?:[0-9a-f]{32,}+\b|AKIA[0-9A-Z]{16}\b|gh[opsu]_[A-Za-z0-9]{36,}+\b|sk-[A-Za-z0-9_-]{20,}+)",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"\+(?=(?:[ ().-]{0,2}\d){7})\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{1,4}){2,5}\b|\(\d{3}\) ?\d{3}-\d{4}\b|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d.-])",
    "card": r"(?<![\d-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\d-])",
    "person": rf"\b(?:{TITLES}) {NAME}",
}
ANY = "(?U)" + "|".join(f"(?:{p})" for p in PATTERNS.values())
#: In a document that names a person, its other capitalised words as well, each of a hyphenated name: those that are a part
#: of a name are replaced. Parts of addresses and of words that go on in small letters or digits are none.
BARE = rf"(?<![\p{{L}}\p{{M}}\p{{N}}_@.%+])(?<![^\p{{L}}\p{{M}}]-){WORD}(?![\p{{N}}_@%+]|\.[\p{{L}}\p{{N}}]|-[\p{{Ll}}\p{{N}}])"
#: Country codes of one digit, and of two; all others have three.
ONE, TWO = ["1", "7"], "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
ANY_OR_WORD = f"{ANY}|(?:{BARE})"
PERSON = f"(?U)^(?:{PATTERNS['person']})$"
DIGITS = ("ssn", "phone", "card")
#: The decimal digits of all scripts, ten after ten from 0 to 9, ASCII first; the patterns' \d is any of them.
ALL_DIGITS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Nd")
#: Letters that stand for those of a script; letters of any other script become Latin ones.
LETTERS_OF = {
    "Cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "Greek": "αβγδεζηθικλμνξοπρστυφχψω", "Arabic": "ابتثجحدرزسشصطعغفقكلمنهوي", "Hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
    "Devanagari": "कखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह", "Hiragana": "あいうえおかきくけこさしすせそたちつてと", "Katakana": "アイウエオカキクケコサシスセソタチツテト",
    "Han": "安白成大东方高国海和江金林明南平青山文新", "Hangul": "가나다라마바사아자차카타파하",
}
#: What an entity must hold, one of these, told by quicker scans than the patterns' own: most texts hold none.
MARKS, STARTS = r"[\p{Nd}@]", ["sk-", "AKIA", "gho_", "ghp_", "ghs_", "ghu_"]
LETTERS = rf"[a-f]{{32}}|(?U)\b(?=[{''.join(sorted({t[0] for t in _AS_WRITTEN + _CAPITALS}))}])(?:{TITLES}) \p{{Lu}}"
#: Draws that keep the format; each draw after these is one character, octet or syllable longer. Rounds end at the latest
#: here, where a format has grown beyond any number of entities.
KEEP, ROUNDS = 3, 64
#: The session's setting that holds the key of op4_pii.
KEY = "spark.threadloom.pii.key"


def may_hold(text: Column) -> Column:
    """A condition that every text with an entity meets."""
    out = text.rlike(MARKS)
    for s in STARTS:
        out = out | text.contains(s)
    return out | text.rlike(LETTERS)


def kind_of(mention: Column) -> Column:
    """The type of a mention, null for one whose check digits are wrong and for a bare word."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        fits = mention.rlike(f"(?U)^(?:{pattern})$")
        if kind == "card":
            fits = fits & F.call_function("luhn_check", canonical(mention, F.lit("card")))
        if kind == "iban":
            fits = fits & (mod97(canonical(mention, F.lit("iban"))) == 1)
        out = F.when(fits, F.lit(kind)).otherwise(out)
    return out


def mod97(account: Column) -> Column:
    """What an account number, its first four characters moved to the end, leaves over 97."""
    moved = F.filter(F.split(F.concat(F.substr(account, F.lit(5)), F.substring(account, 1, 4)), ""), lambda c: c != "")
    return F.aggregate(moved, F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def name_of(mention: Column) -> Column:
    return F.regexp_replace(mention, rf"(?U)^(?:{TITLES}) ", "")


def canonical(mention: Column, kind: Column) -> Column:
    """Digits alone for numbers (after the plus of a phone with a country code), no breaks for accounts, lower case for mail
    and parts of names. Numbers, accounts and network addresses are one entity in the digits of any script."""
    ascii_ = F.translate(mention, ALL_DIGITS, "0123456789" * (len(ALL_DIGITS) // 10))
    number = F.regexp_replace(ascii_, r"[^0-9]", "")
    return F.when((kind == "phone") & mention.startswith("+"), F.concat(F.lit("+"), number)).when(kind.isin(*DIGITS), number).when(kind == "iban", F.replace(ascii_, F.lit(" "), F.lit(""))).when(kind.isin("email", "given", "family"), F.lower(mention)).when(kind == "ip", ascii_).otherwise(mention)


def in_script_of(digit: Column, like: Column) -> Column:
    """An ASCII digit in the script of another digit; anything else as it is."""
    at = F.instr(F.lit(ALL_DIGITS), like) - 1
    return F.when(digit.rlike("^[0-9]$") & (at >= 0), F.substr(F.lit(ALL_DIGITS), (at - at % 10 + digit.cast("int") + 1).cast("int"), F.lit(1))).otherwise(digit)


def gender_of(mention: Column) -> Column:
    title = F.regexp_extract(mention, r"(?U)^(\p{L}+)", 1)
    both = lambda titles: [*titles, *(t.upper() for t in titles)]
    return F.when(title.isin(*both(FEMALE)), "f").when(title.isin(*both(MALE)), "m")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _bytes(seed: Column, n: Column) -> Column:
    """n pseudo-random numbers of 0 to 255 from blocks of SHA-512 of the seed."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / 64).cast("int")), lambda i: F.sha2(F.concat(seed, F.lit(":"), i.cast("string")).cast("binary"), 512))
    return F.slice(F.flatten(F.transform(blocks, lambda d: F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.conv(F.substr(d, (2 * i + 1).cast("int"), F.lit(2)), 16, 10).cast("int")))), F.lit(1), n)


def _like(c: Column, b: Column, hexadecimal: Column) -> Column:
    """A character of c's kind and script drawn by the byte b."""

    def of(alphabet: str) -> Column:
        return F.substr(F.lit(alphabet), (b % len(alphabet) + 1).cast("int"), F.lit(1))

    out = F.when(c.rlike("[0-9]"), of("0123456789")).when(c.rlike(r"\p{Nd}"), in_script_of(of("0123456789"), c)).when(c.rlike("[a-f]") & hexadecimal, of("abcdef")).when(c.rlike("[a-z]"), of("abcdefghijklmnopqrstuvwxyz")).when(c.rlike("[A-Z]"), of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    for script, letters in LETTERS_OF.items():
        out = out.when(c.rlike(rf"\p{{Is{script}}}"), of(letters))
    return out.when(c.rlike(r"\p{L}"), of("abcdefghijklmnopqrstuvwxyz")).when(c.rlike(r"\p{N}"), of("0123456789")).otherwise(c)


def _pick(values: list[str], b: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in values]), (b % len(values) + 1).cast("int"))


def surrogate(kind: Column, entity: Column, gender: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a canonical entity at the given attempt, in canonical form."""
    seed = F.concat_ws("\u0001", F.lit(key), kind, entity, attempt.cast("string"), gender)
    more = F.greatest(F.lit(0), attempt - (KEEP - 1))
    longer = F.when(kind == "email", F.concat(F.repeat(F.lit("a"), more), entity)).when(kind.isin(*DIGITS, "iban"), F.concat(entity, F.repeat(F.lit("0"), more))).when(kind.isin("secret", "given", "family"), F.concat(entity, F.repeat(F.substr(entity, F.length(entity)), more))).otherwise(entity)
    return _let(longer, lambda e: _let(_chars(e), lambda chars: _let(_bytes(seed, F.greatest(F.size(chars), F.lit(96))), lambda drawn: _drawn(kind, e, gender, more, chars, drawn))))


def _drawn(kind: Column, entity: Column, gender: Column, more: Column, chars: Column, drawn: Column) -> Column:
    hexadecimal = entity.rlike("^[0-9a-f]+$")
    # a country code, an account's country, a card's first digit, a token's prefix and a mail's top domain stay
    kept = F.when(kind == "email", F.length(entity) - F.length(F.substring_index(entity, ".", -1))).otherwise(F.lit(1 << 30))
    prefix = F.length(F.regexp_extract(entity, r"^(AKIA|gh[opsu]_|sk-)", 1))
    lead = F.when(kind == "iban", 4).when(kind == "card", 1).when(kind == "secret", prefix).when((kind == "phone") & entity.startswith("+"), 1 + F.when(F.substr(entity, F.lit(2), F.lit(1)).isin(ONE), 1).when(F.substr(entity, F.lit(2), F.lit(2)).isin(TWO), 2).otherwise(3)).otherwise(0)
    # each computed once, and not for every character
    bounds = F.struct(F.coalesce(lead, F.lit(0)).alias("lead"), kept.alias("kept"), hexadecimal.alias("hex"))
    mapped = _let(bounds, lambda b: F.array_join(F.transform(chars, lambda c, i: F.when((i < b["lead"]) | (i >= b["kept"]), c).otherwise(_like(c, drawn[i], b["hex"]))), ""))
    octets = F.array_join(F.transform(F.slice(drawn, F.lit(1), F.least(F.lit(64), 4 + more).cast("int")), lambda b: (b % 254 + 1).cast("string")), ".")
    body = F.substr(mapped, F.lit(1), F.length(mapped) - 1)
    card = F.filter(F.array(*[F.concat(body, F.lit(str(d))) for d in range(10)]), lambda n: F.call_function("luhn_check", n))[0]
    bare = F.concat(F.substring(mapped, 1, 2), F.lit("00"), F.substr(mapped, F.lit(5)))
    iban = F.concat(F.substring(mapped, 1, 2), F.lpad((98 - mod97(bare)).cast("string"), 2, "0"), F.substr(mapped, F.lit(5)))
    part = mapped
    for script, parts in SYLLABLES.items():
        written = entity.rlike(rf"\p{{Is{script.title()}}}")
        built = lambda n: F.array_join(F.transform(F.slice(drawn, F.lit(2), F.least(F.lit(64), n + more).cast("int")), lambda b: _pick(parts, b)), "")  # noqa: E731, B023
        part = F.when(written & (kind == "family"), built(3)).otherwise(part)
        for g in "fmn":
            known = F.lower(_pick(GIVEN[script, g], drawn[0]))
            named = F.when(more == 0, known).otherwise(F.concat(built(0), _pick(ENDINGS[script, g], drawn[0])))
            part = F.when(written & (kind == "given") & (F.coalesce(gender, F.lit("n")) == g), named).otherwise(part)
    return F.when(kind == "ip", octets).when(kind == "card", card).when(kind == "iban", iban).when(kind.isin("given", "family"), part).otherwise(mapped)


def formatted(mention: Column, kind: Column, canon: Column) -> Column:
    """The canonical surrogate in the mention's dress: separators, capitals, digits' script. What is longer than the mention
    stands after its last digit, before a mail's first character."""
    chars = _chars(mention)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def fill(kept: str, canon: Column = canon):
        def step(acc: Column, c: Column) -> Column:
            fits = c.rlike(kept)
            return F.struct(F.concat(acc["out"], F.when(fits, in_script_of(F.substr(canon, acc["k"] + 1, F.lit(1)), c)).otherwise(c)).alias("out"), (acc["k"] + fits.cast("int")).alias("k"))

        return F.aggregate(chars, start, step, lambda a: F.concat(a["out"], F.substr(canon, a["k"] + 1)))

    ahead = F.length(canon) - F.length(mention)
    cased = F.array_join(F.zip_with(chars, F.slice(_chars(canon), F.greatest(F.lit(0), ahead) + 1, F.size(chars)), lambda c, d: F.when(c != F.lower(c), F.upper(d)).otherwise(d)), "")
    octets = F.array_join(F.transform(F.split(canon, ""), lambda c: in_script_of(c, chars[0])), "")
    part = F.when((F.upper(mention) == mention) & (F.lower(mention) != mention), F.upper(canon)).otherwise(F.initcap(canon))
    return F.when(kind.isin(*DIGITS), fill(r"\p{Nd}", F.ltrim(canon, F.lit("+")))).when(kind == "ip", octets).when(kind == "iban", fill(r"[A-Z\p{Nd}]")).when(kind.isin("given", "family"), part).when(kind == "email", F.concat(F.substr(canon, F.lit(1), ahead), cased)).otherwise(canon)


def entity_table(mentions: DataFrame, key: str) -> DataFrame:
    """(kind, entity, gender, neutral, surrogate) of all entities: distinct within a kind, and no surrogate is a real entity
    of its kind. A name of both genders is two entities. Mentions without a gender are of the row marked neutral: the
    name's only gender, or a row of their own.

    Each round draws for the entities that are still without: of those that drew alike the first keeps it, what is taken
    or real is refused. From round KEEP on surrogates grow, so a crowded format (every one-letter address) runs out of
    entities and not of surrogates; the number of rounds follows the logarithm of the crowd."""
    per = mentions.groupBy("kind", "entity").agg(F.array_sort(F.collect_set("gender")).alias("genders"), F.bool_or(F.col("gender").isNull()).alias("bare"))
    own = F.when((F.size("genders") == 0) | ((F.size("genders") > 1) & F.col("bare")), F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>"))
    rows = per.select("kind", "entity", F.explode(F.concat("genders", own)).alias("gender"), (F.size("genders") == 1).alias("one"))
    rows = stage(rows.select("kind", "entity", "gender", (F.col("gender").isNull() | F.col("one")).alias("neutral")), "entities")
    done: list[DataFrame] = []
    pending = rows
    for attempt in range(ROUNDS):
        drawn = stage(pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("entity"), F.col("gender"), F.lit(attempt), key)), "drawn")
        taken = rows.select("kind", F.col("entity").alias("surrogate")).distinct()
        for d in done:
            taken = taken.unionByName(d.select("kind", "surrogate"))
        who = F.struct("entity", F.coalesce("gender", F.lit("")).alias("g"), "gender", "neutral")
        first = drawn.join(taken, ["kind", "surrogate"], "left_anti").groupBy("kind", "surrogate").agg(F.min(who).alias("w"))
        done.append(stage(first.select("kind", "w.entity", "w.gender", "w.neutral", "surrogate"), "assigned"))
        have = done[-1].select(F.col("kind").alias("k2"), F.col("entity").alias("e2"), F.col("gender").alias("g2"))
        left = (F.col("kind") == F.col("k2")) & (F.col("entity") == F.col("e2")) & F.col("gender").eqNullSafe(F.col("g2"))
        pending = stage(drawn.join(have, left, "left_anti").drop("surrogate"), "pending")
        unstage(drawn)
        if pending.isEmpty():
            out = done[0]
            for d in done[1:]:
                out = out.unionByName(d)
            return out
    raise ValueError("some entity has found no free surrogate")


def _titled(mentions: DataFrame) -> DataFrame:
    """(rid, pos, place, ahead, piece, kind, gender, given, family, name) of the parts of titled persons: ahead is the title
    or the break before the part. A part in the last word is of the family, the others are given. A name without a gender
    takes the one that its document tells: of the same name, or for a family name alone of the first one of it. Initials stay."""
    p = mentions.where(F.col("kind") == "person").withColumn("full", name_of(F.col("mention")))
    p = p.withColumn("title", F.substr("mention", F.lit(1), F.length("mention") - F.length("full"))).withColumn("gender", gender_of(F.col("mention")))
    p = p.withColumn("name", F.lower("full")).withColumn("words", F.regexp_extract_all("full", F.lit(f"(?U){JOINED}"), F.lit(0))).withColumn("between", F.split("full", f"(?U){JOINED}", -1))
    p = p.withColumn("family", F.lower(F.split(F.element_at("words", -1), "-")[0]))
    p = p.withColumn("given", F.when(F.size("words") > 1, F.lower(F.element_at(F.split(F.element_at("words", -2), "-"), -1))))
    told = lambda *by: F.first("gender", ignorenulls=True).over(Window.partitionBy("rid", *by).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    p = p.withColumn("of_name", told("name")).withColumn("of_family", told("family"))
    p = p.withColumn("gender", F.coalesce("gender", "of_name", F.when(F.size("words") == 1, F.col("of_family"))))
    pieces = F.flatten(F.transform("words", lambda w, i: F.transform(F.split(w, "-"), lambda x, j: F.struct(x.alias("piece"), F.when(j > 0, "-").otherwise(F.element_at("between", i + 1)).alias("before"), F.when(i == F.size("words") - 1, "family").otherwise("given").alias("kind")))))
    p = p.select("rid", "pos", "title", "gender", "given", "family", "name", F.posexplode(pieces).alias("place", "x"))
    return p.select("rid", "pos", "place", F.when(F.col("place") == 0, F.col("title")).otherwise(F.col("x.before")).alias("ahead"), "x.piece", "x.kind", "gender", "given", "family", "name")


def _bare(mentions: DataFrame, titled: DataFrame) -> DataFrame:
    """The parts of names that stand without a title in a document that tells the name: the gender is that of the person
    whose neighbouring part stands beside them, else of the first one told."""
    order = Window.partitionBy("rid").orderBy("pos")
    m = mentions.where("named").withColumn("low", F.lower("mention"))
    beside = lambda c, gap: F.when(gap.isin(" ", "-"), c)
    m = m.withColumn("left", beside(F.lag("low").over(order), F.lag("gap").over(order))).withColumn("right", beside(F.lead("low").over(order), F.col("gap")))
    m = m.where(F.col("kind").isNull() & F.col("mention").rlike(f"(?U)^{WORD}$")).select("rid", "pos", "mention", "low", "left", "right")
    pairs = titled.where("given is not null").groupBy("rid", "given", "family").agg(F.min_by("gender", "pos").alias("gender"))
    as_family = pairs.select("rid", F.col("given").alias("left"), F.col("family").alias("low"), F.lit("family").alias("k1"), F.col("gender").alias("g1"))
    as_given = pairs.select("rid", F.col("given").alias("low"), F.col("family").alias("right"), F.lit("given").alias("k2"), F.col("gender").alias("g2"))
    any_ = titled.groupBy("rid", F.lower("piece").alias("low")).agg(F.min_by(F.struct(F.col("kind").alias("k3"), F.col("gender").alias("g3")), F.struct("pos", "place")).alias("x"))
    out = m.join(any_.select("rid", "low", "x.*"), ["rid", "low"]).join(as_family, ["rid", "left", "low"], "left").join(as_given, ["rid", "low", "right"], "left")
    kind = F.coalesce("k1", "k2", "k3")
    gender = F.when(F.col("k1").isNotNull(), F.col("g1")).when(F.col("k2").isNotNull(), F.col("g2")).otherwise(F.col("g3"))
    return out.select("rid", "pos", F.lit(0).alias("place"), F.lit("").alias("ahead"), F.col("mention").alias("piece"), kind.alias("kind"), gender.alias("gender"))


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """The columns of docs with entities in text replaced, and n_entities (mentions replaced).

    The same key gives an entity the same surrogate in every document as long as the set of entities is the same; texts
    without entities come back unchanged, null ones null with 0, empty ones empty, an empty table empty. Ties and repeated
    rows: each row is replaced alike. Of docs' columns only n_entities is replaced; rows travel as one struct, so no other
    name can clash. Cards and accounts whose check digits are wrong are none, and stay. A person is told by a title; in the
    same document the parts of the name are replaced without one as well. Very long texts are scanned in time that grows
    with their length, and rebuilt from a row a mention, so a text of a million entities is a million short rows. A hot
    entity is at most three rows of the entity table; its mentions are dealt out by document before they meet it."""
    if not key:
        raise ValueError("surrogates need a key")
    spark = docs.sparkSession
    names = [c for c in docs.columns if c != "n_entities"]
    row = docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    none = F.array().cast("array<string>")
    row = row.withColumn("first", F.coalesce(F.when(may_hold(F.col("row.text")), F.regexp_extract_all("row.text", F.lit(ANY), F.lit(0))), none))
    row = row.withColumn("named", F.exists("first", lambda m: m.rlike(PERSON)))
    row = row.withColumn("found", F.when(F.col("named"), F.regexp_extract_all("row.text", F.lit(ANY_OR_WORD), F.lit(0))).otherwise(F.col("first"))).drop("first")
    row = stage(row.withColumn("hit", (F.size("found") > 0).cast("int")), "found", by="hit")
    some = row.where("hit = 1").withColumn("gaps", F.when(F.col("named"), F.split("row.text", ANY_OR_WORD, -1)).otherwise(F.split("row.text", ANY, -1)))
    mentions = some.select("rid", "named", F.posexplode(F.arrays_zip("found", F.slice("gaps", F.lit(2), F.size("found")).alias("gap"))).alias("pos", "m"))
    mentions = stage(mentions.select("rid", "named", "pos", F.col("m.found").alias("mention"), F.col("m.gap").alias("gap"), kind_of(F.col("m.found")).alias("kind")), "mentions")
    titled = stage(_titled(mentions), "titled")
    plain = mentions.where("kind <> 'person'").select("rid", "pos", F.lit(0).alias("place"), F.lit("").alias("ahead"), F.col("mention").alias("piece"), "kind", F.lit(None).cast("string").alias("gender"))
    pieces = plain.unionByName(titled.select(*plain.columns)).unionByName(_bare(mentions, titled))
    pieces = stage(pieces.withColumn("entity", canonical(F.col("piece"), F.col("kind"))), "pieces")
    table = stage(entity_table(pieces, key), "surrogates").withColumnRenamed("gender", "own")
    same = F.col("gender").eqNullSafe(F.col("own")) | (F.col("gender").isNull() & F.col("neutral"))
    new = spread_join(pieces, table, ["kind", "entity"], ["rid", "pos"]).where(same)
    new = new.select("rid", "pos", "place", F.concat("ahead", formatted(F.col("piece"), F.col("kind"), F.col("surrogate"))).alias("new"))
    new = new.groupBy("rid", "pos").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "new"))), lambda x: x["new"]), "").alias("new"))
    all_ = mentions.select("rid", "pos", "mention").join(new, ["rid", "pos"], "left")
    per = all_.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("new", "mention").alias("new")))).alias("new"), F.count("new").alias("n"))
    per = stage(per, "replaced")
    unstage(mentions, titled, pieces, table)
    release(spark)
    some = some.join(per, "rid")
    rebuilt = F.concat(F.col("gaps")[0], F.array_join(F.zip_with("new", F.slice("gaps", F.lit(2), F.size("new")), lambda n, g: F.concat(n["new"], g)), ""))
    of = lambda text, n: [*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names], n.alias("n_entities")]
    return row.where("hit = 0").select(*of(F.col("row.text"), F.lit(0).cast("long"))).unionByName(some.select(*of(rebuilt, F.col("n"))))


def session_key(spark: SparkSession) -> str:
    """The key that the session's configuration holds; without one a random key, the same for the rest of the session."""
    if not (key := spark.conf.get(KEY, "")):
        spark.conf.set(KEY, key := secrets.token_hex(32))
    return key


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs, session_key(spark)).select("doc_id", "text", "n_entities")
