"""PII surrogates, all in DataFrame expressions: detected entities become keyed, type-consistent stand-ins.

A surrogate is a function of key, kind and normalised entity alone, so that an entity has one stand-in throughout the
corpus. Distinctness is checked on the table of distinct entities: where two entities share a stand-in, or a stand-in is
somebody's real entity, all but the first take the next stand-in of their sequence, until none collide.
"""

from __future__ import annotations

import logging
import secrets

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

log = logging.getLogger(__name__)
#: The setting that holds the key.
KEY = "spark.eventframe.piiKey"
#: What is looked for. Possessive and bounded, so that a long run costs linear time.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,128}+@(?:[\p{L}\p{N}-]{1,63}+\.){1,8}\p{L}{2,24}(?!\p{L})"
NATIONAL = r"(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|\(0\d{1,4}\) ?\d{2,8}(?:[ -]\d{2,8}){0,4}|0\d{1,4}(?: \d{2,8}){1,4}"
#: A series of 13 digits or more without a plus is left to CARD; the number of digits is checked by kind_of.
PHONE = rf"(?<![\w+])\+\(?\d(?:[ ./()-]{{0,3}}+\d){{6,14}}(?!\w)|(?<![\w(+.-])(?!\d(?:[ -]?\d){{12}})(?:{NATIONAL})(?![\w-])"
CARD = r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])"
IPV4 = r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
IPV6 = r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\w:])"
MALE = r"Mr\.?|Herrn?|Monsieur|Señor|Sr\.|Don|Господин|г-н"
FEMALE = r"Mrs\.?|Ms\.?|Miss|Frau|Madame|Mme\.?|Señora|Sra\.|Señorita|Doña|Госпожа|г-жа"
EITHER = r"Dr\.?|Prof\.?"
PARTICLES = "von|van|der|den|de|del|della|di|da|dos|du|la|le|zu|zum|zur|ter|bin|ibn|al|el"
#: A word of a name: capitals, hyphens and apostrophes inside, but no possessive ending.
WORD = r"\p{Lu}\p{L}{0,30}+(?:[-'’](?!s(?!\p{L}))\p{L}{1,31}+){0,3}"
NAME = rf"(?<![\p{{L}}\p{{N}}])(?:{MALE}|{FEMALE}|{EITHER}) (?:(?:{PARTICLES}) ){{0,2}}{WORD}(?: (?:(?:{PARTICLES}) ){{0,2}}(?!(?:{MALE}|{FEMALE}|{EITHER}) ){WORD}){{0,2}}(?!\p{{L}})"
#: Words that may be a name without a title: looked up among the names that have one elsewhere. No part of an address or a number.
LONE = rf"(?!(?:{MALE}|{FEMALE}|{EITHER}) ){WORD}(?![\p{{L}}\p{{N}}@_%+]|[.+-]+[\p{{L}}\p{{N}}])"
BARE = rf"(?<![\p{{L}}\p{{N}}._%+@'’-]){LONE}(?: (?:(?:{PARTICLES}) ){{0,2}}{LONE}){{1,15}}"
#: All of them; one look at the next character rules out most places for most kinds.
ENTITY = f"(?:{EMAIL})|(?=[A-ZГг])(?:{IBAN}|{NAME})|(?=[+(0-9])(?:{SSN}|{PHONE}|{CARD}|{IPV4})"
KINDS = ("email", "iban", "ssn", "phone", "card", "ip", "name")
#: Names in these scripts are made of syllables; others keep their shape.
LETTERS = r"^\p{IsLatin}+$|^\p{IsCyrillic}+$"
#: Surrogate names end by gender; a stem is made of syllables of the name's script.
ENDINGS = {"latin": {"m": "on us er an ek as ard in".split(), "f": "a ia elle ina ette anne ea ora".split(), "n": "is en ey el yn ari ys im".split(), "l": "son ström ley mann ini ez ard ow".split()}}
ENDINGS["cyrillic"] = {"m": "ан ил ор ей ир ем им ад".split(), "f": "а ия ина ела ора ена ая уша".split(), "n": "и е ю эн ис ым ал ур".split(), "l": "ов ин ский ко ев ук ян ич".split()}
#: Where a name occurs in several roles, the first of these is its role: male, female, either, last name.
ROLES = "mfnl"
ONSETS = {"latin": "b c d f g h k l m n p r s t v w".split(), "cyrillic": "б в г д ж з к л м н п р с т ф х".split()}
VOWELS = {"latin": "a e i o u ai ea io".split(), "cyrillic": "а е и о у я ю э".split()}
#: A list of so many moved entities may be broadcast; a longer one is joined by shuffle.
BROADCAST_ROWS = 20_000


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once: expressions that use a value often would repeat it otherwise."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def by_pattern(text: Column, bare: bool, use) -> Column:
    """use(pattern) with the pattern of all entities that text may hold: without two colons in a row or eight groups of hex digits
    there is no IPv6 address, and the pattern that looks for none takes half the time."""
    tail = f"|(?:{BARE})" if bare else ""
    some = F.contains(text, F.lit("::")) | ((F.length(text) - F.length(F.replace(text, F.lit(":"), F.lit(""))) >= 7) & text.rlike("(?:[0-9A-Fa-f]{1,4}:){7}"))
    return F.when(some, use(f"{ENTITY}|(?=[0-9A-Fa-f:])(?:{IPV6}){tail}")).otherwise(use(ENTITY + tail))


def kind_of(e: Column) -> Column:
    first = lambda p: e.rlike(f"^(?:{p})$")
    digits = F.regexp_replace(e, r"\D", "")
    return (
        F.when(F.contains(e, F.lit("@")), F.lit("email"))
        .when(F.contains(e, F.lit(":")), F.when(e.rlike("[0-9]"), F.lit("ip6")))
        .when(e.rlike(f"^(?:{MALE}|{FEMALE}|{EITHER}) "), F.lit("name"))
        .when(~e.rlike("[0-9]"), F.lit("bare"))
        .when(e.rlike("^[A-Z]{2}"), F.when(iban_valid(e), F.lit("iban")))
        .when(first(r"\d{3}-\d{2}-\d{4}"), F.lit("ssn"))
        .when(e.rlike(r"^\+") | first(NATIONAL), F.when(F.length(digits).between(7, 15), F.lit("phone")))
        .when(first(r"(?:\d{1,3}\.){3}\d{1,3}"), F.when(~F.exists(F.split(e, r"\."), lambda x: x.cast("int") > 255), F.lit("ip")))
        .when(F.length(digits) >= 13, F.when(luhn(digits) == 0, F.lit("card")))
    )


def luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10 of a string of digits."""
    return F.aggregate(
        F.transform(F.split(F.reverse(digits), "(?!^)(?!$)"), lambda d, i: F.when(i % 2 == 1, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int"))), F.lit(0), lambda a, x: a + x
    ) % 10


def mod97(s: Column) -> Column:
    """IBAN characters (letters as 10 to 35), read as one number, modulo 97."""
    chars = F.transform(F.split(s, "(?!^)(?!$)"), lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(chars, F.lit(0), lambda a, x: F.when(x > 9, (a * 100 + x) % 97).otherwise((a * 10 + x) % 97))


def iban_valid(e: Column) -> Column:
    s = F.regexp_replace(e, " ", "")
    return mod97(F.concat(F.substr(s, F.lit(5)), F.substr(s, F.lit(1), F.lit(4)))) == 1


def normal(kind: Column, e: Column) -> Column:
    """What makes two mentions one entity: case for email, punctuation for numbers."""
    return F.when(kind.isin("email", "ip6"), F.lower(e)).when(kind.isin("phone", "card", "ssn", "iban"), F.regexp_replace(e, "[^0-9A-Z]", "")).otherwise(e)


def space_of(kind: Column) -> Column:
    """The kind without a name's role: what stand-ins must differ in."""
    return F.when(kind.startswith("name"), F.lit("name")).otherwise(kind)


def secret(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """256 keyed pseudo-random bits of an entity, as hex digits; the key goes first and last, nested as in HMAC."""
    return F.sha2(F.concat(F.lit(key), F.sha2(F.concat_ws("\x1f", F.lit(key), space_of(kind), norm, attempt.cast("string")), 256)), 256)


def draw(h: Column, i, n: int) -> Column:
    """A number below n from the i-th place of the hex digits h."""
    at = (F.lit(i) if isinstance(i, int) else i) * 3 % 58 + 1
    return (F.conv(F.substr(h, at, F.lit(6)), 16, 10).cast("long") + at) % n


def pick(h: Column, i, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (draw(h, i, len(values)) + 1).cast("int"))


def reshape(h: Column, s: Column) -> Column:
    """s with each digit and letter replaced by another of its script and case; the rest stays."""
    chars = F.split(s, "(?!^)(?!$)")

    def swap(c, i):
        return let(draw(h, i, 1_000_003), lambda n: replaced(c, n))

    def replaced(c, n):
        letter = lambda base, size: F.chr(n % size + base)
        other = lambda base, size: F.decode(F.unhex(F.lpad(F.hex(n % size + base), 4, "0")), "UTF-16BE")
        return (
            F.when(c.rlike("^[0-9]$"), (n % 10).cast("string"))
            .when(c.rlike(r"^[\p{IsLatin}&&\p{Lu}]$"), letter(65, 26))
            .when(c.rlike(r"^\p{IsLatin}$"), letter(97, 26))
            .when(c.rlike(r"^[\p{IsCyrillic}&&\p{Lu}]$"), other(0x410, 32))
            .when(c.rlike(r"^\p{IsCyrillic}$"), other(0x430, 32))
            .when(c.rlike(r"^[\p{IsGreek}&&\p{Lu}]$"), other(0x391, 17))
            .when(c.rlike(r"^\p{IsGreek}$"), other(0x3B1, 17))
            .when(c.rlike(r"^\p{IsHan}$"), other(0x4E00, 8000))
            .when(c.rlike(r"^[\p{IsArmenian}&&\p{Lu}]$"), other(0x531, 38))
            .when(c.rlike(r"^\p{IsArmenian}$"), other(0x561, 38))
            .when(c.rlike(r"^\p{Lu}$"), letter(65, 26))  # scripts without a range of their own get Latin letters
            .when(c.rlike(r"^\p{L}$"), letter(97, 26))
            .otherwise(c)
        )

    return F.array_join(F.transform(chars, swap), "")


def person(h: Column, role: Column, script: Column) -> Column:
    """A first name of a gender (m, f, n: either) or a last name (l) in a script."""

    def made(s: str) -> Column:
        syllable = lambda i: F.concat(pick(h, i, ONSETS[s]), pick(h, i + 1, VOWELS[s]))
        stem = F.concat(syllable(0), syllable(2), F.when(role == "l", syllable(4)).otherwise(F.lit("")), pick(h, 6, ONSETS[s]))
        end = F.when(role == "m", pick(h, 7, ENDINGS[s]["m"])).when(role == "f", pick(h, 7, ENDINGS[s]["f"])).when(role == "n", pick(h, 7, ENDINGS[s]["n"])).otherwise(pick(h, 7, ENDINGS[s]["l"]))
        return F.concat(stem, end)

    return F.when(script == "cyrillic", made("cyrillic")).otherwise(made("latin"))


def surrogate(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """The stand-in of a normalised entity, normalised likewise: the entity's attempt-th."""
    return let(secret(key, kind, norm, attempt), lambda h: drawn(h, kind, norm))


def drawn(h: Column, kind: Column, norm: Column) -> Column:
    """The stand-in that the pseudo-random digits h give."""
    n = F.length(norm)
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    host = F.substring_index(domain, ".", 1)
    email = F.concat(reshape(h, local), F.lit("@"), reshape(F.sha2(h, 256), F.rpad(host, 8, "q")), F.lit(".example."), pick(h, 9, ["com", "net", "org"]))
    body = F.concat(F.substr(norm, F.lit(1), F.lit(1)), reshape(h, F.substr(norm, F.lit(2), n - 2)))
    card = let(body, lambda x: F.concat(x, ((10 - luhn(F.concat(x, F.lit("0")))) % 10).cast("int").cast("string")))
    phone = F.concat(F.substr(norm, F.lit(1), F.lit(1)), reshape(h, F.substr(norm, F.lit(2), n - 1)))
    octet = lambda i, low, size: (draw(h, i, size) + low).cast("string")
    ip = F.concat_ws(".", octet(0, 1, 223), octet(3, 0, 256), octet(6, 0, 256), octet(9, 1, 254))
    country = F.substr(norm, F.lit(1), F.lit(2))
    check = lambda x: 98 - mod97(F.concat(x, country, F.lit("00")))
    iban = let(reshape(h, F.substr(norm, F.lit(5))), lambda x: F.concat(country, F.lpad(check(x).cast("int").cast("string"), 2, "0"), x))
    script = F.when(norm.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))
    name = person(h, F.substr(kind, F.lit(6)), script)
    hexes = F.array_join(F.transform(F.split(norm, "(?!^)(?!$)"), lambda c, i: F.when(c.rlike("^[0-9a-f]$"), F.lower(F.hex(draw(h, i, 15) + 1))).otherwise(c)), "")
    known = F.when(kind == "ip6", hexes).when(kind == "email", email).when(kind == "card", card).when(kind == "phone", phone).when(kind == "ip", ip).when(kind == "iban", iban)
    return known.when(kind.startswith("name") & norm.rlike(LETTERS), name).otherwise(reshape(h, norm))


def tokens(name: Column) -> Column:
    """Runs of letters, and what stands between them."""
    return F.regexp_extract_all(name, F.lit(r"[\p{L}\p{M}]+|[^\p{L}\p{M}]+"), F.lit(0))


def is_name(token: Column) -> Column:
    """Letters that get a stand-in: two at least, no particle."""
    return token.rlike(r"^[\p{L}\p{M}]{2,}$") & ~token.rlike(f"^(?:{PARTICLES})$")


def untitled(e: Column) -> Column:
    return F.regexp_replace(e, f"^(?:{MALE}|{FEMALE}|{EITHER}) ", "")


def windows(e: Column) -> Column:
    """(first word, words, name in lower case) of the runs of 2 to 6 words of e."""
    words = F.split(F.lower(e), " ")
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.transform(
        F.filter(F.sequence(F.lit(2), F.lit(6)), lambda n: i + n <= F.size(words)), lambda n: F.struct(i.alias("at"), n.alias("n"), F.array_join(F.slice(words, i + 1, n), " ").alias("name")))))


def units(e: Column, known=None) -> Column:
    """The units of a detected entity as (kind, norm): itself, or the parts of a name, each by its role; none if invalid.
    known gives, of windows of a mention without a title, those that are names; without it there are none."""
    return let(kind_of(e), lambda kind: parts_of(kind, e, known))


def parts_of(kind: Column, e: Column, known=None) -> Column:
    gender = F.when(e.rlike(f"^(?:{MALE}) "), F.lit("name_m")).when(e.rlike(f"^(?:{FEMALE}) "), F.lit("name_f")).otherwise(F.lit("name_n"))

    def titled(rest: Column) -> Column:
        names, last = F.filter(tokens(rest), is_name), F.size(F.filter(tokens(F.substring_index(rest, " ", -1)), is_name))
        return F.transform(names, lambda p, i: F.struct(F.when(i >= F.size(names) - last, F.lit("name_l")).otherwise(gender).alias("kind"), F.lower(p).alias("norm")))

    one = F.array(F.struct(kind.alias("kind"), normal(kind, e).alias("norm")))
    none = F.slice(one, 1, 0)
    bare = none
    if known is not None:
        bare = let(covered(known(windows(e))), lambda words: F.flatten(F.transform(
            F.split(e, " "), lambda w, i: F.when(F.array_contains(words, i), F.transform(F.filter(tokens(w), is_name), lambda p: F.struct(F.lit("name_n").alias("kind"), F.lower(p).alias("norm")))).otherwise(none))))
    return F.when(kind == "name", let(untitled(e), titled)).when(kind == "bare", bare).when(kind.isNotNull(), one).otherwise(none)


def covered(found: Column) -> Column:
    """Numbers of the words of windows."""
    return F.flatten(F.transform(found, lambda w: F.sequence(w["at"], w["at"] + w["n"] - 1)))


def cased(token: Column, new: Column) -> Column:
    """new in capitals where token is, else with a capital where token has one."""
    return F.when((F.length(token) > 1) & (token == F.upper(token)) & (token != F.lower(token)), F.upper(new)).when(token == F.lower(token), new).otherwise(F.concat(F.upper(F.substr(new, F.lit(1), F.lit(1))), F.substr(new, F.lit(2))))


def rename(name: Column, norms: Column, made: Column) -> Column:
    """name with its units, in order, replaced; letters that are no unit stay."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, t: Column) -> Column:
        mine = is_name(t) & (F.get(norms, acc["at"]) == F.lower(t))
        return F.when(mine, F.struct(F.concat(acc["out"], cased(t, F.get(made, acc["at"]))).alias("out"), (acc["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(acc["out"], t).alias("out"), acc["at"].alias("at")))

    return F.aggregate(tokens(name), start, step)["out"]


def reformat(e: Column, new: Column) -> Column:
    """The mention e with the characters of its stand-in new put in the places of its own letters and digits."""
    plain = F.split(e, "(?!^)(?!$)")
    placed = F.aggregate(
        plain,
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda acc, c: F.when(c.rlike("[0-9A-Z]"), F.struct(F.concat(acc["out"], F.substr(new, acc["at"], F.lit(1))).alias("out"), (acc["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at"))),
    )
    return placed["out"]


def recase(e: Column, new: Column) -> Column:
    """new, with capitals where the part of the address e before the @ has them."""
    local = F.split(F.substring_index(e, "@", 1), "(?!^)(?!$)")
    one = lambda i: F.substr(new, i + 1, F.lit(1))
    return F.concat(F.array_join(F.transform(local, lambda c, i: F.when(c.rlike(r"^\p{Lu}$"), F.upper(one(i))).otherwise(one(i))), ""), F.substr(new, F.size(local) + 1))


def stand_in(e: Column, kinds: Column, norms: Column, made: Column) -> Column:
    """The text that replaces mention e; kinds, norms and made: of its units."""
    k, new = F.get(kinds, 0), F.get(made, 0)
    rest = untitled(e)
    name = F.concat(F.substr(e, F.lit(1), F.length(e) - F.length(rest)), rename(rest, norms, made))
    mention = F.when(k.startswith("name"), name).when(k == "email", recase(e, new)).when(k == "ip6", F.when(e == F.lower(e), new).otherwise(F.upper(new))).when(k == "ip", new).otherwise(reformat(e, new))
    return F.when(F.size(made) == 0, e).otherwise(mention)


def spare(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """Letters in the place of a stand-in, for entities whose shape has no free one: 20 for a name, else as many as the entity has characters."""
    letters = F.translate(secret(key, kind, norm, attempt), "0123456789abcdef", "GHIJKLMNOPABCDEF")
    return F.when(kind.startswith("name"), F.lower(F.substr(letters, F.lit(1), F.lit(20)))).otherwise(F.substr(letters, F.lit(1), F.length(norm)))


def entity_table(mentions: DataFrame, key: str, rounds: int = 25) -> DataFrame:
    """The distinct units of the distinct mentions e, with stand-ins that differ from each other and from all units: kind, norm,
    attempt, made, and whether the unit occurs in several roles; it has one of them throughout."""
    unit = mentions.select(F.explode(units(F.col("e"))).alias("u")).select("u.kind", "u.norm").distinct()
    order = F.instr(F.lit(ROLES), F.substr("kind", F.lit(6), F.lit(1)))
    unit = unit.groupBy(space_of(F.col("kind")).alias("space"), "norm").agg(F.min_by("kind", F.when(F.col("kind").startswith("name"), order).otherwise(0)).alias("kind"), (F.count("*") > 1).alias("mixed"))
    at = cut(unit.withColumn("attempt", F.lit(0)).withColumn("made", surrogate(key, F.col("kind"), F.col("norm"), F.col("attempt"))))
    real = at.select(F.col("space").alias("rs"), F.col("norm").alias("rn")).distinct()
    redraw = F.when(F.col("attempt") >= rounds, spare(key, F.col("kind"), F.col("norm"), F.col("attempt"))).otherwise(surrogate(key, F.col("kind"), F.col("norm"), F.col("attempt")))
    for _ in range(2 * rounds):
        first = at.groupBy(F.col("space").alias("fs"), F.col("made").alias("fm")).agg(F.count("*").alias("n"), F.min(F.struct("attempt", "kind", "norm")).alias("first")).where("n > 1")
        met = at.join(first, (F.col("space") == F.col("fs")) & (F.col("made") == F.col("fm")), "left").join(real, (F.col("space") == F.col("rs")) & (F.col("made") == F.col("rn")), "left")
        lost = F.col("rn").isNotNull() | F.coalesce(F.col("first") != F.struct("attempt", "kind", "norm"), F.lit(False))
        step = met.select("kind", "norm", "space", "mixed", lost.alias("lost"), F.when(lost, F.col("attempt") + 1).otherwise(F.col("attempt")).alias("attempt"), "made")
        if not step.where("lost").limit(1).count():
            return at
        at = cut(step.withColumn("made", F.when(F.col("lost"), redraw).otherwise(F.col("made"))).drop("lost"))
    raise RuntimeError("surrogates still collide")


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """All columns of docs with text_col rewritten, plus n_entities and entities_<kind>: mentions replaced.

    Emails, phone numbers, valid IBANs, US social security numbers, card numbers that pass the Luhn test, IPv4 and IPv6 addresses, names after a
    title, and the same full names where they stand without one, are replaced; other numbers, and all else in the text, stay. Stand-ins keep length
    groups and punctuation of numbers, their check digits, the first digit, the country of an IBAN, and of a name the title, capitals, hyphens,
    particles and single letters, and its gender and script; stand-in emails keep capitals and lie in reserved domains. Mentions of one entity get one
    stand-in, different entities different ones, and no stand-in is an entity of the corpus. A word of a name has one role in the whole corpus: that of
    a title with a gender, if any has one. The key is the secret that all stand-ins depend on. Null texts stay null, empty ones empty.
    Columns named like the added ones are replaced by them. Repeated rows are rewritten alike.
    """
    if not key:
        raise ValueError("a key is needed")
    names = ["n_entities", *(f"entities_{k}" for k in KINDS)]
    held = docs.drop(*[c for c in names if c in docs.columns])
    all_of = lambda bare: by_pattern(F.col(text_col), bare, lambda p: F.regexp_extract_all(F.col(text_col), F.lit(p), 0))
    mentions = cut(held.select(F.explode(all_of(False)).alias("e")).distinct())
    # full names, of two words at least, that a title introduces somewhere
    full = mentions.where(kind_of(F.col("e")) == "name").select(F.lower(untitled(F.col("e"))).alias("name")).where(F.contains("name", F.lit(" "))).distinct()
    full = cut(full)
    n_full = full.count()
    every = F.col("kind").startswith("name") if n_full else F.lit(False)  # a name without a title says nothing of its roles
    moved = cut(entity_table(mentions, key).where((F.col("attempt") > 0) | F.col("mixed") | every).select("space", "norm", "made"))
    n_moved = moved.count()
    found = held.withColumn("_found", all_of(n_full > 0))
    inline = lambda u: surrogate(key, u["kind"], u["norm"], F.lit(0))
    if n_moved + n_full <= BROADCAST_ROWS:
        made, known = inline, None
        if n_moved:
            table = moved.agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "space", "norm"), "made"))).alias("_moved"))  # one row of at most BROADCAST_ROWS entries
            found = found.crossJoin(F.broadcast(table))
            made = lambda u: F.coalesce(F.element_at(F.col("_moved"), F.concat_ws("\x1f", space_of(u["kind"]), u["norm"])), inline(u))
        if n_full:
            table = full.agg(F.map_from_entries(F.collect_list(F.struct("name", F.lit(True).alias("is")))).alias("_full"))
            found = found.crossJoin(F.broadcast(table))
            known = lambda w: F.filter(w, lambda x: F.coalesce(F.element_at(F.col("_full"), x["name"]), F.lit(False)))
        each = lambda e: let(units(e, known), lambda u: F.struct(e.alias("e"), u["kind"].alias("k"), u["norm"].alias("n"), F.transform(u, made).alias("m")))
        new = lambda s: F.struct(F.get(s["k"], 0).alias("kind"), stand_in(s["e"], s["k"], s["n"], s["m"]).alias("new"))
        found = found.withColumn("_new", F.transform(F.transform("_found", each), new)).drop("_moved", "_full")
    else:
        # beyond that size: join the distinct mentions with the full names and the moved units, and the texts with their mentions, by shuffle
        mention = found.select(F.explode("_found").alias("e")).distinct()
        looked = mention.where(kind_of(F.col("e")) == "bare").select("e", F.explode(windows(F.col("e"))).alias("w"))
        hits = looked.join(full, F.col("w.name") == F.col("name"), "left_semi").groupBy(F.col("e").alias("e2")).agg(F.collect_list("w").alias("hits"))  # at most 5 for each word of a mention, which has 16
        mention = mention.join(hits, F.col("e") == F.col("e2"), "left").withColumn("u", units(F.col("e"), lambda w: F.coalesce(F.col("hits"), F.slice(w, 1, 0))))
        unit = mention.select("e", F.posexplode("u").alias("p", "x")).join(moved, (space_of(F.col("x.kind")) == F.col("space")) & (F.col("x.norm") == F.col("norm")), "left")
        unit = unit.groupBy("e").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", F.col("x.kind").alias("k"), F.col("x.norm").alias("n"), F.coalesce("made", inline(F.col("x"))).alias("m")))), lambda s: F.struct(s["k"].alias("k"), s["n"].alias("n"), s["m"].alias("m"))).alias("parts"))
        unit = unit.select("e", F.get("parts.k", 0).alias("kind"), stand_in(F.col("e"), F.col("parts.k"), F.col("parts.n"), F.col("parts.m")).alias("new"))
        texts = found.select(F.sha2(text_col, 256).alias("h"), "_found").dropDuplicates(["h"]).select("h", F.posexplode("_found").alias("p", "e"))
        texts = texts.join(unit, "e", "left").groupBy("h").agg(F.array_sort(F.collect_list(F.struct("p", F.struct("kind", F.coalesce("new", "e").alias("new")).alias("s")))).alias("l")).select(F.col("h").alias("_h"), F.col("l.s").alias("_new"))
        found = found.withColumn("_t", F.sha2(text_col, 256)).join(texts, F.col("_t") == F.col("_h"), "left").drop("_t", "_h")
    gaps = by_pattern(F.col(text_col), n_full > 0, lambda p: F.split(F.col(text_col), p, -1))
    stitched = F.array_join(F.flatten(F.zip_with(gaps, F.col("_new"), lambda g, n: F.array(g, F.coalesce(n["new"], F.lit(""))))), "")
    kept = F.filter(F.coalesce("_new", F.expr("array()")), lambda n: n["kind"].isNotNull())
    count = lambda k: F.size(F.filter(kept, lambda n: n["kind"].startswith(k)))
    out = found.withColumn("n_entities", F.size(kept))
    for k in KINDS:
        out = out.withColumn(f"entities_{k}", count(k))
    out = out.withColumn(text_col, F.when(F.size("_found") > 0, stitched).otherwise(F.col(text_col)))
    return out.select(*[c for c in held.columns], *names)


def session_key(spark) -> str:
    """The setting spark.eventframe.piiKey; where it is unset, a random key, which the session keeps, so that stand-ins agree
    within the session and nobody can work them out again."""
    key = spark.conf.get(KEY, None)
    if not key:
        log.warning("%s is not set: stand-ins of this session agree with those of no other", KEY)
        key = secrets.token_hex(32)
        spark.conf.set(KEY, key)
    return key
