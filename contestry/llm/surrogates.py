"""Personal data replaced by keyed surrogates.

Found are e-mail addresses, IP addresses, card numbers and IBANs whose check digits hold, phone numbers,
secrets (the value after a word like token or password), names after a title, and the surnames of such
names wherever else their text has them as words. A surrogate keeps the type and the format: digits
stand for digits and letters for letters of their script, separators stay, check digits hold, names keep
their title, script, hyphens and gender ending. It is a hash of a key, the type and the entity's
canonical form, so one entity has one surrogate throughout the corpus, however it is written
(coreference). The parts of a name are entities of their own: a surname has one surrogate in all names.

Collision checks: the corpus' distinct entities are collected as a table; where two of a type would
share a surrogate, or a surrogate is itself an entity of the corpus, all but the least are drawn again
until none is left. From the fourth draw on the format widens by a character a draw, so that also a
format whose forms are all taken is left in the end. Only entities drawn again are looked up while texts
are rewritten; the others follow from their hash alone.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, unused, written

KEY = "surrogate-key-1"
#: Most pairs of a text and a redrawn entity in it that a join may broadcast.
REDRAWN = 200_000
#: Draws that keep the exact format.
EXACT = 3

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_%+-]++(?:\.[\p{L}\p{N}_%+-]++)*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IP = rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?![\d]|\.\d)"
HEX = "[0-9A-Fa-f]{1,4}"
IPV6 = rf"(?<![\p{{L}}\p{{N}}:])(?:(?:{HEX}:){{7}}{HEX}|(?:{HEX}:){{2,6}}(?::{HEX}){{1,5}}|{HEX}:(?::{HEX}){{2,6}}|(?:{HEX}:){{3,7}}:)(?![\p{{L}}\p{{N}}:])"
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
#: Usual groups of a card's digits come before any others, so that digits beside it don't hide it.
CARD_GROUPS = r"(?<![\d-])(?:\d{13,19}|\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})(?!\d)"
CARD = r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])"
PHONE = r"(?<![\d\p{L}])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:(?:[ .-]?\d{2}){4}|(?:[ .-]?\d{3,4}){2})|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)"
SECRET_HEAD = r"(?i:\b(?:token|password|passwd|secret|api_key)) ?[=:] ?[\"']?"
SECRET = SECRET_HEAD + r"[A-Za-z0-9_/+-]{8,}+"
TITLES_F = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Mme", "Mlle", "Madame", "Sra", "Srta", "Señora", "Госпожа", "Κυρία"]
TITLES_M = ["Mr", "Sir", "Herr", "Monsieur", "Sr", "Señor", "Господин", "Κύριος"]
EAST = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}"
PART = r"\p{Lu}[\p{L}'’-]*\p{L}"
NAME = rf"(?<!\p{{L}})(?:{'|'.join([*TITLES_F, *TITLES_M])})\.? (?:{PART}(?: {PART})?|[{EAST}]{{1,6}})"
#: None begins with white space, and after a letter of A-Z only those that begin with a digit: most places are passed over by that.
ENTITY = rf"(?!\s)(?:(?=\d)|(?<![A-Za-z]))(?:{'|'.join([EMAIL, SECRET, IP, IPV6, IBAN, CARD_GROUPS, CARD, PHONE, NAME])})"
#: What a stretch whose check digits fail may still hold.
WITHIN = f"{CARD_GROUPS}|{PHONE}"
#: What every entity has one of, plain or by pattern: texts without it are passed over. Titles in ASCII are few first letters.
PLAIN = ["@", *"0123456789", *[t for t in [*TITLES_F, *TITLES_M] if not t[0].isascii()]]
TITLES = [t for t in [*TITLES_F, *TITLES_M] if t[0].isascii()]
HINT = (
    rf"(?=[:tTpPsSaA{''.join(sorted({t[0] for t in TITLES}))}])"
    rf"(?::[0-9A-Fa-f]{{0,4}}:|(?<![A-Za-z])(?:(?i:token|passw|secret|api_key)|(?:{'|'.join(TITLES)})[. ]))"
)

# The letters of the scripts, syllables of surrogate names, and their endings.
LETTERS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "cyrillic": "абвгдежзийклмнопрстуфхцчшщэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "east": "安白成东芳国海华江金立林美明宁青山水文星雅英玉志",
}
SCRIPTS = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}", "east": f"[{EAST}]"}
SYLLABLES = {
    "latin": ["ba", "de", "fi", "go", "ha", "ju", "ka", "le", "mi", "no", "pa", "re", "sa", "ti", "va", "zo", "lan", "ber", "mon", "tor"],
    "cyrillic": ["ба", "ве", "ги", "до", "жа", "зе", "ки", "ло", "ма", "не", "па", "ро", "са", "ти", "фе", "ха", "лан", "бер", "мон", "тор"],
    "greek": ["βα", "γε", "δι", "κο", "λα", "με", "νι", "πο", "ρα", "σε", "τι", "φο", "χα", "ζε", "θι", "ξο", "λαν", "περ", "μον", "τορ"],
    "east": list("安白成东芳国海华江金立林美明宁青山水文星"),
}
ENDINGS = {"latin": ("na", "ro"), "cyrillic": ("на", "ро"), "greek": ("να", "ρο"), "east": ("", "")}
DIGITS, HEXES = "0123456789", "0123456789abcdef"
PARTS = ["surname", "given f", "given m"]


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a string of digits, modulo 10."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    weighed = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d)))
    return F.aggregate(weighed, F.lit(0), lambda a, b: a + b) % 10


def mod97(code: Column) -> Column:
    """An IBAN's number (four first characters last, letters as 10 to 35) modulo 97."""
    turned = F.concat(F.substr(code, F.lit(5), F.length(code)), F.substr(code, F.lit(1), F.lit(4)))
    step = lambda a, c: F.when(c.rlike(r"\d"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def kind_of(entity: Column) -> Column:
    digits = F.regexp_replace(entity, r"[ -]", "")
    return (
        F.when(F.contains(entity, F.lit("@")), "email")
        .when(entity.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), "ip")
        .when(entity.rlike(f"^{IPV6}$"), "ipv6")
        .when(entity.rlike(r"^[A-Z]{2}\d{2}[ A-Z0-9]{8,}$"), F.when(mod97(F.replace(entity, F.lit(" "), F.lit(""))) == 1, "iban").otherwise("none"))
        .when(entity.rlike(r"^\d[\d -]{11,}\d$") & digits.rlike(r"^\d{13,19}$"), F.when(luhn_sum(digits) == 0, "card").otherwise("none"))
        .when(entity.rlike(rf"^{NAME}$"), "name")
        .when(entity.rlike(rf"^{SECRET_HEAD}"), "secret")
        .otherwise("phone")
    )


def canonical(kind: Column, entity: Column) -> Column:
    """One form for all ways to write an entity."""
    return (
        F.when(kind.isin("card", "phone"), F.regexp_replace(entity, r"\D", ""))
        .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
        .when(kind.isin("email", "ipv6", *PARTS), F.lower(entity))
        .when(kind == "secret", F.regexp_replace(entity, f"^{SECRET_HEAD}", ""))
        .otherwise(entity)
    )


def draws(kind: Column, canon: Column, turn: Column) -> Column:
    """128 hexadecimal digits of an entity's random bits."""
    seed = F.concat_ws("\u0001", F.lit(KEY), kind, canon, turn.cast("string"))
    return F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("\u0001more")), 256))


def pick(bits: Column, i: Column, n: int) -> Column:
    """The i-th draw from 0 to n - 1; draws beyond the 60th start anew, shifted."""
    at = F.pmod(i * 2 + F.floor(i / 60), F.lit(120)) + 1
    return F.pmod(F.conv(F.substr(bits, at.cast("int"), F.lit(6)), 16, 10).cast("long") + i, F.lit(n))


def letter(bits: Column, i: Column, alphabet: str) -> Column:
    return F.substr(F.lit(alphabet), (pick(bits, i, len(alphabet)) + 1).cast("int"), F.lit(1))


def like_format(entity: Column, bits: Column) -> Column:
    """Digits for digits, letters for letters of their script and case; drawn by the place among the letters and digits."""
    chars = F.split(entity, "")

    def step(state: Column, c: Column) -> Column:
        drawn = F.when(c.rlike(SCRIPTS["cyrillic"]), letter(bits, state["i"], LETTERS["cyrillic"]))
        for script in ("greek", "east"):
            drawn = drawn.when(c.rlike(SCRIPTS[script]), letter(bits, state["i"], LETTERS[script]))
        drawn = F.when(c.rlike("[A-Za-z]"), letter(bits, state["i"], LETTERS["latin"])).otherwise(drawn.otherwise(letter(bits, state["i"], LETTERS["latin"])))
        new = F.when(c.rlike(r"\d"), letter(bits, state["i"], DIGITS)).when(c.rlike(r"\p{Lu}"), F.upper(drawn)).when(c.rlike(r"\p{L}"), drawn).otherwise(c)
        return F.struct((state["i"] + c.rlike(r"[\p{L}\p{N}]").cast("long")).alias("i"), F.concat(state["s"], new).alias("s"))

    return F.aggregate(chars, F.struct(F.lit(0).cast("long").alias("i"), F.lit("").alias("s")), step)["s"]


def hexes(n: Column, bits: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: letter(bits, i.cast("long"), HEXES)), "")


def more(mark: str, turn: Column) -> Column:
    """What widens a format after EXACT draws."""
    return F.repeat(F.lit(mark), F.greatest(turn - EXACT, F.lit(0)))


def email_surrogate(entity: Column, bits: Column, turn: Column) -> Column:
    """Local part and domain are drawn; the last label of the domain stays."""
    tail = F.regexp_extract(entity, r"(\.[^.@]+)$", 1)
    local = F.concat(more("x", turn), F.substr(entity, F.lit(1), F.length(entity) - F.length(tail)))
    return F.concat(like_format(local, bits), tail)


def card_surrogate(entity: Column, bits: Column, turn: Column) -> Column:
    """Drawn digits with the last one set so that the Luhn sum is 0."""
    short = like_format(F.concat(F.substr(entity, F.lit(1), F.length(entity) - 1), more("0", turn)), bits)
    check = lambda x: F.pmod(10 - luhn_sum(F.concat(F.regexp_replace(x, r"\D", ""), F.lit("0"))), F.lit(10))
    return let(short, lambda x: F.concat(x, check(x).cast("string")))


def iban_surrogate(entity: Column, bits: Column, turn: Column) -> Column:
    """The country stays; the check digits are those of the drawn rest."""
    rest = like_format(F.concat(F.substr(entity, F.lit(5), F.length(entity)), more("0", turn)), bits)
    land = F.substr(entity, F.lit(1), F.lit(2))
    check = lambda x: F.lpad((98 - mod97(F.concat(land, F.lit("00"), F.replace(x, F.lit(" "), F.lit(""))))).cast("string"), 2, "0")
    return let(rest, lambda x: F.concat(land, check(x), x))


def phone_surrogate(entity: Column, bits: Column, turn: Column) -> Column:
    """A leading country code stays."""
    head = F.regexp_extract(entity, r"^(\+\d{1,3}(?=[ .(-]))?", 1)
    return F.concat(head, like_format(F.concat(F.substr(entity, F.length(head) + 1, F.length(entity)), more("0", turn)), bits))


def ip_surrogate(bits: Column, turn: Column) -> Column:
    """Four octets; where no more are free, an IPv6 address."""
    octets = F.concat_ws(".", *[(pick(bits, F.lit(i), 254) + 1).cast("string") for i in range(4)])
    return F.when(turn <= EXACT, octets).otherwise(ipv6_surrogate(bits))


def ipv6_surrogate(bits: Column) -> Column:
    return F.regexp_replace(hexes(F.lit(32), bits), "(.{4})(?!$)", "$1:")


def secret_surrogate(entity: Column, bits: Column, turn: Column) -> Column:
    """The word before it stays; hexadecimal secrets stay hexadecimal."""
    head = F.regexp_extract(entity, f"^({SECRET_HEAD})", 1)
    entity = F.concat(F.substr(entity, F.length(head) + 1, F.length(entity)), more("a", turn))
    return F.concat(head, F.when(entity.rlike(r"^[0-9a-f]+$"), hexes(F.length(entity), bits)).otherwise(like_format(entity, bits)))


def part_surrogate(part: Column, kind: Column, bits: Column, turn: Column) -> Column:
    """A part of a name from syllables of its script; hyphens and apostrophes stay, capitals stay capitals."""
    script = F.when(part.rlike(f"^{SCRIPTS['cyrillic']}"), "cyrillic").when(part.rlike(f"^{SCRIPTS['greek']}"), "greek").when(part.rlike(f"^{SCRIPTS['east']}"), "east").otherwise("latin")
    tables = F.create_map(*[x for k, v in SYLLABLES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    endings = [F.create_map(*[F.lit(x) for k, v in ENDINGS.items() for x in (k, v[g])]) for g in (0, 1)]

    def built(x: Column) -> Column:
        last = F.size(x["pieces"]) - 1
        ending = F.when(kind == "given f", F.try_element_at(endings[0], x["script"])).when(kind == "given m", F.try_element_at(endings[1], x["script"])).otherwise("")

        def piece(p: Column, i: Column) -> Column:
            n = F.when(x["script"] == "east", F.length(p) - 1).otherwise(F.when(last == 0, 2).otherwise(1)) + F.when(i == last, turn).otherwise(0)
            syllable = lambda k: F.element_at(x["table"], (pick(bits, (k + i * 8).cast("long"), 20) % F.size(x["table"]) + 1).cast("int"))
            new = F.concat(F.array_join(F.transform(F.sequence(F.lit(0), n), syllable), ""), F.when(i == last, ending).otherwise(""))
            shown = F.when((F.length(p) > 1) & (p == F.upper(p)), F.upper(new)).when(p.rlike(r"^\p{Lu}"), F.initcap(new)).otherwise(new)
            return F.when(p.rlike(r"^\p{L}"), shown).otherwise(p)

        return F.array_join(F.transform(x["pieces"], piece), "")

    known = F.struct(F.split(part, r"(?<=['’-])|(?=['’-])").alias("pieces"), F.try_element_at(tables, script).alias("table"), script.alias("script"))
    return let(known, built)


def surrogate(entity: Column, kind: Column, turn: Column) -> Column:
    """A surrogate of an entity of any kind but a whole name, whose parts have their own."""

    def made(x: Column) -> Column:
        shown, kind, bits, turn = x["shown"], x["kind"], x["bits"], x["turn"]
        return (
            F.when(kind == "email", email_surrogate(shown, bits, turn))
            .when(kind == "ip", ip_surrogate(bits, turn))
            .when(kind == "ipv6", ipv6_surrogate(bits))
            .when(kind == "card", card_surrogate(shown, bits, turn))
            .when(kind == "iban", iban_surrogate(shown, bits, turn))
            .when(kind == "phone", phone_surrogate(shown, bits, turn))
            .when(kind.isin(*PARTS), part_surrogate(shown, kind, bits, turn))
            .when(kind == "secret", secret_surrogate(shown, bits, turn))
            .otherwise(shown)
        )

    known = F.struct(entity.alias("shown"), kind.alias("kind"), turn.alias("turn"))
    drawn = lambda x: F.struct(x["shown"].alias("shown"), x["kind"].alias("kind"), x["turn"].alias("turn"), draws(x["kind"], canonical(x["kind"], x["shown"]), x["turn"]).alias("bits"))
    return let(let(known, drawn), made)


def piece(shown: Column, kind: Column) -> Column:
    return F.struct(shown.alias("shown"), kind.alias("kind"))


def cut(text: Column, pattern, kind: Callable[[Column], Column]) -> Column:
    """The text as pieces (shown, kind): what the pattern matches with its kind, and the rest with kind null."""
    found = F.struct(F.split(text, pattern, -1).alias("plain"), F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0)).alias("hits"))
    plain = F.lit(None).cast("string")

    def both(x: Column) -> Column:
        pairs = F.transform(x["plain"], lambda p, i: let(F.get(x["hits"], i), lambda e: F.array(piece(p, plain), piece(e, kind(e)))))
        return F.filter(F.flatten(pairs), lambda y: F.coalesce(y["shown"] != "", F.lit(False)))

    return let(found, both)


def name_parts(name: Column) -> Column:
    """(shown, kind) of the parts of a name after its title."""

    def parts(words: Column) -> Column:
        given = F.when(F.regexp_replace(words[0], r"\.$", "").isin(TITLES_F), "given f").otherwise("given m")
        return F.transform(F.slice(words, 2, F.size(words)), lambda w, i: piece(w, F.when(i == F.size(words) - 2, "surname").otherwise(given)))

    return let(F.split(name, " "), parts)


def hinted(text: Column) -> Column:
    return reduce(or_, [F.contains(text, F.lit(x)) for x in PLAIN]) | text.rlike(HINT)


def split_text(text: Column) -> Column:
    """The text as pieces (shown, kind), joined again they are the text; kind is null in what stays. Null without a hint.

    Stretches whose check digits fail are searched again for what they hide; the surnames found after a
    title are found in the rest of the text.
    """
    pieces = F.when(hinted(text), cut(text, ENTITY, kind_of))

    def within(x: Column) -> Column:
        return F.when(x["kind"] == "none", cut(x["shown"], WITHIN, lambda e: F.nullif(kind_of(e), F.lit("none")))).otherwise(F.array(x))

    def everywhere(x: Column) -> Column:
        names = F.filter(x, lambda p: F.coalesce(p["kind"] == "name", F.lit(False)))
        surnames = F.array_distinct(F.transform(names, lambda p: F.substring_index(p["shown"], " ", -1)))
        pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(surnames, "|"), F.lit(r")(?!\p{L})"))
        more = let(pattern, lambda y: F.flatten(F.transform(x, lambda p: F.when(p["kind"].isNull(), cut(p["shown"], y, lambda e: F.lit("surname"))).otherwise(F.array(p)))))
        return F.when(F.size(names) > 0, more).otherwise(x)

    checked = let(pieces, lambda x: F.when(F.exists(x, lambda p: F.coalesce(p["kind"] == "none", F.lit(False))), F.flatten(F.transform(x, within))).otherwise(x))
    return let(checked, everywhere)


def redrawn(entities: DataFrame) -> DataFrame:
    """kind, canon, turn of the entities whose first surrogate collides. entities: kind, canon, shown (distinct, written).

    Each round keeps, of equal surrogates, the least entity, and none that is an entity itself; as formats
    widen, the rounds end.
    """
    settled, waiting = None, entities.withColumn("turn", F.lit(0))
    real = entities.select("kind", F.col("canon").alias("new"))
    while True:
        made = waiting.withColumn("made", surrogate(F.col("shown"), F.col("kind"), F.col("turn")))
        drawn = made.withColumn("new", canonical(F.col("kind"), F.col("made"))).drop("made")
        drawn = drawn.join(real.withColumn("is_real", F.lit(True)), ["kind", "new"], "left")
        if settled is not None:
            taken = settled.select("kind", "new").withColumn("is_taken", F.lit(True))
            drawn = drawn.join(taken, ["kind", "new"], "left")
        else:
            drawn = drawn.withColumn("is_taken", F.lit(None).cast("boolean"))
        least = drawn.where("is_real is null and is_taken is null").groupBy("kind", "new").agg(F.min("canon").alias("winner"))
        judged = written(drawn.join(least, ["kind", "new"], "left").withColumn("won", F.coalesce(F.col("winner") == F.col("canon"), F.lit(False))), "drawn")
        won = judged.where("won").select("kind", "canon", "turn", "new")
        settled = won if settled is None else settled.unionByName(won)
        waiting = judged.where("not won").select("kind", "canon", "shown", (F.col("turn") + 1).alias("turn"))
        if not waiting.limit(1).count():
            return settled.where("turn > 0").select("kind", "canon", "turn")


def entity_key(kind: Column, canon: Column) -> Column:
    return F.concat(kind, F.lit(" "), canon)


def replace_entities(docs: DataFrame, names: tuple[str, str] = ("n_entities", "kinds"), column: str = "text") -> DataFrame:
    """docs with column rewritten, the number of its entities and a sorted list of their kinds.

    Null texts stay null and have no entities; empty texts stay empty; very long texts are rewritten
    whole; repeated rows are rewritten alike; an empty table stays empty. Columns called like the new
    ones are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {n.lower() for n in names}])
    pieces, mark, kinds, turns, of = unused(docs, "pieces_", "mark_", "kinds_", "turns_", "of_")
    parts = lambda p: F.when(p["kind"] == "name", name_parts(p["shown"])).otherwise(F.array(p))
    hits = F.filter(split_text(F.col(column)), lambda p: p["kind"].isNotNull())
    found = docs.where(hinted(F.col(column))).select(F.flatten(F.transform(hits, parts)).alias("e"), F.md5(column).alias("of"))
    # inline_outer: before inline Spark filters by the array's size, and so would search each text twice
    found = found.select("of", F.inline_outer("e")).where("kind is not null")
    found = written(found.withColumn("canon", canonical(F.col("kind"), F.col("shown"))).distinct(), "entities")
    entities = written(found.groupBy("kind", "canon").agg(F.min("shown").alias("shown")), "entities")
    again = redrawn(entities).withColumnRenamed("turn", "t")
    pairs = written(found.join(again, ["kind", "canon"]).select("of", entity_key(F.col("kind"), F.col("canon")).alias("k"), "t").distinct(), "redrawn")
    maps = pairs.groupBy(F.col("of").alias(of)).agg(F.map_from_entries(F.collect_list(F.struct("k", "t"))).alias(turns))
    maps = F.broadcast(maps) if pairs.count() <= REDRAWN else maps
    rows = docs.withColumns({pieces: split_text(F.col(column)), mark: F.md5(column)})
    rows = rows.join(maps, F.col(mark) == F.col(of), "left")

    def drawn(p: Column) -> Column:
        turn = F.coalesce(F.try_element_at(F.col(turns), entity_key(p["kind"], canonical(p["kind"], p["shown"]))), F.lit(0))
        return surrogate(p["shown"], p["kind"], turn)

    def rewritten(p: Column) -> Column:
        whole = F.concat_ws(" ", F.substring_index(p["shown"], " ", 1), F.transform(name_parts(p["shown"]), drawn))
        return F.when(p["kind"].isNull(), p["shown"]).when(p["kind"] == "name", whole).otherwise(drawn(p))

    listed = F.transform(F.filter(F.col(f"{pieces}.kind"), lambda k: k.isNotNull()), lambda k: F.when(k == "surname", "name").otherwise(k))
    rows = rows.withColumn(kinds, F.coalesce(listed, F.array().cast("array<string>")))
    text = F.when(F.col(column).isNull(), F.lit(None)).when(F.size(kinds) == 0, F.col(column)).otherwise(F.array_join(F.transform(pieces, rewritten), ""))
    return rows.select(*[text.alias(c) if c == column else F.col(f"`{c}`") for c in docs.columns], F.size(kinds).cast("long").alias(names[0]), F.array_join(F.array_sort(F.array_distinct(kinds)), ",").alias(names[1]))


def surrogate_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text with surrogates, n_entities and kinds of every document; nulls and repeats as in replace_entities."""
    return replace_entities(docs.select("doc_id", "text"))
