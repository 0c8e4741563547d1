"""PII: detected entities are replaced by keyed surrogates of the same type, format, script and gender.

``docs`` needs text; all its columns and rows are kept, repeated ones too. A null text stays null, an empty one empty; an
empty table gives an empty table. Texts are searched whole.

Entities are e-mail addresses, IPv4 addresses, phone, card, social security and bank account numbers, and names after a
form of address. A surrogate follows from the key and the entity alone, so an entity has the same one in all documents
and in all its spellings (separators and letter case are kept from the spelling). Each digit becomes a digit and each
letter a letter of its script; addresses stay valid, card numbers keep their check sum, country codes stay, names get the
gender of the form of address.

Surrogates are checked over the whole corpus: one that equals another entity's surrogate or any entity's own value is
drawn again. Only the few entities drawn again are looked up when texts are rewritten; all others are computed in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import text_key, written

# Names and e-mail addresses gain a syllable or letter for each two draws. After so many draws the format has no room left: the surrogate is then a label of the type with a keyed hash.
DRAWS = 16

_MALE = "Mr|Herrn|Herr|Monsieur|Señor|Sr|Signor|Господин"
_FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Signora|Госпожа"
_MALE, _FEMALE = (f"{names}|{names.upper()}" for names in (_MALE, _FEMALE))
_ADDRESS = rf"(?<!\p{{L}})(?:{_MALE}|{_FEMALE})\.?[ \u00a0]"
_NAMED = r"\p{Lu}[\p{L}'’-]++(?:[ \u00a0]\p{Lu}[\p{L}'’-]++){0,2}"
_BYTE = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# The JVM's engine recurses for each turn of a group, so groups are bounded or possessive: a domain name has 127 labels at most.
PATTERN = "|".join(
    (
        r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_%+-](?:[\p{L}\p{N}._%+-])*+@(?:[A-Za-z0-9-]++\.){1,126}[A-Za-z]{2,}",
        rf"(?<![\p{{L}}\d.])(?:{_BYTE}\.){{3}}{_BYTE}(?![\p{{L}}\d]|\.\d)",
        r"(?<![\p{L}\d])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,5}){1,4}(?!\d)",
        r"(?<![\p{L}\d])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\d)",
        r"(?<![\p{L}\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
        r"(?<![\p{L}\d])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![\p{L}\d])",
        r"(?<![\p{L}\d])\d(?:[ -]?\d){12,18}(?![\p{L}\d])",
        rf"{_ADDRESS}{_NAMED}",
    )
)
# Every entity holds a digit, an @ or a form of address: texts without any are not searched.
_WORTH = rf"[0-9@]|{_ADDRESS}"

_LATIN, _CYRILLIC, _GREEK = "abcdefghiklmnopr", "абвгдежзиклмнопр", "αβγδεζηθικλμνξοπ"
_HEX = "0123456789abcdef"


def kind(value: Column) -> Column:
    return (
        F.when(F.contains(value, F.lit("@")), "email")
        .when(value.rlike(rf"^{_ADDRESS}"), "name")
        .when(value.rlike(rf"^(?:{_BYTE}\.){{3}}{_BYTE}$"), "ip")
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(value.rlike(r"^\+|^\(?\d{3}\)?[ .-]*\d{3}[.-]\d{4}$"), "phone")
        .when(value.rlike(r"^[A-Z]"), "iban")
        .otherwise("card")
    )


def let(value: Column, then) -> Column:
    """``then`` of a value that is worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def canonical(value: Column) -> Column:
    """What all spellings of an entity share, after its kind."""
    return let(F.struct(value.alias("v"), kind(value).alias("of")), lambda e: F.concat(e["of"], F.lit(":"), _core(e["v"], e["of"])))


def _core(value: Column, of: Column) -> Column:
    gender = F.when(value.rlike(rf"^(?:{_FEMALE})(?!\p{{L}})"), "f").otherwise("m")
    return (
        F.when(of == "email", F.lower(value))
        .when(of == "name", F.concat(gender, F.lit(" "), F.lower(F.regexp_replace(value, rf"^{_ADDRESS}", ""))))
        .when(of == "ip", value)
        .when(of == "iban", F.regexp_replace(value, " ", ""))
        .otherwise(F.regexp_replace(value, r"\D", ""))
    )


def _hash(key: str, what: Column, length: Column) -> Column:
    """Hex digits drawn by the key, at least ``length`` of them."""
    block = lambda i: F.sha2(F.concat_ws("\u0001", F.lit(key), what, i.cast("string")), 256)
    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor(length / 64).cast("int")), block), "")


def _reshaped(value: Column, hexes: Column) -> Column:
    """Each letter or digit of ``value`` becomes one of its own sort, drawn from the hex digit in its place."""

    def one(i: Column) -> Column:
        c, h = F.substring(value, i, 1), F.substring(hexes, i, 1)
        drawn = (
            F.when(c.rlike(r"\d"), F.translate(h, "abcdef", "135792"))
            .when(~c.rlike(r"\p{L}"), c)
            .when(c.rlike(r"\p{IsCyrillic}"), F.translate(h, _HEX, _CYRILLIC))
            .when(c.rlike(r"\p{IsGreek}"), F.translate(h, _HEX, _GREEK))
            .otherwise(F.translate(h, _HEX, _LATIN))
        )
        return F.when(c.rlike(r"\p{Lu}"), F.upper(drawn)).otherwise(drawn)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), one), "")


def _luhn(digits: Column) -> Column:
    """Check sum of a digit string; the last digit counts singly."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, 1).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


# Syllables from which names are made, fixed values by script; the ending shows the gender.
_START = {"latin": "Ba Be Da De Fa Ga Jo Ka La Le Ma Mi Na Ra Sa To".split(), "cyrillic": "Ба Бо Ва Да За Ка Ла Ле Ма Ми На Ра Са Та То Я".split(), "greek": "Αλ Βα Γα Δα Ελ Ζα Ηλ Θα Κα Λα Μα Να Πα Σα Τα Φι".split()}
_MIDDLE = {"latin": "bi do fe ga li mo na pe ri so ta ve wi xa yo ze".split(), "cyrillic": "ба ви го да ли ма не ро си та ту фе ха ци ше зо".split(), "greek": "βα γι δο ζε θα κι λο με να ξι πο ρα σι το φα χι".split()}
_END = {"latin": ("n", "na"), "cyrillic": ("в", "ва"), "greek": ("ς", "α")}


def _more(draw: Column) -> Column:
    """By how many syllables or letters a surrogate is longer in this draw, so that its space outgrows the entities."""
    return F.floor(draw / 2).cast("int")


def _name(value: Column, hexes: Column, draw: Column) -> Column:
    """The form of address, then a made word for each word of the name: gendered, of its script and letter case."""
    address = F.regexp_extract(value, rf"^{_ADDRESS}", 0)
    female = address.rlike(rf"^(?:{_FEMALE})(?!\p{{L}})")

    def made(script: str, i: Column) -> Column:
        digit = lambda k: F.instr(F.lit(_HEX), F.substring(hexes, i * 20 + k, 1))
        syllable = lambda parts, k: F.element_at(F.array(*map(F.lit, parts)), digit(k))
        parts = [syllable(_START[script], 1), *(syllable(_MIDDLE[script], k) for k in (2, 3, 4))]
        extra = F.transform(F.slice(F.sequence(F.lit(5), F.lit(5 + DRAWS // 2)), F.lit(1), _more(draw)), lambda k: syllable(_MIDDLE[script], k))
        return F.concat(*parts, F.array_join(extra, ""), F.when(female, _END[script][1]).otherwise(_END[script][0]))

    def word(w: Column, i: Column) -> Column:
        drawn = F.when(w.rlike(r"\p{IsCyrillic}"), made("cyrillic", i)).when(w.rlike(r"\p{IsGreek}"), made("greek", i)).otherwise(made("latin", i))
        return F.when(F.upper(w) == w, F.upper(drawn)).otherwise(drawn)

    words = F.split(F.substring(value, F.length(address) + 1, F.length(value)), r"[ \u00a0]")
    return F.concat(address, F.array_join(F.transform(words, word), " "))


def _email(value: Column, hexes: Column, draw: Column, key: str) -> Column:
    def made(domain: Column) -> Column:
        host, last = F.regexp_replace(domain, r"[^.]+$", ""), F.substring_index(domain, ".", -1)
        local = F.substring(value, 1, F.length(value) - F.length(domain) - 1)
        last_letter = F.regexp_extract(local, r"(\p{L})[^\p{L}]*$", 1)
        extra = F.repeat(F.when(last_letter == "", "a").otherwise(last_letter), _more(draw))
        longer = F.when(draw < 2, "").otherwise(_reshaped(extra, F.substring(hexes, -DRAWS, DRAWS)))
        return F.concat(_reshaped(local, hexes), longer, F.lit("@"), let(_hash(key, F.lower(domain), F.length(domain)), lambda h: _reshaped(host, h)), last)

    return let(F.substring_index(value, "@", -1), made)


def _ip(hexes: Column) -> Column:
    part = lambda i, most: (F.pmod(F.conv(F.substring(hexes, 4 * i + 1, 4), 16, 10).cast("int"), F.lit(most)) + 1).cast("string")
    return F.concat_ws(".", part(0, 223), part(1, 254), part(2, 254), part(3, 254))


def _placed(value: Column, signs: Column, keep: str) -> Column:
    """``signs``, one by one, in the places of ``value`` that match ``keep``."""
    gaps = F.split(value, keep, -1)
    return F.array_join(F.zip_with(gaps, F.transform(F.sequence(F.lit(1), F.size(gaps)), lambda i: F.substring(signs, i, 1)), lambda a, b: F.concat(a, b)), "")


def _number(value: Column, hexes: Column, of: Column) -> Column:
    """Digits are drawn by their place among the digits, so that separators don't matter."""

    def changed(e: Column) -> Column:
        digits, lead = e["digits"], e["lead"]
        fresh = F.concat(F.substring(digits, 1, lead), F.substring(F.translate(hexes, "abcdef", "135792"), 1, F.length(digits) - lead))
        body = F.substring(fresh, 1, F.length(digits) - 1)
        checked = let(body, lambda b: F.concat(b, F.pmod(_luhn(digits) - _luhn(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
        return F.when(of == "card", checked).otherwise(fresh)

    country = F.regexp_replace(F.regexp_extract(value, r"^\+\d{1,3}(?=\D)|^\+\d", 0), r"\D", "")
    parts = F.struct(F.regexp_replace(value, r"\D", "").alias("digits"), F.length(country).alias("lead"))
    return let(let(parts, changed), lambda c: _placed(value, c, r"\d"))


def _iban(value: Column, hexes: Column) -> Column:
    def made(account: Column) -> Column:
        rest = _reshaped(F.substring(account, 3, F.length(account)), hexes)
        return let(F.concat(F.substring(account, 1, 2), rest), lambda a: _placed(value, a, "[^ ]"))

    return let(F.regexp_replace(value, " ", ""), made)


def surrogate(value: Column, draw: Column, key: str) -> Column:
    """The replacement of an entity as it is spelled, in the given draw."""

    def made(e: Column) -> Column:
        v, of, hexes = e["v"], e["of"], e["hexes"]
        label = F.concat(F.lit("["), F.upper(of), F.lit("-"), F.substring(hexes, 1, 24), F.lit("]"))
        return (
            F.when(e["draw"] >= DRAWS, label).when(of == "email", _email(v, hexes, e["draw"], key)).when(of == "name", _name(v, hexes, e["draw"]))
            .when(of == "ip", _ip(hexes)).when(of == "iban", _iban(v, hexes)).otherwise(_number(v, hexes, of))
        )

    def drawn(e: Column) -> Column:
        what = F.concat(e["of"], F.lit(":"), _core(e["v"], e["of"]), F.lit("\u0001"), e["draw"].cast("string"))
        return F.struct(e["v"].alias("v"), e["of"].alias("of"), e["draw"].alias("draw"), _hash(key, what, F.length(e["v"])).alias("hexes"))

    given = F.struct(value.alias("v"), kind(value).alias("of"), draw.alias("draw"))
    return let(let(given, drawn), made)


def entities(text: Column) -> Column:
    """The entities of a text as they are spelled, in order."""
    none = F.array().cast("array<string>")
    return F.when(text.rlike(_WORTH), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(none)


def redraws(known: DataFrame, key: str) -> DataFrame:
    """(canonical, draw) of the entities of ``known`` (canonical, value: one spelling) whose first draw will not do."""
    waiting, taken, again, draw = known, known.select(F.col("canonical").alias("used")), None, 0
    while True:
        tried = written(waiting.withColumn("made", let(surrogate(F.col("value"), F.lit(draw), key), canonical)), "tried")
        free = written(tried.join(taken, F.col("made") == F.col("used"), "left_anti"), "free")
        one = Window.partitionBy("made").orderBy("canonical")
        won = written(free.withColumn("nth", F.row_number().over(one)).filter("nth = 1").select("canonical", "made"), "won")
        if draw:
            mine = won.select("canonical", F.lit(draw).alias("draw"))
            again = mine if again is None else again.unionByName(mine)
        waiting = written(waiting.join(won.select("canonical"), "canonical", "left_anti"), "waiting")
        if not waiting.take(1) or draw >= DRAWS:
            break
        taken = taken.unionByName(won.select(F.col("made").alias("used")))
        draw += 1
    return known.select("canonical", F.lit(0).alias("draw")).limit(0) if again is None else again


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with the entities of each text replaced, and the column n_entities added (replaced if there)."""
    row = (F.xxhash64(F.col("text")), F.length("text"))
    found = docs.select(text_key().alias("k"), F.length("text").alias("n"), F.explode(F.array_distinct(entities(F.col("text")))).alias("value"))
    found = written(found.withColumn("canonical", canonical(F.col("value"))), "entities")
    known = written(found.groupBy("canonical").agg(F.min("value").alias("value")), "known")
    again = written(redraws(known, key), "redraws")
    listed = found.join(again, "canonical").groupBy("k", "n").agg(F.map_from_entries(F.collect_set(F.struct("canonical", "draw"))).alias("draws"))
    listed = written(listed.select(F.col("k").alias("pii__k"), F.col("n").alias("pii__n"), F.col("draws").alias("pii__draws")), "listed")
    joined = docs.join(listed, (row[0] == F.col("pii__k")) & (row[1] == F.col("pii__n")), "left")
    draws = F.coalesce(F.col("pii__draws"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>")))
    values = entities(F.col("text"))
    made = F.transform(values, lambda v: surrogate(v, F.coalesce(F.try_element_at(draws, canonical(v)), F.lit(0)), key))
    pieces = F.split("text", PATTERN, -1)
    rewritten = F.array_join(F.zip_with(pieces, F.array_append(made, F.lit("")), lambda a, b: F.concat(a, b)), "")
    text = F.when(F.size(values) > 0, rewritten).otherwise(F.col("text"))
    kept = [c for c in docs.columns if c != "n_entities"]
    return joined.select(*[text.alias(c) if c == "text" else F.col(c) for c in kept], F.coalesce(F.size(values), F.lit(0)).cast("bigint").alias("n_entities"))
