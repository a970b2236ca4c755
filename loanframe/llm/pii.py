"""PII surrogates (operator 4), in DataFrame and SQL expressions only.

Personal data is found by pattern: e-mail addresses, IPv4 addresses, payment card
numbers, IBANs, phone numbers, social security numbers, secrets (keys, tokens and quoted
passwords) and persons named with a form of address.  Every entity of the corpus gets
one surrogate, derived from a secret key by SHA-256, of its own type and format:

- digits stay digits, letters letters of their case, hexadecimal tokens hexadecimal;
  punctuation stays, and so do a phone's country code (told by its digits, so alike with
  and without separators), a domain's last label and an IBAN's country.  Card numbers keep passing, or failing, the check digit;
- a person's given name turns into one of the same gender (told by the form of address)
  and script, a surname into one of the same script.

The same entity gets the same surrogate wherever and in whatever layout it occurs (a
phone number with or without blanks, an address in capitals, a person with or without
given name; a name that a document uses again without a form of address, in possessives
too).  Different entities get different surrogates, and no surrogate is an entity
of the corpus: surrogates that clash are drawn again, in rounds over the distinct
entities, until none does.  Phones are compared by the digits that are written.  Where
a country's numbers of one length run out, surrogates get further digits at the end;
secrets without any letter or digit to draw anew get further letters.

Not found: persons never named with a form of address, initials before a name, postal
addresses, IPv6 addresses, numbers of ten digits in another grouping than 3-3-4, secrets
neither of a known prefix, nor of 32 hexadecimal digits, nor quoted after a key word.

What is shuffled: the distinct entities, one row for each document and entity, and the
texts of documents that hold one; texts without any pass through.  The patterns run over
each text once, and what they find is written with the rows to the shared folder.

Defined cases: null and empty texts stay.  Rows with equal id and text get equal
results; null ids are ids like others.  An empty key is an error.  ``n_entities`` counts
the occurrences and replaces a column of that name; all other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, packed, stored, unpacked

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

# Forms of address, by gender.
_MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Signor", "господин", "г-н")
_FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Sra", "Srta", "Madame", "Mme", "Mlle", "Signora", "госпожа", "г-жа")
_NEUTRAL = ("Dr", "Prof")
_ADDRESS = "|".join(sorted(_MALE + _FEMALE + _NEUTRAL, key=len, reverse=True))

#: A name: apostrophes belong to it (O'Brien) unless they begin an ending (Smith's, he'll).
_NAME = r"\p{Lu}\p{L}*+(?:['’](?!(?:ll|re|ve)(?!\p{L}))\p{L}{2,}+)*+"

#: Patterns by type, in the order in which they are tried.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)*+(?<=\.[A-Za-z]{2,24})",
    "secret": r"(?<![A-Za-z0-9])(?:(?=[0-9]*+[a-f])(?=[a-f]*+[0-9])[0-9a-f]{32,}+|(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}+|sk-[A-Za-z0-9]{20,}+)(?![A-Za-z0-9])"
    r"|(?<=[\"'])(?<=(?:token|secret|password|passwd|api_key|apikey)\s{0,3}[=:]\s{0,3}[\"'])[^\"'\s]{6,}+(?=[\"'])",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<!\d)(?:\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{4}|\d{13,19})(?!\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)[ .\-]?\d{3}[ .\-]?\d{3,4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?!\d)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,5}(?!\d)"
    r"|(?<![\w+])(?<!\d )\d{3} \d{3} \d{4}(?! ?\d)",
    "person": rf"(?<![\p{{L}}\p{{N}}])(?:{_ADDRESS})\.? {_NAME}(?:[ \-]{_NAME}){{0,2}}",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Found in every text in which a pattern is; it is much faster, and looked for first.
_HINT = rf"[0-9@]|[=:]\s{{0,3}}[\"']|sk-|gh[pousr]_|AKIA|ASIA|(?<![\p{{L}}\p{{N}}])(?:{_ADDRESS})\.? \p{{Lu}}"

#: The calling code at the beginning of an international number: no code begins another.
_COUNTRY = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: Rounds of drawing; a type whose format has no room for so many entities is an error.
MAX_DRAWS = 64
#: Draws of a phone number until it gets one more digit.
_PHONE_DRAWS = 16

# Syllables of made-up names, by script.
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga ka ke la le li lo ma me mi mo na ne no pa ra re ri ro sa se so ta te ti to va ve vi".split(),
    "cyrillic": "ба бе бо ва ве ви га да де до ка ке ла ле ли ло ма ме ми мо на не но па ра ре ри ро са се со та те ти то".split(),
    "greek": "βα γα γε δα δε θα κα κε κο λα λε λι λο μα με μι μο να νε νο πα πε ρα ρε ρι ρο σα σε σο τα τε τι το φα φε".split(),
}
_ENDINGS = {
    ("latin", "f"): ["na", "lia", "ra", "sa"],
    ("latin", "m"): ["rdo", "lus", "nos", "kus"],
    ("latin", "n"): ["n", "l", "r", "s"],
    ("cyrillic", "f"): ["на", "лия", "ра", "са"],
    ("cyrillic", "m"): ["лав", "мир", "тон", "дор"],
    ("cyrillic", "n"): ["н", "л", "р", "с"],
    ("greek", "f"): ["να", "λια", "ρα", "σα"],
    ("greek", "m"): ["νος", "λης", "ρης", "κος"],
    ("greek", "n"): ["ν", "λ", "ρ", "ς"],
}


def _literals(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _stream(key: str, *parts: Column, size: Column) -> Column:
    """A keyed string of hexadecimal digits, at least ``size`` of them."""
    seed = F.concat_ws("\0", F.lit(key), *parts)
    blocks = F.sequence(F.lit(0), F.floor(size / 64).cast("int"))
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws("\0", seed, b.cast("string")).cast("binary"), 256)), "")


def _number(stream: Column, i: Column, below: int) -> Column:
    """The i-th number of a stream, from 0 to ``below`` - 1."""
    return (F.conv(F.substring(stream, i * 4 + 1, F.lit(4)), 16, 10).cast("int") % below).cast("int")


#: Alphabets whose letters are redrawn: first letter, number of letters.
_ALPHABETS = (("0", 10), ("a", 26), ("A", 26), ("а", 32), ("А", 32), ("α", 17), ("Α", 17))


def _like(value: Column, stream: Column) -> Column:
    """``value`` with digits and letters drawn anew, of the same kinds; characters outside
    ``_ALPHABETS`` stay."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")

    def redrawn(c: Column, i: Column) -> Column:
        out = c
        for first, n in _ALPHABETS:
            drawn = F.substring(F.lit("".join(chr(ord(first) + k) for k in range(n))), _number(stream, i, n) + 1, F.lit(1))
            # Greek capitals and small letters are cut before the final sigma.
            out = F.when(c.between(first, chr(ord(first) + n - 1)), drawn).otherwise(out)
        return out

    return F.array_join(F.transform(chars, redrawn), "")


def _filled(layout: Column, core: Column, kind: str) -> Column:
    """``layout`` with its characters of class ``kind`` replaced by those of ``core``,
    one by one."""
    chars = F.filter(F.split(layout, ""), lambda c: c != "")
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    done = F.aggregate(
        chars,
        start,
        lambda s, c: F.when(
            c.rlike(kind), F.struct(F.concat(s["out"], F.substring(core, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
    )
    return done["out"]


def _type_of(value: Column) -> Column:
    kinds = [F.when(value.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items() if k != "secret"]
    # Quotes around a secret are not part of it, so what matches nothing else is one.
    return F.coalesce(*kinds, F.lit("secret"))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _parts(value: Column, kind: Column) -> Column:
    """The entities that a found value names: (part, norm, gender, script).  A person
    is one entity per name, all others are one entity."""
    names = F.split(F.regexp_replace(value, rf"^(?:{_ADDRESS})\.? ", ""), r"[ \-]")
    gender = (
        F.when(value.rlike(rf"^(?:{'|'.join(_FEMALE)})\.? "), "f")
        .when(value.rlike(rf"^(?:{'|'.join(_MALE)})\.? "), "m")
        .otherwise("n")
    )
    persons = F.transform(
        names,
        lambda w, i: F.struct(
            F.lit("name").alias("kind"),
            F.lower(w).alias("norm"),
            F.when((i == 0) & (F.size(names) > 1), gender).otherwise("").alias("gender"),
            _script(w).alias("script"),
        ),
    )
    norm = (
        F.when(kind == "phone", F.regexp_replace(value, r"(?!^\+)\D", ""))
        .when(kind.isin("card", "ssn"), F.regexp_replace(value, r"\D", ""))
        .when(kind == "email", F.lower(value))
        .when(kind == "iban", F.replace(value, F.lit(" "), F.lit("")))
        .otherwise(value)
    )
    other = F.array(F.struct(kind.alias("kind"), norm.alias("norm"), F.lit("").alias("gender"), F.lit("").alias("script")))
    return F.when(kind == "person", persons).otherwise(other)


def _drawn(key: str) -> Column:
    """The surrogate of an entity (kind, norm, gender, script) at its ``attempt``."""
    kind, norm, attempt = F.col("kind"), F.col("norm"), F.col("attempt")
    stream = _stream(key, kind, norm, attempt.cast("string"), size=F.length(norm) * 4 + 64)
    place = F.expr("instr(norm, '@')")
    local, domain = F.substring(norm, F.lit(1), place - 1), F.substring(norm, place + 1, F.length(norm))
    top = F.regexp_extract(domain, r"\.[a-z]+$", 0)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(top))
    host = _like(host, _stream(key, F.lit("host"), domain, size=F.length(domain) * 4 + 64))
    # More letters after some clashes, so that short addresses never run out.
    more = F.substring(F.translate(stream, "0123456789", "ghijklmnop"), F.lit(3), F.floor(attempt / 3).cast("int"))
    email = F.concat(_like(local, stream), more, F.lit("@"), host, top)
    octets = [(_number(stream, F.lit(i), 254) + 1).cast("string") for i in range(4)]
    body = _like(F.substring(norm, F.lit(1), F.length(norm) - 1), stream)
    checks = F.filter(
        F.sequence(F.lit(0), F.lit(9)),
        lambda d: F.call_function("luhn_check", F.concat(body, d.cast("string"))) == F.call_function("luhn_check", norm),
    )
    card = F.concat(body, F.get(checks, F.lit(0)).cast("string"))
    hexed = F.substring(stream, F.lit(1), F.length(norm))
    # A secret that cannot be drawn otherwise (****** has no letter) gets further letters.
    grown = F.substring(F.translate(stream, "0123456789", "ghijklmnop"), F.lit(3), F.floor((attempt + 1) / 2).cast("int"))
    secret = F.when(norm.rlike("^(?=.*[a-f])(?=.*[0-9])[0-9a-f]+$"), F.concat(hexed, F.when(attempt > 8, grown).otherwise(""))).otherwise(
        F.concat(F.regexp_extract(norm, r"^(?:AKIA|ASIA|gh[pousr]_|sk-)?", 0), _like(F.regexp_replace(norm, r"^(?:AKIA|ASIA|gh[pousr]_|sk-)", ""), stream), grown)
    )
    iban = F.concat(F.substring(norm, F.lit(1), F.lit(2)), _like(F.substring(norm, F.lit(3), F.length(norm)), stream))
    country = F.regexp_extract(norm, _COUNTRY, 0)
    further = F.repeat(F.lit("0"), F.floor(attempt / _PHONE_DRAWS).cast("int"))
    national = F.concat(F.substring(norm, F.length(country) + 1, F.length(norm)), further)
    phone = F.concat(country, _like(national, _stream(key, kind, norm, attempt.cast("string"), size=F.length(national) * 4 + 64)))
    name = F.lit(None).cast("string")
    for script, syllables in _SYLLABLES.items():
        parts = _literals(syllables)
        count = F.floor(attempt / 3).cast("int") + 1
        middle = F.transform(F.sequence(F.lit(1), count), lambda i: F.get(parts, _number(stream, i, len(syllables))))
        for gender in "fmn":
            end = _ENDINGS[script, gender]
            made = F.concat(
                F.get(parts, _number(stream, F.lit(0), len(syllables))),
                F.array_join(middle, ""),
                F.get(_literals(end), _number(stream, count + 1, len(end))),
            )
            fits = (F.col("script") == script) & (F.col("gender") == gender if gender != "n" else F.col("gender").isin("n", ""))
            name = F.when(fits, made).otherwise(name)
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", F.concat_ws(".", *octets))
        .when(kind == "card", card)
        .when(kind == "secret", secret)
        .when(kind == "iban", iban)
        .when(kind == "name", name)
        .when(kind == "phone", phone)
        .otherwise(_like(norm, stream))
    )


def _written(core: Column) -> Column:
    """What must differ between the cores, or norms, of one kind: of phones the digits,
    whether a plus comes before them or not."""
    return F.when(F.col("kind") == "phone", F.regexp_replace(core, r"^\+", "")).otherwise(core)


def draw_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, norm, core)`` for distinct entities (kind, norm, gender, script): cores
    differ from one another and from every norm of their kind.  After ``MAX_DRAWS`` rounds
    that is an error."""
    state = stored(entities.withColumn("attempt", F.lit(0)), "entities")
    for _ in range(MAX_DRAWS):
        drawn = state.withColumn("core", _drawn(key)).withColumn("written", _written(F.col("core")))
        drawn = stored(drawn, "surrogates")
        best = drawn.groupBy("kind", "written").agg(F.min(F.struct("attempt", "norm")).alias("best"), F.count("*").alias("n"))
        lost = best.filter("n > 1").join(drawn, ["kind", "written"]).filter("best.norm != norm").select("kind", "norm")
        real = drawn.select("kind", _written(F.col("norm")).alias("written"))
        lost = lost.union(drawn.join(real, ["kind", "written"], "left_semi").select("kind", "norm")).distinct()
        lost = stored(lost.withColumn("clash", F.lit(True)), "clashes")
        if lost.isEmpty():
            return drawn.select("kind", "norm", "core")
        state = stored(
            drawn.drop("core", "written")
            .join(lost, ["kind", "norm"], "left")
            .withColumn("attempt", F.col("attempt") + F.when(F.col("clash"), 1).otherwise(0))
            .drop("clash"),
            "entities",
        )
    kinds = [r[0] for r in lost.select("kind").distinct().orderBy("kind").limit(len(PATTERNS)).collect()]
    raise ValueError(f"no distinct surrogates after {MAX_DRAWS} draws for entities of type {', '.join(kinds)}")


def _replaced(value: Column, kind: Column, cores: Column) -> Column:
    """A found value with the surrogates of its parts, in its own layout."""
    core = F.get(cores, F.lit(0))
    digits = F.regexp_replace(core, r"^\+", "")
    further = F.substring(digits, F.length(F.regexp_replace(value, r"\D", "")) + 1, F.length(digits))
    phone = F.concat(_filled(value, digits, r"\d"), further)
    address = F.regexp_extract(value, rf"^(?:{_ADDRESS})\.? ", 0)
    names = F.substring(value, F.length(address) + 1, F.length(value))
    joints = F.split(F.regexp_replace(names, r"[^ \-]+", "x"), "x")
    upper = F.split(names, r"[ \-]")
    person = F.concat(
        address,
        F.array_join(
            F.transform(
                cores,
                lambda c, i: F.concat(
                    F.get(joints, i),
                    F.when(
                        (F.length(F.get(upper, i)) > 1) & (F.get(upper, i) == F.upper(F.get(upper, i))), F.upper(c)
                    ).otherwise(F.initcap(c)),
                ),
            ),
            "",
        ),
    )
    email = F.when((value == F.upper(value)) & (value != F.lower(value)), F.upper(core)).otherwise(core)
    return (
        F.when(kind == "phone", phone)
        .when(kind.isin("card", "ssn"), _filled(value, core, r"\d"))
        .when(kind == "iban", _filled(value, core, "[A-Z0-9]"))
        .when(kind == "email", email)
        .when(kind == "person", person)
        .otherwise(core)
    )


def found_values(text: Column) -> Column:
    """The values found in a text, in order."""
    return F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))


KEYS = ("null_id", "id", "text_hash")


def _with_bare_names(piece: Column, names: Column) -> Column:
    """A stretch of text with the names that a document names with a form of address
    elsewhere; ``names`` maps them, in small letters, to their surrogates."""
    pattern = rf"(?<![\p{{L}}\p{{N}}]){_NAME}"
    found = F.regexp_extract_all(piece, F.lit(pattern), F.lit(0))
    gaps = F.split(piece, pattern, -1)

    def written(name: Column, i: Column) -> Column:
        core = F.try_element_at(names, F.lower(name))
        shouted = (F.length(name) > 1) & (name == F.upper(name))
        new = F.coalesce(F.when(shouted, F.upper(core)).otherwise(F.initcap(core)), name)
        return F.concat(F.get(gaps, i), new)

    return F.concat(F.array_join(F.transform(found, written), ""), F.element_at(gaps, -1))


def replace_pii(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_entities``, the values replaced (bare
    names that follow from them are not counted)."""
    if not key:
        raise ValueError("surrogates need a secret key")
    columns = [c for c in docs.columns if c.lower() != "n_entities"]
    rows = docs.select(packed(docs), column(text).alias("text"))
    values_of = F.when(F.col("text").rlike(_HINT), found_values(F.col("text")))
    # The one pass of the patterns over the texts; all below reads what it found.
    searched = stored(
        rows.select(
            "row",
            F.col("row").getField(doc_id).isNull().alias("null_id"),
            F.coalesce(F.col("row").getField(doc_id), F.lit(0)).cast("bigint").alias("id"),
            F.xxhash64("text").alias("text_hash"),
            F.coalesce(values_of, F.array().cast("array<string>")).alias("found"),
        ).withColumn("n", F.size("found").cast("bigint")),
        "searched",
    )
    keyed = searched.filter("n > 0")
    whole = F.col("row").getField(text)
    occurring = keyed.select(*KEYS, F.explode("found").alias("value"))
    occurring = stored(occurring.distinct(), "found")

    values = occurring.select("value").distinct().withColumn("kind", _type_of(F.col("value")))
    values = values.withColumn("parts", _parts(F.col("value"), F.col("kind")))
    values = stored(values, "values")
    # Of one name under several forms of address: a given name if ever one, and female
    # before male before neither.
    named = values.select(F.inline("parts")).groupBy("kind", "norm").agg(
        F.min(F.when(F.col("gender") != "", F.col("gender"))).alias("gender"), F.min("script").alias("script")
    )
    cores = draw_surrogates(named.withColumn("gender", F.coalesce("gender", F.lit(""))), key)
    replaced = (
        values.select("value", F.col("kind").alias("type"), F.posexplode("parts").alias("at", "part"))
        .select("value", "type", "at", "part.kind", "part.norm")
        .join(cores, ["kind", "norm"])
        .groupBy("value", "type")
        .agg(F.array_sort(F.collect_list(F.struct("at", "core", "norm"))).alias("cores"))
        .select(
            "value",
            _replaced(F.col("value"), F.col("type"), F.col("cores.core")).alias("surrogate"),
            F.when(
                F.col("type") == "person", F.transform("cores", lambda c: F.struct(c["norm"].alias("name"), c["core"].alias("core")))
            ).alias("names"),
        )
    )
    by_row = occurring.join(replaced, "value").groupBy(*KEYS).agg(
        F.map_from_entries(F.collect_list(F.struct("value", "surrogate"))).alias("surrogates"),
        F.map_from_entries(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"),
    )
    parts = keyed.join(by_row, list(KEYS)).withColumn("between", F.split(whole, _ANY, -1))
    # Later mentions of a name, in documents that hold one with a form of address.
    parts = parts.withColumn(
        "between",
        F.when(F.size("names") == 0, F.col("between")).otherwise(
            F.transform("between", lambda p: _with_bare_names(p, F.col("names")))
        ),
    )
    changed = F.concat(
        F.array_join(
            F.transform("found", lambda v, i: F.concat(F.get("between", i), F.element_at("surrogates", v))), ""
        ),
        F.element_at("between", -1),
    )
    done = parts.select(*unpacked(columns, **{text: changed}), F.col("n").alias("n_entities"))
    plain = searched.filter("n = 0").select(*unpacked(columns), F.col("n").alias("n_entities"))
    return done.unionByName(plain)
