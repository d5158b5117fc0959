r"""Replacement of personal data by keyed surrogates of the same kind and form.

Entities are found by one regular expression. What counts as one entity is its identity: the
digits of a phone, card or social security number, the lower-case form of an address, the
text itself otherwise. Every identity gets one surrogate everywhere, made from a keyed digest
of it, so mentions of one thing still agree (coreference):

- numbers keep punctuation, length and country code, which is read off the digits, so that
  all spellings of a number have the same; cards keep their first digit and their check sum;
  IP addresses stay addresses;
- e-mail addresses keep their shape, one domain always becoming the same other domain, and
  different ones different domains;
- keys, passwords and tokens keep length, case and alphabet (hexadecimal or not);
- names after a title keep it as it is written, and get given and family names of the title's
  gender and of the script they are written in (Latin, Greek, Cyrillic). One name and gender is
  one person, whatever the title; where a document has a full name behind a title, it is
  replaced without one, too. A family name alone is a person of its own.

A phone without a country code is the same as the one number with a code that the corpus has with
these digits, if there is exactly one.

Surrogates are checked as they are written, phones by the digits behind their country code,
against one another and against all originals of their type: of several identities with one surrogate the smallest
keeps it, the others are drawn again, as is a surrogate that is itself an original, until all
are distinct. Domains are identities of their own in this. Where a form has too few values,
phones, social security numbers, secrets, local parts and domains get a sign more with every
draw after the first ``PATIENCE``, as names do with every draw. The other forms are fixed: if
``MOST_DRAWS`` do not find a free value, an error says so.

Only DataFrame functions are used. Distinct mentions, far fewer than rows, are checked;
texts are matched with their surrogates by document, and only texts with a mention move. Very
common mentions and domains are kept out of the shuffles that bring them their surrogates.

Defined cases: null texts stay null; texts without entities stay as they are; rows equal in
doc_id and text are treated alike; a null doc_id is a document like any other; other columns
are kept, one called n_entities is replaced; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.common import as_row, join_counted, stored

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_LABELS = r"(?:password|passwd|pwd|token|secret|api[_-]?key)"
# A word of a name: O'Neil, McCoy, Jean-Luc; and what may stand before a family name.
_WORD = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}+(?:\p{Lu}\p{Ll}+)?(?:[-'’]\p{Lu}\p{Ll}+)*"
# Particles of family names.
_PARTICLE = "(?:van|von|der|den|de|del|della|di|da|dos|du|la|le|bin|ibn|al|el|ten|ter|zu)"
_PART = rf"(?:{_PARTICLE} ){{0,3}}{_WORD}"
# Titles that tell a gender.
TITLES = {
    "male": "Mr Herr Señor Sr Monsieur Signor Κύριος Господин",
    "female": "Mrs Ms Miss Frau Señora Sra Madame Mme Signora Κυρία Госпожа",
}
# Longer titles first, as some begin with others.
_TITLE = "(?:{})".format(
    "|".join(sorted(" ".join(TITLES.values()).split(), key=lambda t: (-len(t), t)))
)
_TITLE += r"\.?"
# The last sign of a secret.
_END = r"[^\s\"'.,;:)\]}>]"
# Lengths of account numbers by country.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}


def _grouped_ibans() -> str:
    """Account numbers in groups of four; their ends are known by their countries alone."""
    forms = []
    for length, countries in IBAN_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        last = f" [A-Z0-9]{{{rest}}}" if rest else ""
        either = countries.replace(" ", "|")
        forms.append(f"(?:{either})\\d{{2}}(?: [A-Z0-9]{{4}}){{{groups}}}{last}")
    return "|".join(forms)


# By name of type; the first that matches a mention is its type.
PATTERNS = {
    # Begins where a word does, so that long words are read once.
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,320}+@"
    r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "name": rf"(?<![\p{{L}}\p{{N}}]){_TITLE} {_PART}(?: {_PART})?(?![\p{{L}}\p{{N}}])",
    "key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    # Up to the next blank or quote, without the marks that end a clause: four signs with a
    # letter or digit behind an equals sign, six with a digit behind a colon.
    "secret": rf"(?i:{_LABELS})(?:\s{{0,3}}[=:]\s{{0,3}}[\"']?(?=[^\s\"']*\d)[^\s\"']{{5,}}{_END}"
    rf"|\s{{0,3}}=[ \t]{{0,3}}[\"']?(?=[^\s\"']*[\p{{L}}\p{{N}}])[^\s\"'=][^\s\"']{{2,}}{_END})",
    "iban": r"(?<![A-Za-z0-9])(?:[A-Z]{2}\d{2}[A-Z0-9]{11,30}"
    rf"|(?=[A-Z]{{2}}\d\d )(?:{_grouped_ibans()}))(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?:(?<!\w)\+\d{1,3}[ .-]?)?(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<!\w)\+1[ .-]?\d{3}[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|(?<!\w)\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)"
    r"|(?=\d)(?<!\w)(?<!\d[.-])(?:(?:1-)?\d{3}-\d{3}-\d{4}|(?:1\.)?\d{3}\.\d{3}\.\d{4})"
    r"(?!\w|[.-]\d)",
    "card": r"(?<![A-Za-z0-9])(?:\d{13,19}|\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}"
    r"|\d{4}[ -]\d{6}[ -]\d{5})(?![A-Za-z0-9])",
}
# What a text with an entity has at least.
HINT = (
    rf"@|\d{{3}}|\+\d|\d\.\d|[A-Z]{{2}}\d\d|AKIA|{_TITLE} (?:{_PARTICLE} |\p{{Lu}})"
    rf"|(?i:{_LABELS})\s{{0,3}}[=:]"
)
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# A secret behind its label.
_VALUE = rf"^((?i:{_LABELS})\s*[=:]\s*[\"']?)(.*)$"
_NUMBERS = ("phone", "card", "ssn")
PATIENCE, MOST_DRAWS = 4, 200
# Country codes of telephone numbers; none begins another.
_CODE = (
    r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
    r"|2[1-689]\d|3[578]\d|42\d|50\d|59\d|6[7-9]\d|8[03578-9]\d|9[679]\d"
)
# Given names by script and gender.
GIVEN = {
    ("latin", "male"): "Adam Bruno Carl David Emil Felix Hugo Ivan Jonas Karl Leon Martin Oscar",
    ("latin", "female"): "Anna Berta Clara Diana Emma Flora Hanna Irene Julia Lena Maria Olga",
    ("greek", "male"): "Γιώργος Νίκος Πέτρος Μάριος Λεωνίδας Στέφανος",
    ("greek", "female"): "Μαρία Ελένη Σοφία Άννα Ειρήνη Δήμητρα",
    ("cyrillic", "male"): "Иван Пётр Павел Сергей Андрей Михаил",
    ("cyrillic", "female"): "Анна Мария Ольга Елена Ирина Вера",
}
# Syllables of made-up family names.
SYLLABLES = {
    "latin": "ba do ke li mo na ri sa te vo lan der mar fen gor hal",
    "greek": "πα μα κο λι νε ρα σι το δα βε",
    "cyrillic": "ба до ке ли мо на ри са те во",
}


def _matches(mention: Column, kind: str) -> Column:
    # Surroundings were looked at when the mention was found.
    return mention.rlike(f"^(?:{PATTERNS[kind]})$")


def _plain_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _luhn_sum(digits: Column, skip_last: bool) -> Column:
    """Check sum of a string of digits; with ``skip_last`` as if the last were 0."""
    values = F.transform(F.reverse(F.split(digits, "")), lambda c: c.try_cast("int"))

    def term(value, place):
        value = F.when((place == 0) & F.lit(skip_last), 0).otherwise(value)
        twice = value * 2
        folded = F.when(twice > 9, twice - 9).otherwise(twice)
        return F.when(place % 2 == 1, folded).otherwise(value)

    return F.aggregate(F.transform(values, term), F.lit(0), lambda a, b: a + b)


def _kind(mention: Column) -> Column:
    """Type of a mention; null for a digit run without a valid check sum."""
    first, *others = [k for k in PATTERNS if k != "card"]
    kind = F.when(_matches(mention, first), first)
    for k in others:
        kind = kind.when(_matches(mention, k), k)
    valid = _matches(mention, "card") & (_luhn_sum(_plain_digits(mention), False) % 10 == 0)
    return kind.when(valid, "card")


def _identity(kind: Column, mention: Column) -> Column:
    # With a plus, digits begin with a country code.
    plus = F.when(mention.rlike(r"^(?:\+|1[.-])"), "+").otherwise("")
    return (
        F.when(kind == "phone", F.concat(plus, _plain_digits(mention)))
        .when(kind.isin(*_NUMBERS), _plain_digits(mention))
        .when(kind == "email", F.lower(mention))
        .when(kind == "iban", F.replace(mention, F.lit(" ")))
        .when(kind == "secret", F.regexp_extract(mention, _VALUE, 2))
        .when(kind == "name", F.concat_ws(" ", _gender(mention), _untitled(mention)))
        .otherwise(mention)
    )


def _gender(mention: Column) -> Column:
    title = F.rtrim(F.regexp_extract(mention, f"^({_TITLE}) ", 1), F.lit("."))
    return F.when(title.isin(*TITLES["female"].split()), "female").otherwise("male")


def _untitled(mention: Column) -> Column:
    return F.regexp_replace(mention, f"^{_TITLE} ", "")


def _is_full(name: Column) -> Column:
    """Whether a name has a given and a family name."""
    return name.rlike(r"^\p{Lu}\S* (?:.* )?\p{Lu}")


def _pick(digest: Column, place: Column, n: int | Column) -> Column:
    return F.pmod(F.xxhash64(digest, place), F.lit(n) if isinstance(n, int) else n).cast("int")


def _reshaped(text: Column, digest: Column) -> Column:
    """Letters and digits replaced by others of their kind and case, the rest kept."""
    hexadecimal = text.rlike("^(?=.*[a-f])[0-9a-f]{8,}$")

    def sign(c, i):
        def of(signs):
            return F.substring(F.lit(signs), _pick(digest, i, len(signs)) + 1, 1)

        return (
            F.when(hexadecimal, of("0123456789abcdef"))
            .when(c.rlike("^[0-9]$"), of("0123456789"))
            .when(c.rlike("^[a-z]$"), of("abcdefghijklmnopqrstuvwxyz"))
            .when(c.rlike("^[A-Z]$"), of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike(r"^\p{N}$"), of("0123456789"))
            .when(c.rlike(r"^\p{Lu}$"), of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike(r"^\p{L}$"), of("abcdefghijklmnopqrstuvwxyz"))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), sign), "")


def _listed(words: str, digest: Column, salt: int) -> Column:
    options = words.split()
    return F.get(F.array(*map(F.lit, options)), _pick(digest, F.lit(salt), len(options)))


def _family(syllables: list[str], digest: Column, attempt: Column) -> Column:
    """A family name, a syllable longer with every attempt, so that there always is another."""
    options = F.array(*map(F.lit, syllables))
    parts = F.transform(
        F.sequence(F.lit(2), attempt + 4),
        lambda i: F.get(options, _pick(digest, i, len(syllables))),
    )
    return F.initcap(F.array_join(parts, ""))


def _name(identity: Column, digest: Column, attempt: Column) -> Column:
    """A name of the gender, script and parts of an identity, without a title."""
    female = F.startswith(identity, F.lit("female "))
    rest = F.substring(identity, F.instr(identity, " ") + 1, F.length(identity))
    script = (
        F.when(rest.rlike(r"\p{IsGreek}"), "greek")
        .when(rest.rlike(r"\p{IsCyrillic}"), "cyrillic")
        .otherwise("latin")
    )
    full = _is_full(rest)
    result = F.lit(None).cast("string")
    for name, syllables in SYLLABLES.items():
        given = F.when(female, _listed(GIVEN[name, "female"], digest, 1)).otherwise(
            _listed(GIVEN[name, "male"], digest, 1)
        )
        family = _family(syllables.split(), digest, attempt)
        both = F.concat_ws(" ", F.when(full, given), family)
        result = F.when(script == name, both).otherwise(result)
    return result


def _surrogate(
    kind: Column, identity: Column, new_domain: Column, attempt: Column, key: str
) -> Column:
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, attempt.cast("string"), identity), 256)
    more = F.greatest(attempt - PATIENCE, F.lit(0))
    filler = F.when(kind.isin("phone", "ssn"), "0").when(
        kind.isin("secret", "email", "domain"), "a"
    )
    # What of an identity is made anew: all, the local part, or all before the last dot.
    top = F.when(kind == "domain", F.regexp_extract(identity, r"(\.[a-z]{2,})$", 1))
    base = (
        F.when(kind == "email", F.substring_index(identity, "@", 1))
        .when(kind == "domain", F.substring(identity, F.lit(1), F.length(identity) - F.length(top)))
        .otherwise(identity)
    )
    longer = F.concat(base, F.coalesce(F.repeat(filler, more), F.lit("")))
    shaped = _reshaped(longer, digest)
    email = F.concat(shaped, F.lit("@"), new_domain)
    octets = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: _pick(digest, i, 254) + 1)
    body = F.concat(
        F.substring(identity, 1, 1),
        F.substring(shaped, F.lit(2), F.length(identity) - 2),
    )
    code = F.regexp_extract(identity, rf"^(\+(?:{_CODE}))", 1)
    phone = F.concat(code, F.substring(shaped, F.length(code) + 1, F.length(shaped)))
    check = F.pmod(10 - _luhn_sum(F.concat(body, F.lit("0")), True) % 10, F.lit(10))
    return (
        F.when(kind == "email", email)
        .when(kind == "domain", F.concat(shaped, top))
        .when(kind == "ip", F.array_join(octets, "."))
        .when(kind == "card", F.concat(body, check.cast("string")))
        .when(kind == "phone", phone)
        .when(kind == "key", F.concat(F.lit("AKIA"), F.substring(shaped, 5, 16)))
        .when(kind == "name", _name(identity, digest, attempt))
        .otherwise(shaped)
    )


def _rendered(kind: Column, mention: Column, surrogate: Column) -> Column:
    """A surrogate in the form of a mention: the signs of numbers put in their places, secrets
    behind their labels, names behind their titles, addresses with capitals where they were."""

    def signs(text):
        return F.regexp_replace(text, "[^A-Z0-9]", "")

    filled = F.transform(
        F.split(mention, ""),
        lambda c, i: F.when(
            c.rlike("^[A-Z0-9]$"),
            F.substring(
                signs(surrogate),
                F.length(signs(F.substring(mention, F.lit(1), i + 1))),
                F.lit(1),
            ),
        ).otherwise(c),
    )
    # A longer surrogate goes on behind the last place.
    places = F.length(signs(mention))
    surplus = F.substring(signs(surrogate), places + 1, F.length(surrogate))
    number = F.concat(F.array_join(filled, ""), surplus)
    secret = F.concat(F.regexp_extract(mention, _VALUE, 1), surrogate)
    title = F.regexp_extract(mention, f"^({_TITLE}) ", 1)
    capitals = F.transform(
        F.split(surrogate, ""),
        lambda c, i: F.when(F.get(F.split(mention, ""), i).rlike("^[A-Z]$"), F.upper(c)).otherwise(c),
    )
    return (
        F.when(kind.isin(*_NUMBERS, "iban"), number)
        .when(kind == "secret", secret)
        .when(kind == "name", F.concat_ws(" ", title, surrogate))
        .when(kind == "email", F.array_join(capitals, ""))
        .otherwise(surrogate)
    )


def _written(name: str) -> Column:
    """What a value is compared by: of a phone the digits behind the country code, which may
    be written alone, of a name the name itself."""
    value = F.col(name)
    return (
        F.when(F.col("kind") == "phone", _plain_digits(_national(value)))
        .when(F.col("kind") == "name", F.regexp_replace(value, "^(?:fe)?male ", ""))
        .otherwise(value)
    )


def _national(identity: Column) -> Column:
    return F.regexp_replace(identity, rf"^\+(?:{_CODE})", "")


def _drawn(identities: DataFrame, key: str) -> DataFrame:
    """kind, identity and surrogate of distinct (kind, identity, new_domain). Those that lose
    are drawn again, and compared with what all others have by then."""
    names = ("kind", "identity", "new_domain")
    state = stored(identities.select(*names, F.lit(0).alias("attempt")), "pii")
    originals = state.select("kind", _written("identity").alias("written")).distinct()
    originals = stored(originals.withColumn("real", F.lit(True)), "pii")
    kept = None
    for _ in range(MOST_DRAWS):
        made = _surrogate(*map(F.col, names), F.col("attempt"), key)
        drawn = state.withColumn("surrogate", made).withColumn("written", _written("surrogate"))
        drawn = stored(drawn, "pii")
        owners = drawn.groupBy("kind", "written").agg(F.min("identity").alias("owner"))
        judged = drawn.join(owners, ["kind", "written"]).join(
            originals, ["kind", "written"], "left"
        )
        again = (F.col("owner") != F.col("identity")) | F.col("real").isNotNull()
        if kept is not None:
            taken = kept.select("kind", "written", F.lit(True).alias("taken"))
            judged = judged.join(taken, ["kind", "written"], "left")
            again |= F.col("taken").isNotNull()
        judged = judged.withColumn("again", again)
        judged = stored(
            judged.select(*names, "attempt", "surrogate", "written", "again"), "pii"
        )
        won = judged.where("NOT again").select("kind", "identity", "surrogate", "written")
        kept = won if kept is None else kept.unionByName(won)
        state = judged.where("again").select(*names, (F.col("attempt") + 1).alias("attempt"))
        if state.isEmpty():
            return kept.select("kind", "identity", "surrogate")
    raise ValueError(f"no free surrogates after {MOST_DRAWS} draws")


def _one_number(entities: DataFrame) -> DataFrame:
    """Phones without a country code as the one number that the corpus has with one, if there
    is exactly one; ``short`` says which these are. ``entities`` are stored."""
    phone = F.col("kind") == "phone"
    coded = F.startswith(F.col("identity"), F.lit("+"))
    whole = (
        entities.where(phone & coded)
        .groupBy(_national(F.col("identity")).alias("_digits"))
        .agg(F.min("identity").alias("_whole"), F.max("identity").alias("_other"))
        .where(F.col("_whole") == F.col("_other"))
        .select("_digits", "_whole")
    )
    bare = entities.where(phone & ~coded).join(whole, F.col("identity") == F.col("_digits"), "left")
    # All else has nothing to look up and stays out of the join.
    others = entities.where(~phone | coded).withColumn("short", F.lit(False))
    return others.unionByName(
        bare.select(
            "kind",
            "mention",
            F.coalesce("_whole", "identity").alias("identity"),
            "times",
            F.col("_whole").isNotNull().alias("short"),
        )
    )


def distinct_surrogates(identities: DataFrame, key: str) -> DataFrame:
    """kind, identity and surrogate of distinct (kind, identity)."""
    none = F.lit(None).cast("string")
    domain = F.when(F.col("kind") == "email", F.substring_index("identity", "@", -1))
    rows = stored(identities.select("kind", "identity", domain.alias("domain")), "identities")
    emails = rows.where("domain IS NOT NULL")
    counted = stored(emails.groupBy("domain").agg(F.count(F.lit(1)).alias("times")), "domains")
    domains = counted.select(
        F.lit("domain").alias("kind"), F.col("domain").alias("identity"), none.alias("new_domain")
    )
    drawn = _drawn(domains, key).select("identity", F.col("surrogate").alias("new_domain"))
    known = counted.join(drawn, F.col("domain") == F.col("identity")).drop("identity")
    placed = join_counted(emails, stored(known, "new-domains"), "domain", "times")
    others = rows.where("domain IS NULL").withColumn("new_domain", none)
    return _drawn(placed.unionByName(others), key)


def replace_personal_data(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in their texts and a column n_entities."""
    found = F.regexp_extract_all("text", F.lit(ANY), F.lit(0))
    exploded = (
        docs.where(F.col("text").rlike(HINT))
        .select("doc_id", F.xxhash64("text").alias("text_hash"), found.alias("found"))
        .select("doc_id", "text_hash", F.posexplode("found").alias("place", "mention"))
    )
    mentions = stored(
        exploded.withColumn("kind", _kind(F.col("mention"))).distinct(), "mentions"
    )
    counted = mentions.where("kind IS NOT NULL").groupBy("kind", "mention")
    entities = counted.agg(F.count(F.lit(1)).alias("times")).select(
        "kind", "mention", _identity(F.col("kind"), F.col("mention")).alias("identity"), "times"
    )
    entities = stored(_one_number(stored(entities, "counted")), "entities")
    known = distinct_surrogates(entities.select("kind", "identity").distinct(), key)
    value = F.when(F.col("short"), _national(F.col("surrogate"))).otherwise(F.col("surrogate"))
    name = _untitled(F.col("mention"))
    entity = F.struct("kind", "mention").alias("entity")
    rendered = entities.join(known, ["kind", "identity"]).select(
        entity,
        "times",
        _rendered(F.col("kind"), F.col("mention"), value).alias("surrogate"),
        F.when(
            (F.col("kind") == "name") & _is_full(name),
            F.struct(name.alias("name"), F.col("surrogate").alias("other")),
        ).alias("person"),
    )
    at = ("doc_id", "text_hash", "place")
    told = join_counted(
        mentions.where("kind IS NOT NULL").select(*at, entity),
        stored(rendered, "rendered"),
        "entity",
        "times",
    ).drop("entity")
    stays = mentions.where("kind IS NULL").select(
        *at, *[F.lit(None).cast(told.schema[c].dataType).alias(c) for c in ("surrogate", "person")]
    )
    # In order of place, the surrogate or null for what stays.
    placed = F.sort_array(F.collect_list(F.struct("place", "surrogate")))
    by_document = (
        told.unionByName(stays)
        .groupBy("doc_id", "text_hash")
        .agg(
            F.transform(placed, lambda x: x["surrogate"]).alias("new"),
            F.sort_array(F.collect_set("person")).alias("persons"),
        )
        .where(F.exists("new", lambda x: x.isNotNull()))
    )
    rows = docs.select(as_row(docs), F.xxhash64("text").alias("hash"))
    matched = rows.join(
        by_document,
        F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")),
        "left",
    )
    found = F.regexp_extract_all("row.text", F.lit(ANY), F.lit(0))
    def bare(person):
        return F.concat(
            F.lit(r"(?<![\p{L}\p{N}])"), person["name"], F.lit(r"(?![\p{L}\p{N}])")
        )

    def renamed(piece):
        return F.aggregate(
            F.col("persons"),
            piece,
            lambda text, person: F.regexp_replace(text, bare(person), person["other"]),
        )

    between = F.split("row.text", ANY, -1)
    mixed = F.zip_with(
        F.when(F.size("persons") > 0, F.transform(between, renamed)).otherwise(between),
        F.zip_with(found, "new", lambda old, new: F.coalesce(new, old)),
        lambda piece, value: F.concat(piece, F.coalesce(value, F.lit(""))),
    )
    same = F.col("new").isNull()
    text = F.when(same, F.col("row.text")).otherwise(F.array_join(mixed, ""))
    rest = F.array_join(between, "\x1f")
    repeats = F.aggregate(
        F.col("persons"), F.lit(0), lambda n, person: n + F.regexp_count(rest, bare(person))
    )
    count = F.size(F.filter("new", lambda x: x.isNotNull())) + repeats
    return matched.select(
        *[
            text.alias(c) if c == "text" else F.col(f"row.`{c}`")
            for c in docs.columns
            if c != "n_entities"
        ],
        F.when(same, F.lit(0)).otherwise(count).alias("n_entities"),
    )
