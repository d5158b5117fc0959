"""Titles, genders, persons and numbers that are one, and forms that are kept."""

import re

import brute
import pytest

from jobstrata.llm import queries, surrogates

SAMPLES = {
    "latin": ("Anna", "Lee"),
    "greek": ("Νίκη", "Παππά"),
    "cyrillic": ("Мария", "Иванова"),
}


def replaced(spark, *texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = surrogates.replace_personal_data(df, key).collect()
    return [r.text for r in sorted(rows)]


def given_names(script, gender):
    return set(surrogates.GIVEN[script, gender].split())


def test_every_title_keeps_itself_and_its_gender(spark):
    cases = [
        (title + dot, gender, script)
        for gender, titles in surrogates.TITLES.items()
        for title in titles.split()
        for dot in ("", ".")
        for script in SAMPLES
    ]
    texts = [f"x {t} {' '.join(SAMPLES[s])}, y" for t, _, s in cases]
    for (title, gender, script), new in zip(cases, replaced(spark, *texts)):
        start, given, family = re.fullmatch(r"(x \S+) (\S+) (\S+), y", new).groups()
        assert start == f"x {title}" and given in given_names(script, gender)
        assert (given, family) != SAMPLES[script]


def test_one_person_one_surrogate(spark):
    first, second, third, other = replaced(
        spark,
        "Mr John Smith met Mr. John Smith. John Smith left; John Smithson and John stayed.",
        "Herr John Smith, not John Smith's brother. xJohn Smith",
        "John Smith stands alone here.",
        "Mrs John Smith and Mr Smith.",
    )
    person = re.match(r"Mr (\S+ \S+) met", first)[1]
    assert first == f"Mr {person} met Mr. {person}. {person} left; John Smithson and John stayed."
    assert second == f"Herr {person}, not {person}'s brother. xJohn Smith"
    assert third == "John Smith stands alone here."
    assert person not in other and "Smith" not in other and other.startswith("Mrs ")


@pytest.mark.parametrize(
    "name",
    ["Jean-Luc Picard", "Sean O'Brien", "Ludwig van Beethoven", "de la Cruz", "Ronan McCoy",
     "Ana de la Cruz", "Anne-Marie Saint-Exupéry"],
)
def test_whole_names_are_replaced(spark, name):
    (new,) = replaced(spark, f"To Mrs. {name}: hello")
    assert re.fullmatch(r"To Mrs\. \w+( \w+)?: hello", new)
    assert not set(re.findall(r"\w{3,}", name)) & set(re.findall(r"\w+", new))


def test_near_misses_stay(spark):
    texts = ["Mrs and Mr", "Mr smith", "xMr Smith", "Sra", "Mister Smith", "Mr  Smith", "Msx Anna Lee"]
    assert replaced(spark, *texts) == texts


def test_numbers_with_and_without_a_country_code(spark):
    a, b, c, d = replaced(
        spark,
        "call (212) 555-0100 or +1 (212) 555-0100",
        "1-212-555-0100 and 212.555.0100",
        "+1 (303) 555-0101, +7 (303) 555-0101",
        "(303) 555-0101",
    )
    digits = lambda text: re.findall(r"\+?[\d() .-]{12,}", text)
    plain = lambda text: re.sub(r"\D", "", text)
    short, whole = (plain(x) for x in digits(a))
    assert whole == "1" + short and short != "2125550100"
    assert [plain(x) for x in digits(b)] == [whole, short]
    first, second = (plain(x) for x in digits(c))
    # Two numbers with these digits: the one without a code is a third.
    assert len({first[1:], second[1:], plain(d)}) == 3


def test_capitals_of_addresses(spark):
    (new,) = replaced(spark, "A.B@x.org, a.b@x.org, Info@Shop.example.com")
    one, two, three = new.split(", ")
    assert one != two and one.lower() == two
    assert [c.isupper() for c in one[:3]] == [True, False, True]
    assert three[0].isupper() and three.split("@")[1][0].isupper()


def test_small_spaces_are_drawn_to_the_end(spark):
    """More identities than free values of their form: losers are drawn again, and longer."""
    locals_ = "abcdefghijklmnopqrstuvwxyz"
    (new,) = replaced(spark, " ".join(f"{c}@x.org" for c in locals_))
    found = new.split()
    assert len(set(found)) == 26 and not set(found) & {f"{c}@x.org" for c in locals_}


def test_whole_table_against_a_plain_detector(spark):
    """Every mention that a walk along the texts finds is replaced, one identity by one other,
    in its form, and nothing else is touched."""
    data = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    known, mentions, kinds = {}, 0, set()
    for row in queries.QUERIES["op6_surrogates"](spark, data).collect():
        text = texts[row.doc_id]
        if text is None:
            assert row.text is None
            continue
        found = brute.personal_mentions(text)
        assert row.n_entities == len(found), (row.doc_id, found)
        cuts = [0, *(x for m in found for x in m[:2]), len(text)]
        pieces = [re.escape(text[a:b]) for a, b in zip(cuts[::2], cuts[1::2])]
        match = re.fullmatch("(.+?)".join(pieces), row.text, re.S)
        assert match
        for (start, end, kind, identity), new in zip(found, match.groups()):
            old, form = text[start:end], lambda s: re.sub(r"[A-Za-z]", "a", re.sub(r"\d", "0", s))
            made = re.sub(r"\D", "", new) if kind == "phone" else new.lower() if kind == "email" else new
            assert known.setdefault((kind, identity), made) == made
            if kind in ("phone", "card", "secret"):
                assert form(new) == form(old) or kind == "secret" and len(new) == len(old)
            if kind == "phone":
                assert new.startswith("+1 (")
            if kind == "card":
                assert brute._luhn(new) and new[0] == old[0]
            if kind == "ip":
                assert all(0 < int(p) < 255 for p in new.split("."))
            mentions += 1
            kinds.add(kind)
    assert mentions > 60 and kinds == {"email", "phone", "secret", "ip", "card"}
    assert len(set(known.items())) == len({(k[0], v) for k, v in known.items()})
    assert not {(k, v) for (k, _), v in known.items()} & set(known)
