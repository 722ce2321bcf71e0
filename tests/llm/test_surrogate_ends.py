"""Mentions are taken to their real end, in any case, against a scanner without patterns."""

import random

import pytest

from pairmill.llm import surrogates

SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
TITLES = {t.lower() for t in (*surrogates.MALE, *surrogates.FEMALE, *surrogates.NEUTRAL)}


def secrets_in(text):
    """What follows a keyword, by looking at one sign after the other."""
    low, found = text.lower(), []
    for word in surrogates.KEYWORDS:
        at = low.find(word)
        while at >= 0:
            i = at + len(word)
            while i < len(text) and text[i] in " \t":
                i += 1
            if i < len(text) and text[i] in "=:":
                i += 1
                while i < len(text) and text[i] in " \t\"'":
                    i += 1
                end = i
                while end < len(text) and (text[end] in SIGNS or text[end] in "._/+~-"):
                    end += 1
                value = text[i:end].rstrip(".")
                found += [value] if len(value) >= 8 else []
            at = low.find(word, at + 1)
    return found


def names_in(text):
    """Words with a capital behind a form of address."""
    found, words = [], text.replace("\n", " | ").split()
    for i, word in enumerate(words):
        if word.lower().rstrip(".") in TITLES and i + 1 < len(words):
            for name in words[i + 1 :]:
                if name.lower().rstrip(".") in TITLES or not name[0].isupper():
                    break
                found.append(name.rstrip(".,;!?|"))
                if name != found[-1]:
                    break
    return [n for n in found if len(n) > 1]


def phones_in(text):
    """Digits behind a plus, as long as at most one sign stands between them."""
    found = []
    for i, c in enumerate(text):
        if c == "+":
            digits, gap = "", 0
            for x in text[i + 1 :]:
                gap = 0 if x.isdigit() else gap + 1
                if gap > 1 or not (x.isdigit() or x in " .-"):
                    break
                digits += x if x.isdigit() else ""
            found += [digits] if len(digits) >= 7 else []
    return found


def planted(seed):
    rng = random.Random(seed)
    made = lambda n: "".join(rng.choice(SIGNS) for _ in range(n))
    name = lambda n: "".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(n)).title()
    word, key = rng.choice(("api_key", "Token", "PASSWORD", "secret")), rng.choice((" = ", "=", "   =\t", ": ", " : \"", "='"))
    secret = rng.choice((made(12), made(700), ".".join(made(rng.randint(20, 300)) for _ in range(3))))
    title = rng.choice(("Dr", "dr.", "FRAU", "Mr", "Prof. Dr.", "Señora"))
    full = " ".join(name(3) for _ in range(rng.randint(1, 5))) + rng.choice(("", "-" + name(3)))
    # One sign between all groups: with mixed ones they may make a network address.
    gap = rng.choice(" .-")
    phone = "+" + str(rng.randint(10, 99)) + "".join(
        gap + str(rng.randint(1, 9)) * rng.randint(1, 3) for _ in range(rng.randint(6, 9))
    )
    return f"there {word}{key}{secret}, then {title} {full}, call {phone} now."


@pytest.mark.parametrize("upper", [False, True])
def test_mentions_go_to_their_end(spark, upper):
    texts = [planted(i) for i in range(120)]
    texts = [t.upper() for t in texts] if upper else texts
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in surrogates.pseudonymize(df).select("doc.doc_id", "replaced", "n_entities").collect()}
    for i, text in enumerate(texts):
        new, secrets, names, phones = out[i].replaced, secrets_in(text), names_in(text), phones_in(text)
        assert len(secrets) == 1 and names and len(phones) == 1, text
        assert out[i].n_entities == 3, text
        for value in secrets:
            made = secrets_in(new)[0]
            assert len(made) == len(value), text
            assert all(a != b for a, b in zip(made.split("."), value.split("."), strict=True)), text
        assert not {n.lower() for n in names} & {n.lower() for n in names_in(new)}, text
        assert [len(p) for p in phones_in(new)] == [len(p) for p in phones]
        for old, made in zip(phones, phones_in(new), strict=True):
            assert old[3:] != made[3:] and sum(a == b for a, b in zip(old[3:], made[3:], strict=True)) < len(old[3:])
        # All else stays.
        assert new.split()[0] == text.split()[0] and new[-5:] == text[-5:]


def test_listed_cases(spark):
    texts = {
        'TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!! x': ["9233A8EC", "E9329B"],
        "call +49 30 12 34 56 78 or +33 1 45 67 89 10.": ["56 78", "89 10"],
        "call +49 (30) 1234-5678-90 and (030) 12 34 56 78!": ["5678-90", "56 78"],
        "Dr Anna Maria Schmidt and Prof. Dr. Hans-Peter  O'Brien spoke": ["Schmidt", "Peter", "Brien"],
        "Mr Smith's friend is MRS. J. R. JONES; Dr Anna M. Weber": ["Smith", "JONES", "Weber"],
        "mail a@b.c1.c2.c3.c4.c5.c6.c7.c8.c9.org": ["c8"],
        "password=" + "a1" * 400 + "Tail99": ["Tail99"],
        "token\t:\teyJhbGciOi.eyJzdWIiOi.c2lnbmF0dXJl.": ["eyJzdWIi", "c2lnbmF0"],
        "Mr Smith Mr Jones and nothing else": ["Smith", "Jones"],
    }
    df = spark.createDataFrame([(t, 1) for t in texts], "text string, doc_id int")
    rows = surrogates.pseudonymize(df).select("doc.text", "replaced").collect()
    for r in rows:
        assert not [x for x in texts[r.text] if x in r.replaced], r
    new = {r.text: r.replaced for r in rows}
    assert new["Mr Smith Mr Jones and nothing else"].endswith(" and nothing else")
    long = next(t for t in new if t.startswith("Mr Smith's"))
    assert "'s friend is MRS. " in new[long] and "; Dr " in new[long]
    assert next(new[t] for t in new if t.startswith("Dr Anna")).count("  ") == 1


def test_phone_ends_before_an_address_or_a_card(spark):
    text = "call +1 (826) 555-4081 190.137.223.204 or +49 30 123456 4041 8949 7460 8795"
    df = spark.createDataFrame([(text, 1)], "text string, doc_id int")
    assert [r.n_entities for r in surrogates.pseudonymize(df).collect()] == [4]
