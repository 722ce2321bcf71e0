"""Surrogates for personal data (operator 3). DataFrame functions only.

Mail addresses, phone numbers, card numbers, network addresses, access keys, secrets and
names behind a form of address are found by one pattern. Each is brought to a normal form
and replaced by one of the same type: letters by letters and digits by digits in the same
format, a card number by one that passes the check-digit test, a name by an invented one
of the same gender and script. The replacement comes from a keyed digest of the normal
form, so the same entity has the same surrogate in all documents and formats.

All different entities of the corpus are gathered, and where two would get one surrogate,
or one that is a real entity, all but the first try again with the next attempt number,
until none is left. Documents are then rewritten in place; only entities with a later
attempt, which are few, are looked up by document.

Secrets, names, phone numbers and mail addresses have no greatest length: each goes on to
its real end. A keyword or a form of address counts in any case. A secret has eight signs or
more and ends before a blank, a quote, a bracket, a comma, `;`, `&`, `|` or a backslash. A name
goes on as long as words with a capital follow; in a text of capitals that is up to the next
other sign, so words behind a name are replaced too rather than part of a name left. A word
without a capital ends a name (also a particle such as `von`).

Defined cases: a null text stays null and has no entity; a text without entities stays as
it is; rows that repeat a doc_id are rewritten one by one; a null doc_id is an id like any
other; columns keep their names, whatever they are; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.llm.common import lookup
from pairmill.session import durable

KEY = "change this key"
LAST_ID = (1 << 63) - 1

# Forms of address, by gender. Fixed values.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа")
NEUTRAL = ("Dr", "Prof")

# Words that announce a secret. Fixed values.
KEYWORDS = ("password", "passwd", "pwd", "token", "secret", "api_key", "apikey")


def _any_case(words: tuple[str, ...]) -> str:
    """One of the words in any case; a look at the first letter passes over most places."""
    first = sorted({c for w in words for c in w[0].lower() + w[0].upper()})
    return "(?=[" + "".join(first) + "])(?iu:" + "|".join(words) + ")"


EMAIL = r"(?<![\w.%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
ADDRESS = r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)"
CARD = r"(?<![\w.])\d(?:[ -]?\d){12,18}(?![\w])"
# With a country code or an area code in brackets: all groups of digits that follow, up to
# a network address or, behind two groups, a card number.
_SEP = r"[ \u00a0./-]?+"
_CARD_NEXT = r"(?!\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}(?!\w)|\d{13,19}(?!\w))"
_GROUP = _SEP + "(?!" + ADDRESS + r")\d++"
_GROUPS = "(?:" + _GROUP + "){1,2}+(?:" + _SEP + "(?!" + ADDRESS + ")" + _CARD_NEXT + r"\d++)*+"
PHONE = (
    r"(?<![\w+])\+\d{1,4}\)?+" + _SEP + r"\(\d{1,5}\)(?=(?:" + _SEP + r"\d){5})" + _GROUPS
    + r"|(?<![\w+])\+(?=\d(?:" + _SEP + r"\d){4}|\d{1,4}\)(?:" + _SEP + r"\d){4})"
    + r"(?!\d++\)?+" + _SEP + ADDRESS + r")\d++\)?+(?:" + _GROUPS + ")?+"
    r"|(?<![\w+])\(\d{2,5}\)(?=(?:" + _SEP + r"\d){6})" + _GROUPS
    + r"|(?<![\w.+-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d.-]*\d)"
)
ACCESS = r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
# A keyword in any case, quotes and blanks; the secret is what follows, up to its last sign.
_BLANK = r"[ \t\u00a0]"
_SECRET_LEAD = _any_case(KEYWORDS) + r"[\"']?+" + _BLANK + "*+[=:]" + _BLANK + r"*+[\"']?+"
SECRET = _SECRET_LEAD + r"[A-Za-z0-9_/+~.=:@!#$%^*?-]{7,}[A-Za-z0-9_/+~-]"
# Forms of address in any case, and all words with a capital behind them: with hyphens,
# after O' and the like, or as initials.
_TITLE = _any_case((*MALE, *FEMALE, *NEUTRAL)) + r"\.?" + _BLANK + "++"
_WORD = (
    r"(?:(?:\p{Lu}\p{L}?['’])?\p{Lu}[\p{L}\p{M}‐‑-]*[\p{L}\p{M}]"
    r"|\p{Lu}(?:\.-?\p{Lu})*+\.?(?=" + _BLANK + r"++\p{Lu}))"
)
_NAME_START = r"(?=\p{L})(?<!\p{L})"
_NAME_LEAD = "(?:(?:" + _TITLE + ")++(?=" + _WORD + ")|" + _TITLE + "(?=" + _WORD + "))"
NAME = _NAME_START + _NAME_LEAD + _WORD + "(?:" + _BLANK + "++(?!" + _TITLE + ")" + _WORD + ")*+"
# Longer forms first: a card number must not lose its head to a phone number.
ANY = "|".join((EMAIL, SECRET, ACCESS, ADDRESS, CARD, PHONE, NAME))

SYLLABLES = {
    "latin": "ba be do du fa fe ga go ka ki la lo ma mi na no pa pe ra ro sa si ta to va vi za zo".split(),
    "cyrillic": "ба бе до ду фа фе га го ка ки ла ло ма ми на но па пе ра ро са си та то ва ви за зо".split(),
}
ENDINGS = {
    "latin": {"m": ["n", "rt", "s", "k"], "f": ["lia", "na", "ra", "tta"], "": ["ner", "mont", "ley", "son"]},
    "cyrillic": {"m": ["н", "рт", "с", "к"], "f": ["лия", "на", "ра", "тта"], "": ["ко", "нюк", "дзе", "ян"]},
}
CYRILLIC = r"\p{IsCyrillic}"


def mentions_of(text: Column) -> Column:
    """All mentions in order; texts that can have none are passed over quickly."""
    some = text.rlike("|".join(("[0-9@]", "AKIA", _any_case(KEYWORDS), _NAME_START + _TITLE)))
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    return F.when(some, found).when(text.isNotNull(), F.array().cast("array<string>"))


def _lead(mention: Column) -> Column:
    """What stays of a secret or a name: keyword and signs, or forms of address."""
    return F.regexp_extract(mention, "^(?:" + _SECRET_LEAD + "|" + _NAME_LEAD + ")", 0)


def _value(mention: Column) -> Column:
    return F.substring(mention, F.length(_lead(mention)) + 1, F.length(mention))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def kind_of(mention: Column) -> Column:
    """Type of a mention; what follows a keyword may be of another type than secret."""
    value = _value(mention)
    whole = lambda p: value.rlike(r"^(?:" + p + r")$")
    return (
        F.when(mention.rlike("^" + _NAME_LEAD), "name")
        .when(mention.contains("@"), F.when(_lead(mention) == "", "email").otherwise("secret"))
        .when(whole(ACCESS), "access")
        .when(whole(r"\d{1,3}(?:\.\d{1,3}){3}"), "address")
        .when(whole(r"\d(?:[ -]?\d){12,18}"), "card")
        .when(whole(r"[\d+ \u00a0/().-]+") & (F.length(_digits(value)) >= 7) & value.rlike(r"^[+(]|[ .-]"), "phone")
        .otherwise("secret")
    )


def _words(name: Column) -> Column:
    """The words of a name without its forms of address."""
    return F.split(name, _BLANK + "+")


def _gender(lead: Column) -> Column:
    holds = lambda titles: lead.rlike(r"(?iu)(?<!\p{L})(?:" + "|".join(titles) + r")\.?" + _BLANK)
    return F.when(holds(FEMALE), "f").when(holds(MALE), "m").otherwise("n")


def entities_of(mention: Column, kind: Column) -> Column:
    """`kind, norm` of a mention of that kind: one, or one per word of a name."""
    value = _value(mention)
    digits = _digits(value)
    # Without the country code; of a longer run all but as many digits as a code has.
    number = F.right(digits, F.greatest(F.lit(10), F.length(digits) - 3))
    norm = (
        F.when(kind == "email", F.lower(value))
        .when(kind == "phone", number)
        .when(kind == "card", digits)
        .otherwise(value)
    )
    words = _words(value)
    given = F.concat(F.lit("given-"), _gender(_lead(mention)))
    named = F.transform(
        words,
        lambda w, i: F.struct(
            F.when(i < F.size(words) - 1, given).otherwise("family").alias("kind"), F.lower(w).alias("norm")
        ),
    )
    single = F.array(F.struct(kind.alias("kind"), norm.alias("norm")))
    return F.when(kind == "name", named).otherwise(single)


def _digest(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """128 hexadecimal signs that only the key's holder can make."""
    said = F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string"))
    return F.concat(F.sha2(F.concat(F.lit("0"), said), 256), F.sha2(F.concat(F.lit("1"), said), 256))


def _byte(digest: Column, i: Column) -> Column:
    """Number i of the digest, 0..255; the digest repeats after 63."""
    return F.conv(F.substring(digest, i % 63 * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _picked(signs: str, digest: Column, i: Column) -> Column:
    return F.substring(F.lit(signs), _byte(digest, i) % len(signs) + 1, F.lit(1))


def _masked(text: Column, digest: Column) -> Column:
    """Each letter or digit replaced by one of its class; hexadecimal text stays such."""
    signs = F.filter(F.split(text, ""), lambda c: c != "")
    lower, upper, digit = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    hexed = text.rlike("^[0-9a-f]{8,}$") & text.rlike("[a-f]")
    classed = F.transform(
        signs,
        lambda c, i: F.when(c.rlike("[a-z]"), _picked(lower, digest, i))
        .when(c.rlike("[A-Z]"), _picked(upper, digest, i))
        .when(c.rlike("[0-9]"), _picked(digit, digest, i))
        .otherwise(c),
    )
    plain = F.transform(signs, lambda c, i: _picked("0123456789abcdef", digest, i))
    return F.array_join(F.when(hexed, plain).otherwise(classed), "")


def _check_digit(digits: Column) -> Column:
    """The digit that makes a card number, given without it, pass the usual test."""
    signs = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    doubled = F.transform(
        signs,
        lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(
            c.cast("int")
        ),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, b: a + b)
    return ((10 - total % 10) % 10).cast("string")


def _invented(kind: Column, norm: Column, attempt: Column, digest: Column) -> Column:
    """A name of the same script and, if given, gender; later attempts are longer."""
    count = F.when(kind == "family", 3).otherwise(2) + F.floor(attempt / 4).cast("int")

    def made(script: str) -> Column:
        table = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        parts = F.transform(
            F.sequence(F.lit(1), count), lambda i: F.element_at(table, _byte(digest, i) % len(SYLLABLES[script]) + 1)
        )
        tails = {g: F.array(*[F.lit(e) for e in ends]) for g, ends in ENDINGS[script].items()}
        either = F.when(_byte(digest, F.lit(60)) % 2 == 0, tails["m"]).otherwise(tails["f"])
        tail = (
            F.when(kind == "given-m", tails["m"])
            .when(kind == "given-f", tails["f"])
            .when(kind == "given-n", either)
            .otherwise(tails[""])
        )
        return F.concat(F.array_join(parts, ""), F.element_at(tail, _byte(digest, F.lit(0)) % 4 + 1))

    return F.when(norm.rlike(CYRILLIC), made("cyrillic")).otherwise(made("latin"))


def _with(x: Column, names: tuple[str, ...], **more: Column) -> Column:
    return F.struct(*[x[n].alias(n) for n in names], *[c.alias(n) for n, c in more.items()])


def surrogates_of(key: str, entities: Column) -> Column:
    """Replacements of an array of `kind, norm, attempt`, in normal form.

    Each step is a list of its own, so that what it computes is computed once.
    """
    base = ("kind", "norm", "attempt")
    e = F.transform(
        entities, lambda x: _with(x, base, digest=_digest(key, x["kind"], x["norm"], x["attempt"]))
    )
    e = F.transform(e, lambda x: _with(x, (*base, "digest"), masked=_masked(x["norm"], x["digest"])))
    head = lambda x: F.concat(
        F.substring(x["norm"], 1, 1), F.substring(x["masked"], F.lit(2), F.length(x["norm"]) - 2)
    )
    top = lambda x: F.regexp_extract(x["norm"], r"(\.[^.@]+)$", 1)
    e = F.transform(e, lambda x: _with(x, (*base, "digest", "masked"), head=head(x), top=top(x)))

    def made(x: Column) -> Column:
        kind, norm, masked, digest = x["kind"], x["norm"], x["masked"], x["digest"]
        body = F.substring(masked, F.lit(1), F.length(norm) - F.length(x["top"]))
        octets = [(_byte(digest, F.lit(i)) % 254 + 1).cast("string") for i in range(4)]
        named = kind.isin("family", "given-m", "given-f", "given-n")
        return (
            F.when(kind == "email", F.concat(body, x["top"]))
            .when(kind == "card", F.concat(x["head"], _check_digit(x["head"])))
            .when(kind == "address", F.concat_ws(".", *octets))
            .when(kind == "access", F.concat(F.lit("AKIA"), F.substring(masked, F.lit(5), F.length(norm))))
            .when(named, _invented(kind, norm, x["attempt"], digest))
            .otherwise(masked)
        )

    return F.transform(e, made)


def _filled(mention: Column, digits: Column) -> Column:
    """The mention with its last digits replaced by `digits`, all else as it is."""
    signs = F.filter(F.split(mention, ""), lambda c: c != "")
    before = F.length(_digits(mention)) - F.length(digits)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def step(state: Column, c: Column) -> Column:
        is_digit = c.rlike("[0-9]")
        mine = F.substring(digits, state["k"] - before + 1, F.lit(1))
        sign = F.when(is_digit & (state["k"] >= before), mine).otherwise(c)
        return F.struct(
            F.concat(state["out"], sign).alias("out"),
            (state["k"] + F.when(is_digit, 1).otherwise(0)).alias("k"),
        )

    return F.aggregate(signs, start, step, lambda s: s["out"])


def _cased(word: Column, like: Column) -> Column:
    return (
        F.when((like == F.upper(like)) & like.rlike(r"\p{L}[^.]*\p{L}"), F.upper(word))
        .when(F.substring(like, 1, 1) != F.lower(F.substring(like, 1, 1)), F.initcap(word))
        .otherwise(word)
    )


def _same_case(text: Column, like: Column) -> Column:
    """Text of the same length, in upper case where the other is."""
    signs = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    return F.array_join(
        F.zip_with(signs(text), signs(like), lambda a, b: F.when(b.rlike("[A-Z]"), F.upper(a)).otherwise(a)), ""
    )


def replacements(key: str, mentions: Column, later: Column) -> Column:
    """Each mention's replacement. `later`: `kind, norm, attempt` of entities beyond attempt 0."""

    def tried(e: Column) -> Column:
        own = F.filter(later, lambda x: (x["kind"] == e["kind"]) & (x["norm"] == e["norm"]))
        attempt = F.coalesce(F.get(own, F.lit(0))["attempt"], F.lit(0))
        return _with(e, ("kind", "norm"), attempt=attempt)

    def written(x: Column) -> Column:
        m, kind, one = x["m"], x["kind"], F.get(x["made"], F.lit(0))
        value = _value(m)
        gaps = F.regexp_extract_all(value, F.lit("(" + _BLANK + "+)"), F.lit(1))
        named = F.zip_with(x["made"], _words(value), _cased)
        named = F.array_join(F.zip_with(named, gaps, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
        new = (
            F.when(kind == "name", named)
            .when(kind.isin("phone", "card"), _filled(value, one))
            .when(kind == "email", _same_case(one, value))
            .otherwise(one)
        )
        return F.concat(_lead(m), new)

    x = F.transform(mentions, lambda m: F.struct(m.alias("m"), kind_of(m).alias("kind")))
    x = F.transform(x, lambda e: _with(e, ("m", "kind"), found=entities_of(e["m"], e["kind"])))
    x = F.transform(x, lambda e: _with(e, ("m", "kind"), tried=F.transform(e["found"], tried)))
    x = F.transform(x, lambda e: _with(e, ("m", "kind"), made=surrogates_of(key, e["tried"])))
    return F.transform(x, written)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """Stored `kind, norm, attempt, surrogate` of distinct entities, all surrogates distinct.

    Among entities with one surrogate, the one with the fewest attempts and then the
    smallest norm keeps it. No surrogate is a real entity of its type.
    """
    attempt = F.col("attempt")
    one = F.get(surrogates_of(key, F.array(F.struct("kind", "norm", "attempt"))), F.lit(0))
    named = lambda df: df.withColumn("surrogate", one)
    now = durable(named(entities.withColumn("attempt", F.lit(0))), "surrogates")
    real = now.select("kind", F.col("norm").alias("surrogate"), F.lit(True).alias("real"))
    while True:
        first = now.groupBy("kind", "surrogate").agg(
            F.min(F.struct("attempt", "norm")).alias("keeps"), F.count(F.lit(1)).alias("n")
        )
        taken = first.join(real, ["kind", "surrogate"], "left").where("n > 1 or real")
        taken = durable(taken.withColumn("real", F.coalesce("real", F.lit(False))).drop("n"), "taken")
        if not taken.limit(1).count():
            return now
        marked = lookup(now, taken, ["kind", "surrogate"])
        loses = F.col("real") | (F.struct("attempt", "norm") != F.col("keeps"))
        again = F.when(F.coalesce(loses, F.lit(False)), attempt + 1).otherwise(attempt)
        now = durable(named(marked.select("kind", "norm", again.alias("attempt"))), "surrogates")


def pseudonymize(docs: DataFrame, text: str = "text", id: str = "doc_id", key: str = KEY) -> DataFrame:
    """`doc` (the row as it came), `replaced` (its text with surrogates), `n_entities`."""
    ids = F.coalesce(F.col(id).cast("bigint"), F.lit(LAST_ID)).alias("doc_id")
    mentions = docs.select(ids, F.explode(F.array_distinct(mentions_of(F.col(text)))).alias("mention"))
    typed = mentions.withColumn("kind", kind_of(F.col("mention")))
    held = typed.select("doc_id", F.inline(entities_of(F.col("mention"), F.col("kind"))))
    held = durable(held.distinct(), "entities")
    table = assign(held.select("kind", "norm").distinct(), key)
    late = durable(table.where("attempt > 0").select("kind", "norm", "attempt"), "late-surrogates")
    by_doc = (
        lookup(held, late, ["kind", "norm"], "inner")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("kind", "norm", "attempt")).alias("_later"))
    )
    rows = docs.select(F.struct("*").alias("doc"), ids, F.col(text).alias("text"))
    rows = lookup(rows, durable(by_doc, "late-by-document"), ["doc_id"]).withColumn(
        "_found", mentions_of(F.col("text"))
    )
    empty = F.array().cast("array<struct<kind:string,norm:string,attempt:int>>")
    later = F.coalesce("_later", empty)
    made = replacements(key, F.col("_found"), later)
    between = F.split("text", ANY, -1)
    # One piece of text more than there are mentions.
    joined = F.array_join(
        F.zip_with(between, made, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""
    )
    return rows.select(
        "doc",
        F.when(F.size("_found") > 0, joined).otherwise(F.col("text")).alias("replaced"),
        F.greatest(F.size("_found"), F.lit(0)).cast("bigint").alias("n_entities"),
    )
