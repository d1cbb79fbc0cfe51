"""Format-preserving pseudonyms for personal numbers and dates, by a keyed Feistel network in SQL functions.

What is found and how it is validated:

* card numbers of 13 to 19 digits, single spaces or hyphens between them allowed: the Luhn sum. Among
  other numbers: what is grouped like a card, then all groups, then what begins or ends them;
* phone numbers with a country code, with or without signs after it: 10 to 15 digits (those of +1, +7,
  +33, +34, +44 and +91: the one length of theirs first);
* social security numbers ddd-dd-dddd: no part that is never issued;
* IPv4 addresses: four numbers up to 255;
* dates yyyy-mm-dd, dd.mm.yyyy, mm/dd/yyyy (dd/mm/yyyy if the first number is above 12): a day of the calendar;
* mail addresses (the part before the sign), and quoted keys of 32 and more hexadecimal digits.

A value's characters are split into halves; ROUNDS times, one half's characters are moved on within
their class (digits, a-f of keys, small and capital letters) by a keyed digest of the other half
and the place. That is a permutation of the values of a format, so equal values stay equal in all
documents and different ones different. A card keeps a right Luhn digit (the others are permuted),
an address's four numbers are permuted as two 16-bit halves, and a date moves within its block of
28 years, whose 10227 days are 21 times 487: halves of these sizes. Signs and spaces stay.

A number doesn't run into an address, date or social security number after a space. Where spaces alone
join the groups of a phone of another country, a short number after it may be taken for a part of it.

Values that fail validation are left as they are. A value stays itself with the chance that a random
value equals it. Defined cases: a null text stays null with 0 found; empty text stays; repeated and
overlapping finds: the leftmost and in it the first kind listed in FOUND; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .packed import ready

ROUNDS = 8
BLOCK_DAYS = 10227
BLOCK_PARTS = (21, 487)

# What each kind looks like; a match is told apart by these patterns in this order.
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
KEY = r"(?<=\")[0-9a-f]{32,}(?=\")"
DATE = r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/-]|\.\d)"
ADDRESS = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
SOCIAL = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
# Forms that a phone or card number beside them doesn't run into, after a space (or a hyphen within a phone).
_QUAD = r"\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
_DAY = r"(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/-]|\.\d)"
_OWN = rf"{_QUAD}|{_DAY}|\d{{3}}-\d{{2}}-\d{{4}}(?![\d-])"
_SHAPED = r"(?:\d{4}[ -]){3}\d{4}(?!\d|[ -]\d{4}(?!\d))|\d{4}[ -]\d{6}[ -]\d{4,5}(?!\d)"


def _phone_form() -> str:
    """Numbers of countries with one length first; then 10 to 15 digits, without a space after a part joined by a hyphen or dot, if possible."""
    gap = rf"(?:[ -](?!{_OWN})|\.)"
    lax = rf"(?:{gap}(?=\d\d))?"
    short = rf"(?:(?! (?:{_SHAPED})){gap}(?=\d\d))?"
    strict = rf"(?:(?!(?<=[-.]\d{{1,8}}) ){short[3:]}"
    area = rf"(?:{gap}(?=\d(?:\d|[ .-]?\d\d)))?"

    def forms(country: str, width: int, least: int, most: int, step: str) -> list[str]:
        """Of ``least`` to ``most`` digits with the country's, the area in brackets or not."""
        out = []
        for p in range(1, 5):
            n = width + p + 1
            out.append(rf"{country}[ .-]?\(\d{{{p}}}\){gap}?\d(?:{step}\d){{{least - n},{most - n}}}")
        n = width + 1
        return [*out, rf"{country}{area}\d(?:{step}\d){{{least - n},{most - n}}}"]

    known = [f for c, w, n in (("[17]", 1, 11), ("(?:44|91)", 2, 12), ("3[34]", 2, 11)) for f in forms(c, w, n, n, lax)]
    other = [f for step in (strict, short) for w in (3, 2, 1) for f in forms(rf"\d{{{w}}}", w, 10, 15, step)]
    return r"\+(?:" + "|".join(f"{f}(?!\\d)" for f in known + other) + ")"


PHONE = _phone_form()
COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
# All digits that single spaces and hyphens join; _cards finds the card numbers among them.
CARD = rf"(?<![\d+-])\d(?:(?: (?!{_OWN})|-)?\d){{12,}}+"
CARD_SHAPE = r"^(?:1[3-9]|4-4-4-4(?:-3)?|4-6-[45]|4-4-5)$"
FOUND = "|".join((MAIL, KEY, DATE, ADDRESS, SOCIAL, PHONE, CARD))
# Every form in FOUND holds this: texts without it aren't searched.
MAY_HOLD = r"\d[. -]?\d|@|[0-9a-f]{32}"

_DIGITS, _HEX = "0123456789", "abcdef"
_SMALL, _CAPITAL = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _number(digest: Column) -> Column:
    """60 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *parts).cast("binary"), 256)


def _moved(c: Column, by: Column, classes: tuple[str, ...]) -> Column:
    """The character, moved on in the class that holds it; another stays."""
    out = c
    for letters in classes:
        at = F.instr(F.lit(letters), c)
        place = F.pmod(at - 1 + by, F.lit(len(letters))).cast("int") + 1
        out = F.when(at > 0, F.substring(F.lit(letters), place, F.lit(1))).otherwise(out)
    return out


def permute(value: Column, key: str, classes: tuple[str, ...] = (_DIGITS,)) -> Column:
    """The value with its characters permuted within their classes; not for an empty value."""
    half = F.floor(F.length(value) / 2).cast("int")
    left = F.substring(value, F.lit(1), half)
    right = F.substring(value, half + 1, F.length(value))

    def turn(state: Column, n: Column) -> Column:
        a, b = state["a"], state["b"]
        places = F.when(F.length(a) > 0, F.sequence(F.lit(1), F.length(a))).otherwise(F.array().cast("array<int>"))
        moved = F.transform(
            places,
            lambda i: _moved(F.substring(a, i, F.lit(1)), _number(_digest(key, n.cast("string"), i.cast("string"), b)), classes),
        )
        return F.struct(b.alias("a"), F.array_join(moved, "").alias("b"))

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, F.struct(left.alias("a"), right.alias("b")), turn, lambda s: F.concat(s["a"], s["b"]))


def permute_number(value: Column, key: str, sizes: tuple[int, int]) -> Column:
    """A permutation of the whole numbers below the product of two sizes."""
    first, second = sizes

    def turn(state: Column, n: Column) -> Column:
        a, b = state["a"], state["b"]
        odd = n % 2 == 1
        by = _number(_digest(key, n.cast("string"), F.when(odd, b).otherwise(a).cast("string")))
        return F.struct(
            F.when(odd, F.pmod(a + by, F.lit(first))).otherwise(a).cast("bigint").alias("a"),
            F.when(odd, b).otherwise(F.pmod(b + by, F.lit(second))).cast("bigint").alias("b"),
        )

    start = F.struct(F.floor(value / second).cast("bigint").alias("a"), F.pmod(value, F.lit(second)).cast("bigint").alias("b"))
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, turn, lambda s: s["a"] * second + s["b"])


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _filled(form: Column, digits: Column) -> Column:
    """The form with its digits replaced in order."""

    def one(i: Column) -> Column:
        c = F.substring(form, i, F.lit(1))
        nth = F.length(_only_digits(F.substring(form, F.lit(1), i)))
        return F.when(F.instr(F.lit(_DIGITS), c) > 0, F.substring(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), one), "")


def luhn_sum(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) + 1 - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    values = F.transform(F.sequence(F.lit(1), F.length(digits)), worth)
    return F.aggregate(values, F.lit(0), lambda s, v: s + v)


def _card(m: Column, key: str) -> Column:
    """What stands for a number with a right Luhn sum."""
    def new(digits: Column) -> Column:
        body = permute(F.substring(digits, F.lit(1), F.length(digits) - 1), key + "/card")
        checked = let(body, lambda x: F.concat(x, F.pmod(-luhn_sum(F.concat(x, F.lit("0"))), F.lit(10)).cast("string")))
        return let(checked, lambda x: _filled(m, x))

    return let(_only_digits(m), new)


def _card_spans(groups: Column) -> Column:
    """Card numbers among groups of digits: first group (at) and number of groups (n), none overlapping, in order.

    First those grouped like cards, wherever they are; then all groups, and what begins or ends them.
    """
    size = F.size(groups)

    def span(rank, at, n) -> Column:
        return F.struct(F.lit(rank).cast("int").alias("rank"), F.lit(at).cast("int").alias("at"), F.lit(n).cast("int").alias("n"))

    def right(x: Column) -> Column:
        digits = F.array_join(F.slice(groups, x["at"], x["n"]), "")
        return let(digits, lambda d: F.when(F.length(d).between(13, 19), luhn_sum(d) % 10 == 0).otherwise(False))

    def shaped(at: Column) -> Column:
        def shape(n: Column) -> Column:
            return F.array_join(F.transform(F.slice(groups, at, n), lambda g: F.length(g).cast("string")), "-")

        counts = F.filter(F.sequence(F.lit(1), F.least(F.lit(5), size - at + 1)), lambda n: shape(n).rlike(CARD_SHAPE))
        return F.transform(counts, lambda n: span(F.when(n == 5, 1).otherwise(0), at, n))

    def edge(n: Column) -> Column:
        def ranked(at) -> Column:
            length = F.length(F.array_join(F.slice(groups, at, n), ""))
            return span(F.when(n == size, 2).otherwise(2 + F.array_position(F.array(*map(F.lit, (16, 15, 14, 19, 18, 17, 13))), length)), at, n)

        return F.array(ranked(F.lit(1)), ranked(size - n + 1))

    everywhere = F.flatten(F.transform(F.sequence(F.lit(1), size), shaped))
    edges = F.flatten(F.transform(F.sequence(F.lit(1), F.least(F.lit(19), size)), edge))

    def take(held: Column, x: Column) -> Column:
        meets = F.exists(held, lambda y: (x["at"] < y["at"] + y["n"]) & (y["at"] < x["at"] + x["n"]))
        return F.when(meets, held).otherwise(F.concat(held, F.array(x)))

    none = F.array().cast("array<struct<rank:int,at:int,n:int>>")
    return F.aggregate(F.array_sort(F.filter(F.concat(everywhere, edges), right)), none, take)


def _cards(m: Column, key: str) -> Column:
    """Pseudonyms for the card numbers in a run of digits: new, found and changed."""

    def build(x: Column) -> Column:
        groups, between = x["groups"], x["between"]

        def text(at: Column, n: Column) -> Column:
            inner = F.zip_with(F.slice(groups, at, n), F.slice(between, at, n), lambda g, b: F.concat(b, g))
            return F.array_join(inner, "")

        def write(spans: Column) -> Column:
            # A number's first group brings the sign before it, so that its form has none.
            def part(at: Column) -> Column:
                before = F.element_at(between, at)

                def put(own: Column) -> Column:
                    number = F.substring(text(at, own[0]["n"]), F.length(before) + 1, F.length(m))
                    first = F.when(own[0]["at"] == at, F.concat(before, let(number, lambda x: _card(x, key)))).otherwise("")
                    return F.when(F.size(own) == 0, F.concat(before, F.element_at(groups, at))).otherwise(first)

                return let(F.filter(spans, lambda s: (s["at"] <= at) & (at < s["at"] + s["n"])), put)

            def valued(new: Column) -> Column:
                return F.struct(new.alias("new"), F.greatest(F.size(spans), F.lit(1)).alias("found"), F.when(new != m, F.size(spans)).otherwise(0).alias("changed"))

            parts = F.transform(F.sequence(F.lit(1), F.size(groups)), part)
            return let(F.array_join(parts, ""), valued)

        return let(_card_spans(groups), write)

    runs = F.struct(F.regexp_extract_all(m, F.lit(r"\d+"), F.lit(0)).alias("groups"), F.split(m, r"\d+", -1).alias("between"))
    return let(runs, build)


def _phone(m: Column, key: str) -> Column:
    def valid(digits: Column) -> Column:
        country = F.regexp_extract(digits, COUNTRY, 0)
        local = F.substring(digits, F.length(country) + 1, F.length(digits))
        return let(F.concat(country, permute(local, key + "/phone")), lambda x: _filled(m, x))

    return let(_only_digits(m), valid)


def _social(m: Column, key: str) -> Column:
    never = m.rlike(r"^(?:000|666|9)|-00-|-0000$")
    return F.when(never, m).otherwise(let(permute(_only_digits(m), key + "/social"), lambda x: _filled(m, x)))


def _address(m: Column, key: str) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda x: x.cast("bigint"))
    value = F.aggregate(parts, F.lit(0).cast("bigint"), lambda s, x: s * 256 + x)

    def quad(new: Column) -> Column:
        return F.concat_ws(".", *(F.pmod(F.floor(new / 256**k), F.lit(256)).cast("bigint").cast("string") for k in (3, 2, 1, 0)))

    text = let(permute_number(value, key + "/address", (65536, 65536)), quad)
    return F.when(F.forall(parts, lambda x: x < 256), text).otherwise(m)


def _date(m: Column, key: str) -> Column:
    form = (
        F.when(m.rlike("-"), "yyyy-MM-dd").when(m.rlike(r"\."), "dd.MM.yyyy")
        .when(F.substring(m, 1, 2).cast("int") > 12, "dd/MM/yyyy").otherwise("MM/dd/yyyy")
    )
    y, mo, d = (F.when(form == "yyyy-MM-dd", F.substring(m, *a)).otherwise(F.substring(m, *b)) for a, b in (((1, 4), (7, 4)), ((6, 2), (1, 2)), ((9, 2), (4, 2))))
    first, second = mo, d
    month = F.when(form.isin("dd.MM.yyyy", "dd/MM/yyyy"), second).otherwise(first)
    day = F.when(form.isin("dd.MM.yyyy", "dd/MM/yyyy"), first).otherwise(second)
    zero = F.expr("date'1901-01-01'")

    def move(days: Column) -> Column:
        block = F.floor(days / BLOCK_DAYS) * BLOCK_DAYS
        moved = permute_number(days - block, key + "/date", BLOCK_PARTS) + block
        return F.date_format(F.date_add(zero, moved.cast("int")), "yyyy-MM-dd")

    def write(text: Column) -> Column:
        yy, mm, dd = F.substring(text, 1, 4), F.substring(text, 6, 2), F.substring(text, 9, 2)
        return (
            F.when(form == "yyyy-MM-dd", text).when(form == "dd.MM.yyyy", F.concat_ws(".", dd, mm, yy))
            .when(form == "dd/MM/yyyy", F.concat_ws("/", dd, mm, yy)).otherwise(F.concat_ws("/", mm, dd, yy))
        )

    def valid(value: Column) -> Column:
        return F.when(value.isNotNull() & (F.year(value) >= 1000), let(let(F.datediff(value, zero), move), write)).otherwise(m)

    return let(F.concat_ws("-", y, month, day).try_cast("date"), valid)


def _mail(m: Column, key: str) -> Column:
    at = F.instr(m, F.lit("@"))
    local = permute(F.substring(m, F.lit(1), at - 1), key + "/mail", (_DIGITS, _SMALL, _CAPITAL))
    return F.concat(local, F.substring(m, at, F.length(m)))


def pseudonym(m: Column, key: str) -> Column:
    """What stands for one find: new, found (more than one in a run with several cards) and changed."""
    kinds = (
        (r"@", _mail), (r"^[0-9a-f]{32,}$", lambda x, k: permute(x, k + "/key", (_DIGITS, _HEX))),
        (r"^(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})$", _date), (r"^\d+(?:\.\d+){3}$", _address),
        (r"^\d{3}-\d{2}-\d{4}$", _social), (r"^\+", _phone),
    )
    out = _cards(m, key)
    for pattern, replace in reversed(kinds):
        one = let(replace(m, key), lambda x: F.struct(x.alias("new"), F.lit(1).alias("found"), (x != m).cast("int").alias("changed")))
        out = F.when(m.rlike(pattern), one).otherwise(out)
    return out


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The rows with ``text`` pseudonymised, and pii_found (finds) and pii_changed (those that were valid)."""
    ready(docs.sparkSession)
    held = F.col(f"`{text}`").cast("string")
    names = [c for c in docs.columns if c not in (text, "pii_found", "pii_changed")]
    kept = [F.col(f"`{c}`") for c in names]
    own = F.struct(*kept).alias("_row") if kept else F.struct(F.lit(1).alias("_none")).alias("_row")
    finds = F.when(held.rlike(MAY_HOLD), F.regexp_extract_all(held, F.lit(FOUND), F.lit(0)))
    found = docs.select(own, held.alias("_text"), F.coalesce(finds, F.array().cast("array<string>")).alias("_finds"))
    changed = found.withColumn("_new", F.transform("_finds", lambda m: pseudonym(m, key)))
    pieces = F.split("_text", FOUND, -1)
    ends = F.concat(F.transform("_new", lambda x: x["new"]), F.array(F.lit("")))
    whole = F.array_join(F.zip_with(pieces, ends, lambda p, m: F.concat(p, m)), "")
    found_all = F.aggregate("_new", F.lit(0), lambda n, x: n + x["found"]).cast("bigint")
    changed_all = F.aggregate("_new", F.lit(0), lambda n, x: n + x["changed"]).cast("bigint")
    new_text = F.when(F.size("_finds") > 0, whole).otherwise(F.col("_text")).alias(text)
    order = [new_text if c == text else F.col("_row")[c].alias(c) for c in docs.columns if c not in ("pii_found", "pii_changed")]
    return changed.select(*order, found_all.alias("pii_found"), changed_all.alias("pii_changed"))
