"""Format-preserving Feistel pseudonyms for personal numbers, dates and addresses.

Everything is DataFrame expressions. A value that passes its kind's validation becomes a number
pair (l, r) of the kind's domain; a keyed Feistel network permutes the domain; the result is
written in the format of the value: same separators, same length, valid check digits. The
permutation does not depend on the document, so equal values stay linked, and whoever holds the
key can invert it.

The round function is SHA-256 over the key, the kind, the round and the other half.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KINDS = ("email", "iban", "card", "ssn", "phone", "date", "ip")

# Names of months.
_MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
_MONTH = "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in _MONTHS)
_MONTH = rf"(?:{_MONTH}|Sept)(?![A-Za-z])"
_NTH = r"\d{1,2}(?:st|nd|rd|th)?"

# Country codes of telephone numbers, as assigned.
_COUNTRIES = (
    r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
    r"|21[1-368]|2[2-6]\d|29[017-9]|3[578]\d|42[0134]|5[09]\d|6[789]\d"
    r"|80[08]|85[02-6]|88[068]|96[0-8]|97[0-79]|99[2-68]"
)
# Blocks that IPv6 addresses of networks are assigned from.
_IPV6_BLOCKS = r"[23][0-9A-Fa-f]{3}|[Ff][CDcd][0-9A-Fa-f]{2}|[Ff][Ee][89ABab][0-9A-Fa-f]"

# The formats that are looked for, as known from their standards.
_PATTERNS = {
    "email": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@"
        r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
    ),
    "iban": (
        r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}"
        r"(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
    ),
    "ip": (
        # A number of a version is written alike.
        r"(?<![\d.])(?<![Vv])(?<![Vv]\.)(?<![Vv]ersion )(?<![Vv]ersion)"
        r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d)"
        r"|(?<![A-Za-z0-9_:.])[0-9A-Fa-f]{1,4}(?:(?:::?[0-9A-Fa-f]{1,4}){1,7}(?:::)?|::)"
        r"(?![A-Za-z0-9_:])"
    ),
    "date": (
        r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})"
        r"(?![\d/-]|\.\d)"
        rf"|(?<![A-Za-z0-9])(?:{_MONTH}\.? {_NTH},?|(?<![./-]){_NTH} {_MONTH}\.?,?)"
        r" \d{4}(?![A-Za-z0-9])"
    ),
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": (
        r"(?<![\d+])(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
        r"|(?<![A-Za-z0-9_+])\+[1-9](?:[ .-]?\(?\d\)?){6,14}(?!\d)"
    ),
    "card": r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d]|[.-]\d)",
}
_ORDER = ("email", "iban", "ip", "date", "ssn", "phone", "card")
ANY = "|".join(f"(?:{_PATTERNS[k]})" for k in _ORDER)

# A match of a card or an IBAN may have taken in groups beside it, and values of other kinds. Where
# it fails, every start in the text is looked at, for each length that ends with a group; a mark
# before a start tells what begins there, and a fixed pattern finds what is marked.
MARK = "\x01"
_STARTS = r"(?<![\d.@-])(?=\d)|(?<![A-Za-z0-9@])(?=[A-Z]{2}\d{2})"
#: Characters from a start that are looked at, and starts that have as many.
_REACH, _NEXT = 64, 26
_NO_ADDRESS = r"(?![A-Za-z0-9._%+-]*@)"
_CARD_SIZES = range(13, 20)
_CARD_AT = [
    (chr(ord("A") + n - 13), rf"^(\d(?:[ -]?\d){{{n - 1}}})(?![\d]|[.-]\d){_NO_ADDRESS}")
    for n in _CARD_SIZES
]
_IBAN_AT = [
    rf"^([A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{{n}}}{rest})(?![A-Za-z0-9]){_NO_ADDRESS}"
    for n in range(2, 8)
    for rest in ("", " ?[A-Z0-9]{1,3}")
]
_IBAN_SIZES = range(15, 35)
_MARKS = rf"{MARK}[A-Ta-t]"
_MARKED = "|".join(
    [
        rf"{MARK}{code}\d(?:[ -]?(?:{_MARKS})?\d){{{n - 1}}}"
        for n, (code, _) in zip(_CARD_SIZES, _CARD_AT, strict=True)
    ]
    + [
        rf"{MARK}{chr(ord('a') + n - 15)}[A-Z](?: ?(?:{_MARKS})?[A-Z0-9]){{{n - 1}}}"
        for n in _IBAN_SIZES
    ]
)
ANY_MARKED = "|".join(
    [_MARKED, *(f"(?:{_PATTERNS[k]})" for k in _ORDER if k not in ("card", "iban"))]
)
#: Groups as cards are written; a number in other groups gives way to one in these.
_CARD_LAYOUT = r"^(?:\d+|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{1,3})?|\d{4}([ -])\d{6}\2\d{4,5})$"

#: Days from 1900-01-01 to 2099-12-31, as 17 times 4297.
_FIRST_DAY, _DAYS = "1900-01-01", (17, 4297)

Key = str


def feistel(key: Key, kind: str, left: Column, lefts: Column, right: Column, rights: Column):
    """A keyed permutation of pairs: left below `lefts`, right below `rights`, all longs.

    Rounds take turns in adding a hash of one half to the other, modulo the size of the latter.
    Sizes go up to 10^17. The result is a struct (l, r).
    """

    def noise(step: Column, half: Column, size: Column) -> Column:
        mixed = F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.sha2(mixed, 256), 1, 15), 16, 10).cast("long") % size

    def step(acc: Column, i: Column) -> Column:
        l, r = acc["l"], acc["r"]
        return F.when(
            i % 2 == 0,
            F.struct(((l + noise(i, r, lefts)) % lefts).alias("l"), r.alias("r")),
        ).otherwise(F.struct(l.alias("l"), ((r + noise(i, l, rights)) % rights).alias("r")))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _in_place(value: Column, kept: str, filling: Column) -> Column:
    """`value` with its characters of the class `kept` replaced, in order, by `filling`."""
    chars = F.split(value, "")

    def put(acc: Column, c: Column) -> Column:
        fits = c.rlike(kept)
        return F.struct(
            F.concat(
                acc["out"], F.when(fits, F.substring(filling, acc["n"] + 1, F.lit(1))).otherwise(c)
            ).alias("out"),
            F.when(fits, acc["n"] + 1).otherwise(acc["n"]).alias("n"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))
    return F.aggregate(chars, start, put, lambda acc: acc["out"])


def _permuted(key: Key, kind: str, text: Column, base: int) -> Column:
    """A string of digits of `base` (10 or 36, lower case), permuted among those of its length.

    Halves of a string go up to 17 decimal or 11 base-36 digits.
    """
    cut = F.floor(F.length(text) / 2).cast("int")

    def number(part: Column) -> Column:
        return F.when(F.length(part) == 0, F.lit(0).cast("long")).otherwise(
            F.conv(part, base, 10).cast("long")
        )

    def text_of(value: Column, size: Column) -> Column:
        return F.lower(F.lpad(F.conv(value.cast("string"), 10, base), size, "0"))

    def count(size: Column) -> Column:
        powers = F.lit([base**k for k in range(18 if base == 10 else 12)]).cast("array<bigint>")
        return F.get(powers, size)

    def whole(n: Column) -> Column:
        left = F.substring(text, F.lit(1), n)
        right = F.substring(text, n + 1, F.length(text) - n)
        sizes = count(n), count(F.length(text) - n)
        return _let(
            feistel(key, f"{kind}{base}", number(left), sizes[0], number(right), sizes[1]),
            lambda p: F.concat(
                F.when(n > 0, text_of(p["l"], n)).otherwise(""),
                text_of(p["r"], F.length(text) - n),
            ),
        )

    return F.when(F.length(text) == 0, text).otherwise(_let(cut, whole))


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of the digits, those at every other place from the right doubled and cast out by 9.

    `doubled` is the place from the right, counted from 0, that is doubled first.
    """
    return F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda c, i: F.when(
                i % 2 == doubled, F.get(F.lit([0, 2, 4, 6, 8, 1, 3, 5, 7, 9]), c.cast("int"))
            ).otherwise(c.cast("int")),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )


def _mod97(text: Column) -> Column:
    """The number of a string of digits and letters (A is 10) modulo 97."""

    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        digit, letter = acc * 10 + code - 48, acc * 100 + code - 55
        return F.when(code < 65, digit % 97).otherwise(letter % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _card(key: Key) -> tuple[Callable, Callable]:
    """Luhn numbers from 2 to 6, the industries that issue cards; the first digit stays."""

    def valid(value: Column) -> Column:
        return _let(_digits(value), lambda d: d.rlike("^[2-6]") & (_luhn_sum(d, 1) % 10 == 0))

    def pseudonym(value: Column) -> Column:
        def changed(d: Column) -> Column:
            body = F.substring(d, F.lit(2), F.length(d) - 2)
            return _let(
                F.concat(F.substring(d, 1, 1), _permuted(key, "card", body, 10)),
                lambda p: F.concat(p, ((10 - _luhn_sum(p, 0) % 10) % 10).cast("string")),
            )

        return _in_place(value, "[0-9]", _let(_digits(value), changed))

    return valid, pseudonym


def _iban(key: Key) -> tuple[Callable, Callable]:
    """Account numbers that are 1 modulo 97; country and the letters' places stay."""

    def compact(value: Column) -> Column:
        return F.regexp_replace(value, " ", "")

    def turned(text: Column) -> Column:
        return F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))

    def valid(value: Column) -> Column:
        return _let(
            compact(value),
            lambda t: F.length(t).between(15, 34) & (_mod97(turned(t)) == 1),
        )

    def pseudonym(value: Column) -> Column:
        def changed(t: Column) -> Column:
            account = F.substring(t, F.lit(5), F.length(t))
            new = _let(
                account,
                lambda a: _in_place(a, "[0-9]", _permuted(key, "iban", _digits(a), 10)),
            )
            country = F.substring(t, 1, 2)
            check = lambda a: F.lpad(
                (98 - _mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0"
            )
            return _let(new, lambda a: F.concat(country, check(a), a))

        return _in_place(value, "[A-Z0-9]", _let(compact(value), changed))

    return valid, pseudonym


def _phone(key: Key) -> tuple[Callable, Callable]:
    """North American numbers, and others with the code of their country.

    The former have an area and an exchange from 200 that do not end in 11, and no area has a 9 in
    the middle; what is no such number stays. With or without the code 1 a number has one
    pseudonym, which is such a number again. Of other numbers, of 8 to 15 digits, the code and the
    digit after it stay.
    """

    def american(d: Column) -> Column:
        return d.rlike(r"^1?(?!.11)[2-9][0-8]\d(?!.11)[2-9]\d{6}$")

    def valid(value: Column) -> Column:
        abroad = value.startswith("+") & ~value.startswith("+1")
        return _let(
            _digits(value),
            lambda d: F.when(
                abroad, d.rlike(rf"^(?:{_COUNTRIES})\d+$") & F.length(d).between(8, 15)
            ).otherwise(american(d)),
        )

    def place(code: Column, middles: int) -> Column:
        """The place of an area or exchange among those that there are: without 11 at the end."""
        rest = code % 100
        return (F.floor(code / 100) - 2) * (middles * 10 - 1) + rest - (rest > 11).cast("long")

    def code_at(place: Column, middles: int) -> Column:
        rest = place % (middles * 10 - 1)
        first = F.floor(place / (middles * 10 - 1)) + 2
        return first * 100 + rest + (rest >= 11).cast("long")

    def of_america(d: Column) -> Column:
        def number(at: int, size: int) -> Column:
            return F.substring(d, at, size).cast("long")

        left = place(number(1, 3), 9) * 100 + number(7, 2)
        right = place(number(4, 3), 10) * 100 + number(9, 2)
        sizes = F.lit(8 * 89 * 100).cast("long"), F.lit(8 * 99 * 100).cast("long")

        def text(p: Column) -> Column:
            parts = (
                (code_at(F.floor(p["l"] / 100), 9), 3),
                (code_at(F.floor(p["r"] / 100), 10), 3),
                (p["l"] % 100, 2),
                (p["r"] % 100, 2),
            )
            return F.concat(*(F.lpad(n.cast("string"), k, "0") for n, k in parts))

        return _let(feistel(key, "phone", left, sizes[0], right, sizes[1]), text)

    def pseudonym(value: Column) -> Column:
        def changed(d: Column) -> Column:
            code = F.length(F.regexp_extract(d, rf"^(?:{_COUNTRIES})", 0)) + 1
            others = F.substring(d, code + 1, F.length(d))
            ten = F.right(d, F.lit(10))
            return F.when(
                american(d), F.concat(F.when(F.length(d) == 11, "1").otherwise(""), of_america(ten))
            ).otherwise(
                F.concat(F.substring(d, F.lit(1), code), _permuted(key, "phone", others, 10))
            )

        return _in_place(value, "[0-9]", _let(_digits(value), changed))

    return valid, pseudonym


def _ssn(key: Key) -> tuple[Callable, Callable]:
    """Area 001 to 899 but 666, group 01 to 99, serial 0001 to 9999."""

    def valid(value: Column) -> Column:
        return ~value.rlike("^(?:000|666|9)|-00-|-0000$")

    def pseudonym(value: Column) -> Column:
        def part(at: int, size: int) -> Column:
            return F.substring(value, at, size).cast("long")

        area = F.when(part(1, 3) > 666, part(1, 3) - 2).otherwise(part(1, 3) - 1)
        right = (part(5, 2) - 1) * 9_999 + part(8, 4) - 1

        def text(p: Column) -> Column:
            first = F.when(p["l"] >= 665, p["l"] + 2).otherwise(p["l"] + 1)
            padded = [
                (first, 3),
                (F.floor(p["r"] / 9_999) + 1, 2),
                (p["r"] % 9_999 + 1, 4),
            ]
            return F.concat_ws("-", *(F.lpad(n.cast("string"), k, "0") for n, k in padded))

        sizes = F.lit(898).cast("long"), F.lit(99 * 9_999).cast("long")
        return _let(feistel(key, "ssn", area, sizes[0], right, sizes[1]), text)

    return valid, pseudonym


def _ip(key: Key) -> tuple[Callable, Callable]:
    """Addresses of four bytes, and those of eight groups in an assigned block.

    Of the latter the first group stays, and the result is written out in lower case, so that an
    address has one pseudonym however it is shortened.
    """

    def four(value: Column) -> Column:
        return F.split(value, r"\.").cast("array<bigint>")

    def groups(value: Column) -> Column:
        """The eight groups, as numbers; a double colon stands for those that are missing."""

        def part(side: Column) -> Column:
            return F.filter(F.split(side, ":"), lambda g: g != "")

        def filled(ends: Column) -> Column:
            zeros = F.lit(8) - F.size(ends[0]) - F.size(ends[1])
            every = F.concat(ends[0], F.array_repeat(F.lit("0"), zeros), ends[1])
            return F.transform(every, lambda g: F.conv(g, 16, 10).cast("long"))

        sides = F.split(value, "::")
        return _let(F.array(part(sides[0]), part(F.coalesce(F.get(sides, F.lit(1)), F.lit("")))), filled)

    def valid(value: Column) -> Column:
        long_ = (
            value.rlike(rf"^(?:{_IPV6_BLOCKS}):")
            & value.rlike("^(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}|(?!.*::.*::).*::.*)$")
            & (F.size(F.regexp_extract_all(value, F.lit("[0-9A-Fa-f]+"), F.lit(0))) <= 8)
        )
        return F.when(value.contains(":"), long_).otherwise(
            F.forall(F.split(value, r"\.").try_cast("array<bigint>"), lambda n: n <= 255)
        )

    def of_four(value: Column) -> Column:
        size = F.lit(65_536).cast("long")

        def changed(a: Column) -> Column:
            left, right = F.get(a, 0) * 256 + F.get(a, 1), F.get(a, 2) * 256 + F.get(a, 3)
            return _let(
                feistel(key, "ip", left, size, right, size),
                lambda p: F.concat_ws(
                    ".",
                    *(
                        n.cast("string")
                        for half in (p["l"], p["r"])
                        for n in (F.floor(half / 256), half % 256)
                    ),
                ),
            )

        return _let(four(value), changed)

    def of_eight(value: Column) -> Column:
        """Seven groups are two halves of 56 bits; the middle group is in both."""
        size, byte = F.lit(2**56).cast("long"), F.lit(256).cast("long")

        def shifted(n: Column, bits: int) -> Column:
            return F.shiftright(n, bits) if bits > 0 else F.shiftleft(n, -bits)

        def changed(g: Column) -> Column:
            at = [F.get(g, F.lit(i)) for i in range(8)]
            left = shifted(at[1], -40) + shifted(at[2], -24) + shifted(at[3], -8) + shifted(at[4], 8)
            right = shifted(at[4] % byte, -48) + shifted(at[5], -32) + shifted(at[6], -16) + at[7]

            def text(p: Column) -> Column:
                l, r = p["l"], p["r"]
                new = [
                    at[0], *(shifted(l, k) % 65_536 for k in (40, 24, 8)),
                    l % byte * byte + shifted(r, 48), *(shifted(r, k) % 65_536 for k in (32, 16, 0)),
                ]
                return F.lower(F.concat_ws(":", *(F.hex(n) for n in new)))

            return _let(feistel(key, "ipv6", left, size, right, size), text)

        return _let(groups(value), changed)

    def pseudonym(value: Column) -> Column:
        return F.when(value.contains(":"), of_eight(value)).otherwise(of_four(value))

    return valid, pseudonym


def _date(key: Key) -> tuple[Callable, Callable]:
    """Days of 1900 to 2099, in numbers or with the month's name.

    With slashes the month is first, or else the day. A day and month without a leading zero, a name
    that is cut short and an ordinal are written so again.
    """
    token = r"[A-Za-z]{3,}|\d+(?:st|nd|rd|th)?"
    #: The places of year, month and day among the tokens, each under its condition.
    by_year, by_month, by_day = (0, 1, 2), (2, 0, 1), (2, 1, 0)

    def tokens(value: Column) -> Column:
        return F.regexp_extract_all(value, F.lit(token), F.lit(0))

    def month(text: Column) -> Column:
        short = F.lit([m[:3] for m in _MONTHS])
        named = F.array_position(short, F.left(text, F.lit(3))).cast("string")
        return F.when(text.rlike("^[A-Z]"), named).otherwise(text)

    def as_day(t: Column, order: tuple[int, int, int]) -> Column:
        y, m, d = (F.get(t, F.lit(k)) for k in order)
        return F.try_to_date(F.concat_ws("-", y, month(m), _digits(d)), "yyyy-M-d")

    def read(value: Column, then: Callable[[Column, Column, tuple], Column]) -> Column:
        """`then` of the day, the tokens and their order; null if no order gives a day."""

        def choose(t: Column) -> Column:
            month_first = ~value.contains(".") | value.rlike("^[A-Z]")
            fits = (
                (value.contains("-"), by_year),
                (month_first & as_day(t, by_month).isNotNull(), by_month),
                (~value.rlike("^[A-Z]"), by_day),
            )
            out = F.when(fits[0][0], then(as_day(t, by_year), t, by_year))
            for condition, order in fits[1:]:
                out = out.when(condition, then(as_day(t, order), t, order))
            return out

        return _let(tokens(value), choose)

    def valid(value: Column) -> Column:
        year = read(value, lambda day, t, order: F.year(day))
        return F.coalesce(year.between(1900, 2099), F.lit(False))

    def written(new: Column, t: Column, order: tuple[int, int, int]) -> Column:
        """The tokens of a day, each as the one in its place is written."""
        y, m, d = (F.get(t, F.lit(k)) for k in order)
        padded = (F.length(m) == 2) & (F.length(d) == 2)
        names = F.lit(list(_MONTHS))
        name = F.get(names, F.month(new) - 1)
        short = ~F.array_contains(names, m)
        day = F.dayofmonth(new)
        ending = (
            F.when(day.between(11, 13), "th")
            .when(day % 10 == 1, "st")
            .when(day % 10 == 2, "nd")
            .when(day % 10 == 3, "rd")
            .otherwise("th")
        )

        def number(n: Column) -> Column:
            return F.when(padded, F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string"))

        parts = {
            order[0]: F.year(new).cast("string"),
            order[1]: F.when(m.rlike("^[A-Z]"), F.when(short, F.left(name, F.lit(3))).otherwise(name))
            .otherwise(number(F.month(new))),
            order[2]: F.when(d.rlike("[a-z]"), F.concat(day.cast("string"), ending))
            .when(m.rlike("^[A-Z]"), day.cast("string"))
            .otherwise(number(day)),
        }
        return F.array(*(parts[k] for k in range(3)))

    def pseudonym(value: Column) -> Column:
        a, b = _DAYS
        first = F.lit(_FIRST_DAY).cast("date")
        sizes = F.lit(a).cast("long"), F.lit(b).cast("long")

        def changed(n: Column) -> Column:
            def new_tokens(p: Column) -> Column:
                return _let(
                    F.date_add(first, (p["l"] * b + p["r"]).cast("int")),
                    lambda new: read(value, lambda day, t, order: written(new, t, order)),
                )

            return _let(feistel(key, "date", F.floor(n / b), sizes[0], n % b, sizes[1]), new_tokens)

        new = _let(F.datediff(read(value, lambda day, t, order: day), first).cast("long"), changed)
        return _joined(F.split(value, token, -1), new)

    return valid, pseudonym


def _email(key: Key) -> tuple[Callable, Callable]:
    """Letters and digits of the local part, in runs of 22; the domain stays.

    The result is in lower case, so an address in any case has one pseudonym. Dots stand inside
    the local part and not in a row, labels of the domain have no hyphen at an end and up to 63
    characters, and the domain up to 253.
    """

    def valid(value: Column) -> Column:
        return ~value.rlike(r"^\.|\.@|\.\..*@|@.{254}") & value.rlike(
            r"@(?:(?!-)[A-Za-z0-9-]{1,63}(?<!-)\.)+[A-Za-z]{2,63}$"
        )

    def pseudonym(value: Column) -> Column:
        local = F.lower(F.substring_index(value, "@", 1))
        domain = F.substring_index(value, "@", -1)
        plain = F.regexp_replace(local, "[^a-z0-9]", "")

        def changed(p: Column) -> Column:
            runs = F.sequence(F.lit(0), F.floor((F.length(p) - 1) / 22).cast("int"))
            return F.array_join(
                F.transform(
                    runs,
                    lambda k: _permuted(key, "email", F.substring(p, k * 22 + 1, F.lit(22)), 36),
                ),
                "",
            )

        new = F.when(F.length(plain) > 0, _let(plain, changed)).otherwise(plain)
        return F.concat(_in_place(local, "[a-z0-9]", new), F.lit("@"), domain)

    return valid, pseudonym


_RULES = {
    "email": _email,
    "iban": _iban,
    "card": _card,
    "ssn": _ssn,
    "phone": _phone,
    "date": _date,
    "ip": _ip,
}


def _joined(gaps: Column, values: Column) -> Column:
    """The gaps with the values between them."""
    between = F.zip_with(gaps, values, lambda g, v: F.concat(g, F.coalesce(v, F.lit(""))))
    return F.array_join(between, "")


def _checked(found: Column, key: Key) -> Column:
    """struct(kind, found) of a match; kind is null where validation fails. What is marked has been
    validated."""
    nothing = F.lit(None).cast("string")
    marked = F.when(found.rlike(f"^{MARK}[A-Z]"), F.lit("card")).otherwise(F.lit("iban"))
    kind = F.when(found.startswith(MARK), marked)
    for name in _ORDER:
        value = F.when(_RULES[name](key)[0](found), F.lit(name)).otherwise(nothing)
        kind = kind.when(found.rlike(f"^(?:{_PATTERNS[name]})$"), value)
    plain = F.regexp_replace(found, _MARKS, "")
    return F.struct(kind.otherwise(nothing).alias("kind"), plain.alias("found"))


def _text_of(hit: Column, key: Key) -> Column:
    """The pseudonym of a struct(kind, found), or what was found."""
    out = None
    for name in _ORDER:
        test, value = hit["kind"] == name, _RULES[name](key)[1](hit["found"])
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(hit["found"])


def _marked(text: Column, key: Key) -> Column:
    """`text` with a mark before every start of a valid card or IBAN, which tells its length.

    At a start the longest one counts, but a number that is not laid out as cards are gives way to
    one that is and that it overlaps. The steps grow with the text, whatever it holds.
    """
    card, iban = _card(key)[0], _iban(key)[0]

    def longest(window: Column, patterns: list[str], valid: Callable) -> Column:
        every = F.array(*(F.regexp_extract(window, p, 1) for p in patterns))
        by_size = F.filter(every, lambda c: (c != "") & valid(c))
        return F.array_max(F.transform(by_size, lambda c: F.struct(F.length(c), c.alias("v"))))["v"]

    def best(window: Column) -> Column:
        """struct(card, laid, iban): the longest card, the longest laid out one, and the IBAN."""
        sized = [p for _, p in _CARD_AT]
        cards = F.filter(
            F.array(*(F.regexp_extract(window, p, 1) for p in sized)),
            lambda c: (c != "") & card(c),
        )

        def both(found: Column) -> Column:
            laid = F.filter(found, lambda c: c.rlike(_CARD_LAYOUT))
            # Of more digits, and so longer ones, the last.
            return F.struct(
                F.try_element_at(found, F.lit(-1)).alias("card"),
                F.try_element_at(laid, F.lit(-1)).alias("laid"),
                F.when(window.rlike(r"^[A-Z]{2}\d{2}"), longest(window, _IBAN_AT, iban)).alias(
                    "iban"
                ),
            )

        return _let(cards, both)

    def code(value: Column, letter: str, smallest: int) -> Column:
        size = F.length(F.regexp_replace(value, "[ -]", ""))
        return F.concat(F.lit(MARK), F.char(size - smallest + ord(letter)))

    def window(heads: Column, i: Column) -> Column:
        return F.left(F.array_join(F.slice(heads, i + 1, F.lit(_NEXT)), ""), F.lit(_REACH))

    def put(pieces: Column, heads: Column) -> Column:
        # Most starts have too few digits after them.
        starts = F.transform(
            heads,
            lambda p, i: _let(
                window(heads, i),
                lambda w: F.when(w.rlike(r"^\d(?:[ -]?\d){12}|^[A-Z]{2}\d{2}"), best(w)),
            ),
        )

        def mark(at: Column, i: Column, found: Column) -> Column:
            chosen = at["card"]
            inside = F.slice(found, i + 2, F.size(F.split(chosen, " ")) - 1)
            gives_way = ~chosen.rlike(_CARD_LAYOUT) & F.exists(
                inside, lambda o: o["laid"].isNotNull() & ~chosen.contains(o["laid"])
            )
            own = F.when(gives_way, at["laid"]).otherwise(chosen)
            return (
                F.when(at["iban"].isNotNull(), code(at["iban"], "a", 15))
                .when(own.isNotNull(), code(own, "A", 13))
                .otherwise("")
            )

        def text_of(found: Column) -> Column:
            marks = F.transform(
                found, lambda at, i: F.when(at.isNotNull(), mark(at, i, found)).otherwise("")
            )
            return F.array_join(F.zip_with(marks, pieces, lambda m, p: F.concat(m, p)), "")

        return _let(starts, text_of)

    return _let(
        F.split(text, _STARTS, -1),
        lambda pieces: _let(
            F.transform(pieces, lambda p: F.left(p, F.lit(_REACH))),
            lambda heads: put(pieces, heads),
        ),
    )


#: A mark that a text has itself is told apart by what follows it.
_ESCAPED = MARK + "~"


def pseudonymize(
    docs: DataFrame, key: Key, text_col: str = "text", counts: str | None = None
) -> DataFrame:
    """`docs` with the pseudonyms in place, all other columns as they are.

    With `counts`, a column of that new name is added: a map of kind to the values replaced. Values
    that fail their kind's validation (Luhn, modulo 97, ranges, calendar, assigned codes) stay;
    where a card or an IBAN fails, every start in the text is looked at, and what is valid from
    there goes before values of other kinds that it overlaps. A null text stays null and has no
    values; repeated rows are treated alike. Nothing is shuffled.
    """
    if counts in docs.columns:
        raise ValueError(f"there is a column {counts} already")
    names = first, own, cut, hits, gaps = "__first", "__source", "__cut", "__hits", "__gaps"
    while set(names) & set(docs.columns):
        names = first, own, cut, hits, gaps = tuple(f"{c}_" for c in names)
    text = F.col(text_col)
    # Few texts hold a digit, an at sign or two colons; the others pass with one short search.
    held = F.when(text.rlike("[@0-9]|::"), text)
    glued = {kind: f"^(?:{_PATTERNS[kind]})$" for kind in ("card", "iban")}
    failed = F.exists(
        first,
        lambda f: (f.rlike(glued["card"]) & ~_card(key)[0](f))
        | (f.rlike(glued["iban"]) & ~_iban(key)[0](f)),
    )
    escaped = F.replace(held, F.lit(MARK), F.lit(_ESCAPED))
    is_cut, source = F.col(cut), F.col(own)
    again = F.regexp_extract_all(source, F.lit(ANY_MARKED), F.lit(0))
    found = F.when(is_cut, again).otherwise(F.col(first))
    between = F.when(is_cut, F.split(source, ANY_MARKED, -1)).otherwise(F.split(source, ANY, -1))
    marked = (
        docs.withColumn(first, F.regexp_extract_all(held, F.lit(ANY), F.lit(0)))
        .withColumn(cut, F.coalesce(failed, F.lit(False)))
        .withColumn(own, F.when(is_cut, _marked(escaped, key)).otherwise(held))
        .withColumn(hits, F.transform(found, lambda f: _checked(f, key)))
        .withColumn(gaps, between)
    )
    kinds = F.coalesce(F.col(hits)["kind"], F.array().cast("array<string>"))
    changed = F.exists(kinds, lambda k: k.isNotNull())
    rebuilt = _joined(F.col(gaps), F.transform(hits, lambda h: _text_of(h, key)))
    plain = F.replace(F.regexp_replace(rebuilt, _MARKS, ""), F.lit(_ESCAPED), F.lit(MARK))
    rebuilt = F.when(is_cut, plain).otherwise(rebuilt)
    out = {text_col: F.when(changed, rebuilt).otherwise(text)}
    if counts:

        def number(kind: str) -> Column:
            return F.size(F.filter(kinds, lambda k: k == kind)).cast("long")

        out[counts] = F.map_from_arrays(F.lit(list(KINDS)), F.array(*map(number, KINDS)))
    return marked.withColumns(out).drop(*names)
