"""Pseudonyms of personal numbers, dates and addresses in their own format.

A Feistel network, keyed by SHA-256, permutes the digits of a validated number
or the days of a calendar cycle.  Equal values get equal pseudonyms in all
documents and different values of one length get different ones.  All steps are
Spark SQL expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

#: Fixed: characters of an account number by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_shape() -> str:
    """A known country's number ends where its length says, whatever follows; others end at a word's end."""
    known = "|".join(
        f"(?:{'|'.join(names.split())})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}"
        + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
        for n, names in IBAN_LENGTHS.items()
    )
    countries = "|".join(" ".join(IBAN_LENGTHS.values()).split())
    other = rf"(?!{countries})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?\b"
    return rf"\b(?=[A-Z]{{2}}[0-9]{{2}})(?:{known}|{other})"


#: Fixed: shapes of the values looked for, the more special first.
SHAPES = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9.\-]{1,253}\.[A-Za-z]{2,24}",
    "iban": _iban_shape(),
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?!\.?[0-9])",
    "iso_date": r"(?<![0-9\-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9\-])",
    "day_first_date": r"(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9]|\.[0-9])",
    "month_first_date": r"(?<![0-9/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9/])",
    "ssn": r"(?<![0-9\-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9\-])",
    "phone": r"\+[0-9]{1,3}[ .\-]?\([0-9]{2,4}\)[ .\-]?[0-9]{3,4}[ .\-]?[0-9]{3,4}(?![0-9])|\([0-9]{3}\) ?[0-9]{3}[ .\-][0-9]{4}(?![0-9])|(?<![0-9.\-])[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}(?![0-9])|\+[0-9]{1,3}(?:[ .\-]?[0-9]){7,12}(?![0-9])",
}

#: Fixed: groups of digits one behind the other, in which card numbers are looked for.
DIGIT_GROUPS = r"(?<![0-9])[0-9](?:[ \-]?[0-9]){12,}+"

#: Fixed: two noncharacters, the first parts values from text, the second escapes both.
PART, ESCAPE = "\ufdd0", "\ufdd1"


def _rounds(key: str, use: Column | str, pair: Column, left_size: Column, right_size: Column) -> Column:
    """The network over ``struct(l, r)`` with ``l < left_size`` and ``r < right_size``, as one fold.

    Even rounds add to the left half, odd ones to the right; each is undone by
    subtracting, so the whole is a permutation of the pairs.
    """

    def step(state: Column, turn: Column) -> Column:
        def noise(half: Column) -> Column:
            digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(use) if isinstance(use, str) else use, turn, half), 256)
            return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")

        left = F.when(turn % 2 == 0, F.pmod(state["l"] + noise(state["r"]), left_size)).otherwise(state["l"])
        right = F.when(turn % 2 == 1, F.pmod(state["r"] + noise(state["l"]), right_size)).otherwise(state["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), pair, step)


def _power_of_ten(n: Column) -> Column:
    return F.rpad(F.lit("1"), (n + 1).cast("int"), "0").cast("long")


def permuted_digits(key: str, kind: str, digits: Column) -> Column:
    """A digit string of 2 to 34 digits permuted among those of its length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    pair = F.struct(
        F.substring(digits, F.lit(1), half).cast("long").alias("l"),
        F.substring(digits, half + 1, n - half).cast("long").alias("r"),
    )
    use = F.concat(F.lit(f"{kind}|"), n.cast("string"))
    done = _rounds(key, use, pair, _power_of_ten(half), _power_of_ten(n - half))
    return _bound(
        done,
        lambda p: F.concat(F.lpad(p["l"].cast("string"), half, "0"), F.lpad(p["r"].cast("string"), n - half, "0")),
    )


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced by ``digits`` in order."""
    return F.array_join(
        F.transform(
            F.split(value, ""),
            lambda c, i: F.when(
                c.rlike("^[0-9]$"),
                F.substring(digits, F.length(_digits(F.substring(value, F.lit(1), i + 1))), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )


def luhn_sum(digits: Column) -> Column:
    """Sum of the Luhn check, the last digit counting once."""
    return F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.struct(d.cast("int").alias("d"), i.alias("i"))),
        F.lit(0),
        lambda total, x: total
        + F.when(x["i"] % 2 == 0, x["d"]).when(x["d"] > 4, x["d"] * 2 - 9).otherwise(x["d"] * 2),
    )


def card_number(key: str, value: Column) -> Column:
    """A number that passes the Luhn check becomes another of its length that does; any other is left."""

    def of(digits: Column) -> Column:
        body = permuted_digits(key, "card", F.substring(digits, F.lit(1), F.length(digits) - 1))
        return _bound(body, lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))

    return _bound(
        _digits(value),
        lambda d: F.when(luhn_sum(d) % 10 == 0, _bound(of(d), lambda new: _refilled(value, new))).otherwise(value),
    )


def card_numbers(key: str, value: Column) -> Column:
    """Groups of digits with every card number in them replaced, the longest from the first group on, and so forth.

    A card number begins and ends at a border of groups, has 13 to 19 digits and passes the Luhn check.
    """
    groups = F.split(value, r"(?<=[ \-])")

    def step(groups: Column, state: Column, i: Column) -> Column:
        def passes(run: Column) -> Column:
            return _bound(_digits(run), lambda d: F.when(F.length(d).between(13, 19), luhn_sum(d) % 10 == 0).otherwise(F.lit(False)))

        widths = F.sequence(F.least(F.lit(19), F.size(groups) - i), F.lit(1), F.lit(-1))
        # the separator behind the last group belongs to no number; _refilled leaves it
        runs = F.transform(widths, lambda n: F.struct(n.alias("n"), F.array_join(F.slice(groups, i + 1, n), "").alias("run")))
        longest = F.try_element_at(F.filter(runs, lambda x: passes(x["run"])), F.lit(1))
        taken = _bound(
            longest,
            lambda x: F.when(
                x.isNotNull(),
                F.struct(F.concat(state["out"], card_number(key, x["run"])).alias("out"), (i + x["n"]).alias("next")),
            ).otherwise(F.struct(F.concat(state["out"], groups[i]).alias("out"), (i + 1).alias("next"))),
        )
        return F.when(i < state["next"], state).otherwise(taken)

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("next"))
    return _bound(
        groups,
        lambda g: F.aggregate(F.sequence(F.lit(0), F.size(g) - 1), start, lambda state, i: step(g, state, i))["out"],
    )


def phone_number(key: str, value: Column) -> Column:
    """The digits behind the country code permuted."""
    country = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .\-(])", 0)
    return _bound(
        F.substring(value, F.length(country) + 1, F.length(value)),
        lambda rest: F.concat(
            country, _bound(permuted_digits(key, "phone", _digits(rest)), lambda new: _refilled(rest, new))
        ),
    )


def social_number(key: str, value: Column) -> Column:
    """A valid number (area, group, serial) becomes another valid one."""
    area = F.substring(value, 1, 3).cast("long")
    # 898 areas: 001 to 899 without 666
    pair = F.struct(
        (area - 1 - F.when(area > 666, 1).otherwise(0)).cast("long").alias("l"),
        ((F.substring(value, 5, 2).cast("long") - 1) * 9_999 + F.substring(value, 8, 4).cast("long") - 1).alias("r"),
    )

    def shown(p: Column) -> Column:
        new = p["l"] + 1 + F.when(p["l"] + 1 >= 666, 1).otherwise(0)
        group, serial = F.floor(p["r"] / 9_999) + 1, p["r"] % 9_999 + 1
        return F.concat_ws(
            "-",
            F.lpad(new.cast("string"), 3, "0"),
            F.lpad(group.cast("string"), 2, "0"),
            F.lpad(serial.cast("string"), 4, "0"),
        )

    return _bound(_rounds(key, "ssn", pair, F.lit(898), F.lit(99 * 9_999)), shown)


#: Days of 400 Gregorian years, and two factors of it.
CYCLE, CYCLE_LEFT, CYCLE_RIGHT = 146_097, 189, 773


def permuted_date(key: str, date: Column) -> Column:
    """A date permuted within its 400-year cycle, counted from 1800."""
    days = F.datediff(date, F.lit("1800-01-01").cast("date")).cast("long")
    inside = F.pmod(days, F.lit(CYCLE))
    pair = F.struct(F.floor(inside / CYCLE_RIGHT).cast("long").alias("l"), F.pmod(inside, F.lit(CYCLE_RIGHT)).alias("r"))
    done = _rounds(key, "date", pair, F.lit(CYCLE_LEFT), F.lit(CYCLE_RIGHT))
    return _bound(
        done,
        lambda p: F.date_add(
            F.lit("1800-01-01").cast("date"), (days - inside + p["l"] * CYCLE_RIGHT + p["r"]).cast("int")
        ),
    )


def _date_in(key: str, value: Column, pattern: str) -> Column:
    """A valid date in its format; digits that are no date are left."""
    day = F.try_to_timestamp(value, F.lit(pattern)).cast("date")
    return F.coalesce(F.date_format(permuted_date(key, day), pattern), value)


def ip_address(key: str, value: Column) -> Column:
    """The 32 bits of an address permuted."""

    def octet(k: int) -> Column:
        return F.split(value, r"\.")[k].cast("long")

    pair = F.struct((octet(0) * 256 + octet(1)).alias("l"), (octet(2) * 256 + octet(3)).alias("r"))
    done = _rounds(key, "ip", pair, F.lit(65_536), F.lit(65_536))
    return _bound(
        done,
        lambda p: F.concat_ws(
            ".", *(F.floor(x / 256).cast("string") if high else (x % 256).cast("string") for x in (p["l"], p["r"]) for high in (True, False))
        ),
    )


def email_address(key: str, value: Column) -> Column:
    """A letter or digit of the name and of the domain labels becomes another of its kind, the last label stays.

    The new characters come from a keyed digest of the whole address.
    """

    def of(digest: Column) -> Column:
        last = F.length(F.substring_index(value, ".", -1))
        body = F.substring(value, F.lit(1), F.length(value) - last)

        def other(c: Column, i: Column) -> Column:
            at = F.conv(F.substring(digest, F.pmod(i * 2, F.lit(126)) + 1, F.lit(2)), 16, 10).cast("int")
            return (
                F.when(c.rlike("^[0-9]$"), F.substring(F.lit("0123456789"), at % 10 + 1, F.lit(1)))
                .when(c.rlike("^[a-z]$"), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), at % 26 + 1, F.lit(1)))
                .when(c.rlike("^[A-Z]$"), F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), at % 26 + 1, F.lit(1)))
                .otherwise(c)
            )

        return F.concat(F.array_join(F.transform(F.split(body, ""), other), ""), F.substring_index(value, ".", -1))

    return _bound(F.sha2(F.concat(F.lit(f"{key}|email|"), F.lower(value)), 512), of)


def iban_check(country: Column, account: Column) -> Column:
    """The two check digits of an account, by the remainder over 97."""
    letters = F.concat(account, country, F.lit("00"))
    numbers = F.array_join(F.transform(F.split(letters, ""), lambda c: F.conv(c, 36, 10)), "")
    rest = F.aggregate(F.split(numbers, ""), F.lit(0), lambda r, d: (r * 10 + d.cast("int")) % 97)
    return F.lpad((98 - rest).cast("string"), 2, "0")


def iban(key: str, value: Column) -> Column:
    """A valid account number becomes another valid one of its country, letters staying in place; others are left."""

    def of(plain: Column) -> Column:
        country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain) - 4)
        digits = _digits(account)
        new = F.when(F.length(digits) >= 2, _refilled(account, permuted_digits(key, "iban", digits))).otherwise(account)
        made = _bound(new, lambda a: F.concat(country, iban_check(country, a), a))
        valid = F.substring(plain, 3, 2) == iban_check(country, account)
        spaced = F.when(
            F.contains(value, F.lit(" ")), F.trim(F.regexp_replace(made, "(.{4})", "$1 "))
        ).otherwise(made)
        return F.when(valid, spaced).otherwise(value)

    return _bound(F.regexp_replace(value, " ", ""), of)


def pseudonym(key: str, value: Column) -> Column:
    """The pseudonym of one found value by the first shape it has as a whole."""

    def has(kind: str) -> Column:
        return value.rlike(f"^(?:{SHAPES[kind]})$")

    return (
        F.when(has("email"), email_address(key, value))
        .when(has("iban"), iban(key, value))
        .when(has("ip"), ip_address(key, value))
        .when(has("iso_date"), _date_in(key, value, "yyyy-MM-dd"))
        .when(has("day_first_date"), _date_in(key, value, "dd.MM.yyyy"))
        .when(has("month_first_date"), _date_in(key, value, "MM/dd/yyyy"))
        .when(has("ssn"), social_number(key, value))
        .otherwise(phone_number(key, value))
    )


def _each(text: Column, shape: str, found: Callable[[Column], Column], between: Callable[[Column], Column]) -> Column:
    """The text with ``found`` of whatever has the shape and ``between`` of what stands before, between and behind."""
    parts = F.split(F.regexp_replace(text, f"({shape})", f"{PART}$1{PART}"), PART, -1)
    return F.array_join(F.transform(parts, lambda part, i: F.when(i % 2 == 1, found(part)).otherwise(between(part))), "")


def pseudonymised(key: str, text: Column) -> Column:
    """The text with every value replaced; all else is kept character by character.

    Card numbers are looked for in what the other shapes leave.
    """
    escaped = F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "e")), F.lit(PART), F.lit(ESCAPE + "p"))
    every = "|".join(SHAPES.values())
    done = _each(
        escaped,
        every,
        lambda value: pseudonym(key, value),
        lambda rest: _each(rest, DIGIT_GROUPS, lambda run: card_numbers(key, run), lambda other: other),
    )
    restored = F.replace(F.replace(done, F.lit(ESCAPE + "p"), F.lit(PART)), F.lit(ESCAPE + "e"), F.lit(ESCAPE))
    return F.when(escaped.rlike(f"{every}|{DIGIT_GROUPS}"), restored).otherwise(text)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``text`` pseudonymised, a row for a row; null stays null and empty stays empty.

    No shuffle, no Python; other columns are passed through.
    """
    return docs.withColumn("text", pseudonymised(key, F.col("text")))
