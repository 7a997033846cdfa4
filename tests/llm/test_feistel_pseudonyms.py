"""Pseudonyms against a plain Python Feistel network."""

import datetime as dt
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tarmac.llm import feistel_pseudonyms as fp
from tarmac.llm.tables import table

KEY = "k"


def network(use, left, right, left_size, right_size):
    for turn in range(fp.ROUNDS):
        half = right if turn % 2 == 0 else left
        noise = int(hashlib.sha256(f"{KEY}|{use}|{turn}|{half}".encode()).hexdigest()[:12], 16)
        if turn % 2 == 0:
            left = (left + noise) % left_size
        else:
            right = (right + noise) % right_size
    return left, right


def digits_of(kind, digits):
    n, half = len(digits), len(digits) // 2
    a, b = network(f"{kind}|{n}", int(digits[:half]), int(digits[half:]), 10**half, 10 ** (n - half))
    return f"{a:0{half}d}{b:0{n - half}d}"


def refill(value, digits):
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in value)


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10


def card(value):
    digits = re.sub(r"\D", "", value)
    if luhn(digits):
        return value
    body = digits_of("card", digits[:-1])
    return refill(value, next(body + c for c in "0123456789" if luhn(body + c) == 0))


def date(value, pattern):
    day = (dt.datetime.strptime(value, pattern).date() - dt.date(1800, 1, 1)).days
    base = day // fp.CYCLE * fp.CYCLE
    a, b = network("date", *divmod(day - base, fp.CYCLE_RIGHT), fp.CYCLE_LEFT, fp.CYCLE_RIGHT)
    return (dt.date(1800, 1, 1) + dt.timedelta(base + a * fp.CYCLE_RIGHT + b)).strftime(pattern)


def phone(value):
    country = (re.match(r"\+[0-9]{1,3}(?=[ .\-(])", value) or re.match("", value)).group()
    rest = value[len(country) :]
    return country + refill(rest, digits_of("phone", re.sub(r"\D", "", rest)))


def ip(value):
    a, b, c, d = map(int, value.split("."))
    left, right = network("ip", a * 256 + b, c * 256 + d, 65536, 65536)
    return f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"


def ssn(value):
    area, group, serial = map(int, value.split("-"))
    left, right = network("ssn", area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999)
    area = left + 1 + (left + 1 >= 666)
    return f"{area:03d}-{right // 9999 + 1:02d}-{right % 9999 + 1:04d}"


VALUES = {
    "4041894974608795": card,
    "4041 8949 7460 8795": card,
    "4041894974608796": card,
    "1984-02-29": lambda v: date(v, "%Y-%m-%d"),
    "1984-02-30": lambda v: v,
    "31.12.1999": lambda v: date(v, "%d.%m.%Y"),
    "12/31/1999": lambda v: date(v, "%m/%d/%Y"),
    "13/31/1999": lambda v: v,
    "+1 (017) 555-7713": phone,
    "123-456-7890": phone,
    "+491511234567": phone,
    "233.254.104.120": ip,
    "256.1.1.1": lambda v: v,
    "123-45-6789": ssn,
    "899-99-9999": ssn,
    "000-12-3456": lambda v: v,
}


def changed(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.text for r in fp.pseudonymise(frame, KEY).orderBy("doc_id").collect()]


def test_values_equal_the_plain_network(spark):
    texts = [f"before {value}, after" for value in VALUES]
    assert changed(spark, texts) == [f"before {make(value)}, after" for value, make in VALUES.items()]


def test_equal_values_stay_linked_and_text_stays(spark):
    texts = ["x 4041894974608795\ny", "4041894974608795", "mail a.b9@mail.example.com!", "A.b9@mail.example.com", "v 2.0.\n4.4.4 7"]
    got = changed(spark, texts)
    assert got[0][2:18] == got[1] != texts[1]
    assert re.fullmatch(r"mail [a-z]\.[a-z][0-9]@[a-z]{4}\.[a-z]{7}\.com!", got[2]) and got[2] != texts[2]
    assert got[2][6:-1] == got[3][1:]
    assert got[4] == texts[4]


def test_account_numbers_stay_valid(spark):
    texts = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "DE88 3704 0044 0532 0130 00"]
    got = changed(spark, texts)

    def valid(text):
        plain = text.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1

    assert valid(got[0]) and valid(got[1]) and got[0] != texts[0] and got[1][4:8] == "WEST"
    assert len(got[0]) == len(texts[0]) and got[2] == texts[2]


@pytest.mark.parametrize("n", [2, 3, 4])
def test_digits_are_permuted(spark, n):
    digits = spark.range(10**n).select(F.lpad(F.col("id").cast("string"), n, "0").alias("d"))
    assert digits.select(fp.permuted_digits(KEY, "t", F.col("d"))).distinct().count() == 10**n


def test_days_are_permuted(spark):
    days = spark.range(fp.CYCLE).select(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    row = days.select(fp.permuted_date(KEY, F.col("d")).alias("d")).agg(F.countDistinct("d"), F.min("d"), F.max("d")).first()
    assert tuple(row) == (fp.CYCLE, dt.date(1800, 1, 1), dt.date(2199, 12, 31))


def test_edge_rows_and_native_plan(edge_docs, no_docs):
    done = fp.pseudonymise(edge_docs, KEY)
    assert done.schema.names == edge_docs.schema.names
    assert sorted(map(str, done.collect())) == sorted(map(str, edge_docs.collect()))
    assert fp.pseudonymise(no_docs, KEY).count() == 0
    text = done._jdf.queryExecution().toString()
    assert "Python" not in text and "Exchange" not in text


def test_given_documents(spark, small):
    """Whatever a plain search finds is replaced by its plain pseudonym, and nothing else."""
    docs = table(spark, small, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r.text for r in fp.pseudonymise(docs, KEY).collect()}
    shapes = {
        r"\+1 \(\d{3}\) \d{3}-\d{4}(?!\d)": phone,
        r"(?<!\d)\d{16}(?!\d)": card,
        fp.SHAPES["ip"]: ip,
    }
    mails = 0
    for doc_id, text in before.items():
        for shape, make in shapes.items():
            text = re.sub(shape, lambda m, make=make: make(m.group()), text)
        pieces = re.split(r"[\w.]+@[\w.]+\w", text)
        mails += len(pieces) - 1
        if len(pieces) == 1:
            assert after[doc_id] == text
    assert mails < len(before)


def test_neighbours_hide_no_value(spark):
    """Digits, codes, dates and words beside a card or an account number leave it found, and stay themselves."""
    cards = ["{} 123", "{} 12/25", "2024 {}", "{}-999 x", "12 {} 35 56", "{} {}", "{} 2024-02-30", "{} 123-45"]
    number = "4111 1111 1111 1111"
    plain = number.replace(" ", "")
    texts = [text.replace("{}", n) for text in cards for n in (number, plain)]
    assert changed(spark, texts) == [text.replace("{}", card(n)) for text in cards for n in (number, plain)]
    ibans = ["ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "BE68 5390 0754 7034", "PL61109010140000071219812874"]
    alone = changed(spark, ibans)
    assert all(new != old and len(new) == len(old) for new, old in zip(alone, ibans))
    for after in (" BIC", " 2023", "X", " ABCD 12", ", 7"):
        assert changed(spark, [i + after for i in ibans]) == [new + after for new in alone]
    assert changed(spark, [f"{number} 123-456-7890"]) == [f"{card(number)} {phone('123-456-7890')}"]
    (long,) = changed(spark, ["7" * 100_000])
    assert long == "7" * 100_000
