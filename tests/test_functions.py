import hashlib
import random
import unicodedata
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import (
    capitalize, exact_cents_text, fold, hash_id, initcap_words, parse_amount, parse_date,
    parse_date_any, parse_number, path_parts, split_packed, strip_fences, trim_ws,
)

AMOUNTS = {
    None: None, "1.234,56": 1234.56, "1,234.56": 1.23456, "12,5": 12.5, "1,234,567": None, "1.234": 1.234,
    "1.234.567": None, "-3,00": -3.0, " 7 ": 7.0, " 7,5\t": 7.5, "10 €": None, "": None, "1d": None,
    "nan": None, "inf": None, "1e3": 1000.0, "1_000": 1000.0, ".5": 0.5, "5.": 5.0, "+3": 3.0, "-": None, ".": None,
}


def test_amount_truth_table(values):
    assert dict(zip(AMOUNTS, values(parse_amount, list(AMOUNTS)))) == AMOUNTS


def test_amount_us_locale(values):
    assert values(lambda c: parse_amount(c, "us"), ["1,234.56", "1,234,567", "12.5"]) == [1234.56, 1234567.0, 12.5]
    with pytest.raises(ValueError):
        parse_amount(F.lit("1"), "xx")


def test_plain_number_rejects_separators(values):
    assert values(parse_number, ["1.5", "1,5", "1.234,5", "7"]) == [1.5, None, None, 7.0]


def test_cents_match_python(values):
    rng = random.Random(5)
    xs = [0.125, 2.675, 1.005, -2.675, 0.0, -0.001, 0.005, 999999.995, None]
    xs += [round(rng.uniform(-10 ** rng.randint(0, 9), 10 ** rng.randint(0, 9)), rng.randint(0, 4)) for _ in range(3000)]
    xs += [rng.randint(-10**8, 10**8) / 8 for _ in range(3000)]
    assert values(exact_cents_text, xs, "double") == [None if x is None else f"{x:.2f}" for x in xs]


def test_dates(values):
    texts = ["1/7/2025", "01/07/2025", "31/02/2025", " 01/07/2025", "01/07/25", "15/12/1500", None]
    assert values(lambda c: parse_date(c, "%d/%m/%Y"), texts) == [date(2025, 7, 1)] * 2 + [None] * 5
    stamps = ["2025-07-01 10:05:09", "2025-07-01", "2025-13-01 00:00:00"]
    assert values(lambda c: parse_date(c, "%Y-%m-%d %H:%M:%S"), stamps) == [date(2025, 7, 1), None, None]
    assert values(parse_date_any, ["2025-07-01", "13/7/2025", "x"]) == [date(2025, 7, 1), date(2025, 7, 13), None]
    with pytest.raises(ValueError):
        parse_date(F.lit("x"), "%j")


def _initcap(text):
    delimiters = set("[](){}/|\\<>!?@\"^#$&~_,.:;*%+-")
    out, start = [], True
    for ch in text:
        if ch in delimiters or ch.isspace():
            out.append(ch)
            start = True
        else:
            out.append(ch.upper() if start else ch.lower())
            start = False
    return "".join(out)


def test_initcap(values):
    rng = random.Random(2)
    texts = ["".join(rng.choice("aBñÉ .,-*#\t\n'9$\\[x= \x01") for _ in range(rng.randint(0, 14))) for _ in range(2000)]
    texts += ["MI.COM AMAZON*PRIME o-bi"]
    assert values(initcap_words, texts) == [_initcap(t) for t in texts]


def test_fold_matches_canonical_decomposition(values):
    letters = [chr(c) for c in range(0x20, 0x2000) if unicodedata.age(chr(c)) < "12"] if hasattr(unicodedata, "age") else [
        chr(c) for c in list(range(0x20, 0x590)) + list(range(0x1E00, 0x2000))]
    uppers = values(F.upper, letters)
    bare = ["".join(p for p in unicodedata.normalize("NFD", u) if not unicodedata.category(p).startswith("M")) for u in uppers]
    assert values(fold, letters) == bare
    assert values(lambda c: fold(c, hangul=True), ["각가", "ñ각"]) == [unicodedata.normalize("NFD", "각가"), "N" + unicodedata.normalize("NFD", "각")]


def test_text_helpers(values):
    assert values(trim_ws, ["\t  a b 　\n", "", None]) == ["a b", "", None]
    assert values(capitalize, ["BANK one", "é", "", None]) == ["Bank one", "É", "", None]
    assert values(lambda c: split_packed(c, 2), ["a|b||d", "a"]) == ["", None]
    assert values(strip_fences, ["```csv\na,b\n```\n"]) == ["a,b"]
    for i, expected in enumerate((["x.tar.GZ", "f", ".hid"], ["x.tar", "f", ".hid"], [".gz", "", ""])):
        assert values(lambda c: path_parts(c)[i], ["/a/b.c/x.tar.GZ", "f", ".hid"]) == expected


def test_hash_golden(spark):
    rows = [("2025-07-01", "  Café BAR\t", 2.675), ("2025-07-01", "x", -3.0), ("2025-07-01", None, 1.0), (None, "x", 1.0)]
    df = spark.createDataFrame(rows, "f string, c string, x double")
    got = [r[0] for r in df.select(hash_id(F.col("f"), F.col("c"), F.col("x"))).collect()]
    text = lambda f, c, x: hashlib.sha256(f"{f}-{c.strip().lower()}-{x:.2f}".encode()).hexdigest()
    assert got == [text(*rows[0]), text(*rows[1]), None, None]


def test_more_date_directives(values):
    from datetime import date

    from ledgerlake.functions.dates import parse_date, supported

    assert values(lambda c: parse_date(c, "%d/%m/%y"), ["01/07/25", "31/12/69", "1/1/68", "1/1/2025"]) == [
        date(2025, 7, 1), date(1969, 12, 31), date(2068, 1, 1), None]
    assert values(lambda c: parse_date(c, "%d %b %Y"), ["1 Jul 2025", "31 feb 2025", "1 Julio 2025"]) == [date(2025, 7, 1), None, None]
    assert values(lambda c: parse_date(c, "%B %d, %Y %I:%M %p"), ["July 4, 2025 11:05 PM"]) == [date(2025, 7, 4)]
    assert values(lambda c: parse_date(c, "%Y-%m-%d %H:%M:%S.%f"), ["2025-07-01 10:00:00.5", "2025-07-01 10:00:00.123456", "2025-07-01 10:00:00."]) == [
        date(2025, 7, 1), date(2025, 7, 1), None]
    assert supported("%d.%m.%Y") and not supported("%d %Q")
