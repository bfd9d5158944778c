"""Pseudonyms: valid, linked, keyed, one to one, and nothing else changed."""

import datetime
import re
import time

import pytest
from signpost.llm import pii


def new_texts(spark, texts, key="k1"):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in sorted(pii.pseudonymize(rows, key).collect())]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10


def test_cards_stay_valid_and_linked(spark):
    a, b, c, d = new_texts(spark, ["pay 4111111111111111 now", "4111 1111 1111 1111", "4111-1111-1111-1111.", "4111111111111112"])
    new = re.search(r"\d{16}", a).group()
    assert new != "4111111111111111" and luhn(new) == 0
    assert b == " ".join(re.findall("....", new)) and c == "-".join(re.findall("....", new)) + "."
    assert d == "4111111111111112"


def test_dates(spark):
    one, other, wrong = new_texts(spark, ["on 2024-02-29, 29.02.2024 and 02/29/2024", "1.3.2024", "2023-02-29 13/13/2000"])
    iso, dmy, mdy = re.findall(r"[\d./-]+\d", one)
    day = datetime.date.fromisoformat(iso)
    assert day.strftime("%d.%m.%Y") == dmy and day.strftime("%m/%d/%Y") == mdy
    assert iso != "2024-02-29" and datetime.datetime.strptime(other, "%d.%m.%Y")
    assert wrong == "2023-02-29 13/13/2000"


def test_dates_are_permuted(spark):
    start = datetime.date(1800, 1, 1)
    days = [(start + datetime.timedelta(n)).isoformat() for n in range(0, 3000)]
    new = new_texts(spark, days)
    assert len(set(new)) == len(days) and all(datetime.date.fromisoformat(d) for d in new)


def test_short_numbers_are_permuted(spark):
    """All values of a small alphabet map one to one."""
    values = [f"{n:04d}" for n in range(2000)]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in rows.selectExpr(pii.permute_text("v", "k", "x", (pii.DIGITS,))).collect()]
    assert len(set(got)) == len(values) and all(re.fullmatch(r"\d{4}", g) for g in got)
    numbers = spark.range(189 * 773).selectExpr(pii.permute_number("id", "k", "x", 189, 773) + " as n")
    assert numbers.distinct().count() == 189 * 773
    low, high = numbers.selectExpr("min(n)", "max(n)").first()
    assert (low, high) == (0, 189 * 773 - 1)


def test_other_kinds(spark):
    texts = [
        "mail Jo.Doe7@mail4.example.com",
        "JO.DOE7@mail4.example.com",
        "call +1 (017) 555-7713",
        "(017) 555-7713",
        "10.0.0.255",
        "300.1.1.1",
        "123-45-6789 and 000-12-3456",
        "DE89 3704 0044 0532 0130 00",
        'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"',
        "+33 6 12 34 56 78",
    ]
    new = new_texts(spark, texts)
    assert re.fullmatch(r"mail [A-Z][a-z]\.[A-Z][a-z]{2}\d@mail4\.example\.com", new[0]) and new[0] != texts[0]
    assert new[1].lower() == new[0].lower().removeprefix("mail ")
    assert new[2].startswith("call +1 (") and new[2].endswith(new[3]) and new[3] != texts[3]
    assert all(0 <= int(o) <= 255 for o in new[4].split(".")) and new[4] != texts[4]
    assert new[5] == texts[5]
    assert re.fullmatch(r"\d{3}-\d\d-\d{4} and 000-12-3456", new[6]) and new[6] != texts[6]
    iban = new[7].replace(" ", "")
    assert iban[:2] == "DE" and int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1 and new[7] != texts[7]
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', new[8]) and new[8] != texts[8]
    assert new[9].startswith("+33 ") and new[9] != texts[9] and re.sub(r"\d", "0", new[9]) == re.sub(r"\d", "0", texts[9])


def test_nothing_else_changes(spark):
    texts = [None, "", "plain text", "Version 3.0, 1234567", "a = b: c@d", "x" * 300_000 + " 4111111111111111 " + "ü" * 10]
    new = new_texts(spark, texts)
    assert new[:5] == texts[:5]
    assert len(new[5]) == len(texts[5]) and new[5] != texts[5] and new[5].startswith("x" * 300_000)


def test_keys_and_columns(spark):
    rows = [(1, "4111111111111111", "k"), (1, "4111111111111111", "k")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _pii_found string")
    one, other = (pii.pseudonymize(frame, k, count_as="n") for k in ("k1", "k2"))
    assert one.columns == [*frame.columns, "n"]
    (a, b), c = one.collect(), other.first()
    assert a == b and a.n == 1 and a._pii_found == "k" and a.text != c.text
    assert pii.pseudonymize(frame.limit(0), "k").count() == 0
    with pytest.raises(ValueError):
        pii.pseudonymize(frame, "o'k")


def test_long_values(spark):
    """Texts that repeat any part of a pattern neither end a task nor take long."""
    units = ["ab.", "a.", "1.", "1-", "+1 ", "GB12 ABCD ", "ABCD ", "a@b.", "1234 ", "12/", "(12) ", "token=", "x" * 60 + "."]
    rows = [(i, head + unit * 20_000 + tail) for i, unit in enumerate(units) for head, tail in (("x@", "com"), ("", ""))]
    start = time.perf_counter()
    out = pii.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()
    assert len(out) == len(rows) and time.perf_counter() - start < 120
    addressed = pii.pseudonymize(spark.createDataFrame([(1, "ann@" + "ab." * 120 + "com")], "doc_id long, text string"), "key")
    assert addressed.first().text != "ann@" + "ab." * 120 + "com"
