import re

import pytest
from hypothesis import given, settings, strategies as st

from tallyhouse.llm import pii

CASES = {
    "mail a.bc12@mail3.example.com, x": r"mail [a-z]\.[a-z]{2}\d{2}@mail3\.example\.com, x",
    "ip 10.200.3.4.": r"ip \d+\.\d+\.\d+\.\d+\.",
    "4111 1111 1111 1111 and 4111111111111111": r"(\d{4} ?){4} and \d{16}",
    "on 1999-12-31": r"on [12]\d{3}-\d\d-\d\d",
    "ssn 123-45-6789": r"ssn \d{3}-\d\d-\d{4}",
    "DE89 3704 0044 0532 0130 00": r"DE\d\d( \d{4}){4} \d\d",
    "+1 (386) 555-1234 4111111111111111 10.0.0.1": r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4} \d{16} \d+\.\d+\.\d+\.\d+",
    "+44 20 7946 0958": r"\+44 \d\d \d{4} \d{4}",
}
UNCHANGED = ["4111111111111112", "300.1.1.1", "2023-02-30", "000-12-3456", "666-12-3456", "DE88 3704 0044 0532 0130 00", "word", "", None, "1.5", "9" * 25]


def _luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def _both(documents, texts):
    docs = documents(list(enumerate(texts)))
    there = pii.pseudonymised(docs, "key")
    back = pii.pseudonymised(there, "key", revert=True)
    return zip(*[[r.text for r in df.orderBy("doc_id").collect()] for df in (there, back)], strict=True)


def test_formats_and_way_back(documents):
    texts = [*CASES, *UNCHANGED]
    for text, (there, back) in zip(texts, _both(documents, texts), strict=True):
        assert back == text
        if text in CASES:
            assert there != text
            assert re.fullmatch(CASES[text], there)
        else:
            assert there == text


def test_check_digits_and_links(documents):
    texts = [f"{n} x" for n in ("4111111111111111", "5500005555555559", "340000000000009", "6304000000000000")]
    moved = [there for there, _ in _both(documents, texts + texts)]
    assert moved[:4] == moved[4:]
    assert len(set(moved)) == 4
    assert all(_luhn(m.split()[0]) for m in moved[:3])


@settings(deadline=None, max_examples=5)
@given(st.lists(st.dates(), min_size=20, max_size=20, unique=True), st.integers(0, 10**9))
def test_dates_are_permuted(spark, dates, salt):
    dates = [d for d in dates if 1800 <= d.year <= 2199]
    docs = spark.createDataFrame([(i, d.isoformat()) for i, d in enumerate(dates)], "doc_id long, text string")
    there = pii.pseudonymised(docs, str(salt))
    back = pii.pseudonymised(there, str(salt), revert=True).orderBy("doc_id").collect()
    assert [r.text for r in back] == [d.isoformat() for d in dates]
    assert there.select("text").distinct().count() == len(dates)


def test_the_key_matters_and_plans_stay_native(documents):
    docs = documents([(1, "4111111111111111")])
    assert pii.pseudonymised(docs, "a").first().text != pii.pseudonymised(docs, "b").first().text
    plan = pii.pseudonymised(docs, "a")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert "Exchange" not in plan


@pytest.mark.parametrize("n", [0, 3])
def test_counts_and_other_columns(documents, n):
    docs = documents([(7, "a@b.org " * n)] * 2).withColumnRenamed("source", "n_replaced")
    found = pii.pseudonymised(docs, "k").collect()
    assert [r.n_replaced for r in found] == [n, n]
    assert pii.pseudonymised(documents([]), "k").count() == 0


def _valid_iban(text):
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


IBANS = [
    ("BE68 5390 0754 7034", " BIC"),
    ("AT61 1904 3002 3457 3201", " BIC"),
    ("ES91 2100 0418 4502 0005 1332", " EUR"),
    ("ES9121000418450200051332", " BIC"),
    ("PL61 1090 1014 0000 0712 1981 2874", " 12"),
    ("HU42 1177 3016 1111 1018 0000 0000", " A1 next"),
    ("BE68 5390 0754 7034", " 4111 1111 1111 1111"),
]


def test_an_iban_ends_at_its_countrys_length(documents):
    texts = [f"to {iban}{after}" for iban, after in IBANS]
    for (iban, after), text, (there, back) in zip(IBANS, texts, _both(documents, texts), strict=True):
        moved = there[3 : 3 + len(iban)]
        assert back == text and moved != iban and moved[:2] == iban[:2] and _valid_iban(moved)
        assert there[3 + len(iban) :] == after or after.endswith("1111")


def test_all_digits_of_a_long_iban_move(documents):
    ibans = []
    for n in range(10):
        bban = f"{n:024d}7"
        check = 98 - int(bban + "1416" + "00") % 97
        ibans.append(f"EG{check:02d}{bban}")
    there = [there for there, _ in _both(documents, ibans)]
    assert all(map(_valid_iban, there)) and len({t[-1] for t in there}) > 1


NUMBERS = {
    "call 555-123-4567 now": r"call \d{3}-\d{3}-\d{4} now",
    "(212-555-0187)": r"\([2-9]\d\d-[2-9]\d\d-\d{4}\)",
    "212.555.0187.": r"[2-9]\d\d\.[2-9]\d\d\.\d{4}\.",
    "212 555 0187": r"[2-9]\d\d [2-9]\d\d \d{4}",
    "1-800-555-0199": r"1-[2-9]\d\d-[2-9]\d\d-\d{4}",
    "+1 (017) 555-7713": r"\+1 \(\d{3}\) \d{3}-\d{4}",
}


def test_bare_telephone_numbers(documents):
    texts = [*NUMBERS, "100 200 3000", "1555-123-4567", "555-123-45678", "1.555.123.4567.8"]
    for text, (there, back) in zip(texts, _both(documents, texts), strict=True):
        assert back == text
        if text in NUMBERS:
            assert there != text and re.fullmatch(NUMBERS[text], there)
        else:
            assert there == text


def test_numbers_outside_the_plan_stay_apart_and_come_back(documents):
    texts = [f"{area:03d}-{office:03d}-4567" for area in (0, 17, 199, 200, 999) for office in (0, 199, 200, 999)]
    both = list(_both(documents, texts))
    assert [back for _, back in both] == texts and len({there for there, _ in both}) == len(texts)


DATES = ["31.12.1999", "3.4.1999", "3.12.1999", "12.3.1999", "04/03/1999", "12/25/1999", "25/12/1999", "7/4/2001", "1999/12/31"]
DATES += ["1999.2.28", "2001-2-3", "31-12-1999", "12/31/99", "1/2/03", "29.02.00", "29.02.2000"]


def test_dates_of_other_forms(documents):
    texts = [f"on {d}, then" for d in DATES]
    for text, (there, back) in zip(texts, _both(documents, texts), strict=True):
        assert back == text and there != text
        assert re.sub(r"\d", "0", there) == re.sub(r"\d", "0", text)
        fields = re.split("[-./]", there[3:-6])
        year = next((f for f in fields if len(f) == 4), fields[-1])
        day, month = sorted(map(int, [f for f in fields if f is not year]), reverse=True)
        readings = [(day, month), (month, day)]
        assert any(1 <= m <= 12 and 1 <= d <= 31 for d, m in readings)
    same = ["31.02.2023", "13/13/2013", "1.2.10", "31.12.1799", "1.31.12.1999", "31.12.1999.1", "99.99.99"]
    assert [there for there, _ in _both(documents, same)] == same


def test_a_date_before_a_time(documents):
    (there, back), = _both(documents, ["1999-12-31T10:00"])
    assert back == "1999-12-31T10:00" and there != back and there.endswith("T10:00")
