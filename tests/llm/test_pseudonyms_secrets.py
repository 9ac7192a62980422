import datetime
import re

import pytest
from pyspark.sql import functions as F

from obralake.llm.pseudonyms import luhn_digit, permute, pseudonymise, replace_personal_data
from obralake.llm.secret_scan import scan_secrets, spans_text

from .common import documents, prose

KEY = b"key"
VALUES = {"card": "4155 2795 6545 5123", "email": "jo.smith+7@mail.example.com", "phone": "+1 (212) 555-0187",
          "address": "203.0.113.77", "date": "2021-02-28", "national": "078-05-1120",
          "iban": "GB82 WEST 1234 5698 7654 32"}


@pytest.mark.parametrize("size", [2, 10, 97, 1000, 4096])
def test_permutation(size):
    assert sorted(permute(i, size, KEY, "t") for i in range(size)) == list(range(size))


@pytest.mark.parametrize("kind", VALUES)
def test_format_and_validity_are_kept(kind):
    value = VALUES[kind]
    text = f"x {value} y {value}."
    new, found = pseudonymise(text, KEY)
    assert [(k, text[a:b]) for k, a, b in found] == [(kind, value)] * 2
    first, second = new[2:2 + len(value)], new[5 + len(value):5 + 2 * len(value)]
    assert first == second != value and len(new) == len(text)
    assert re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", first))) == \
        re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", value)))
    again, places = pseudonymise(new, KEY)
    assert [k for k, _, _ in places] == [kind] * 2  # still valid
    assert pseudonymise(text, b"other")[0] != new


@pytest.mark.parametrize("kind, value, rest", [
    ("card", "4111 1111 1111 1111", " 12/26"), ("card", "4111 1111 1111 1111", " 123"),
    ("card", "4111111111111111", " 12/26"), ("card", "4111-1111-1111-1111", "-123 x"),
    ("card", "4111 1111 1111 1111", " 1 23"), ("iban", "BE68 5390 0754 7034", " EUR"),
    ("iban", "BE68 5390 0754 7034", " PLEASE PAY"), ("iban", "BE68539007547034", " 1000 EUR"),
    ("iban", "GB82 WEST 1234 5698 7654 32", " EUR"), ("phone", "212-555-0187", " x"),
    ("phone", "1-212-555-0187", ""), ("phone", "212.555.0187", "."), ("phone", "212 555 0187", ", 12")])
def test_what_follows_a_value_does_not_hide_it(kind, value, rest):
    text = f"pay {value}{rest}"
    new, found = pseudonymise(text, KEY)
    assert found == [(kind, 4, 4 + len(value))]
    assert new[4:4 + len(value)] != value and new[4 + len(value):] == rest and len(new) == len(text)
    assert [k for k, _, _ in pseudonymise(new[4:4 + len(value)], KEY)[1]] == [kind]  # still valid


def test_usual_card_length_goes_before_a_chance_longer_one():
    text = next(t for i in range(10) if luhn(re.sub(" ", "", t := f"4111 1111 1111 1111 {i}")))
    assert pseudonymise(text, KEY)[1] == [("card", 0, 19)]


def test_what_is_not_valid_stays():
    for text in ["4155 2795 6545 5124", "2021-02-30", "31/02/2020", "999.1.1.1", "1.2.3", "000-12-3456",
                 "GB82 WEST 1234 5698 7654 33", "a@b", "x" * 5000, "1" * 5000, "@" * 3000, "v1.2.3.4.5", ""]:
        assert pseudonymise(text, KEY) == (text, [])


def test_dates_are_permuted_among_dates():
    days = [datetime.date(1950, 1, 1) + datetime.timedelta(days=37 * i) for i in range(400)]
    new = {pseudonymise(d.strftime("%d/%m/%Y"), KEY)[0] for d in days}
    assert len(new) == 400
    assert len({pseudonymise(d.isoformat(), KEY)[0] for d in days}) == 400
    for d in ("3.4.1999", "12/25/2020", "1/1/2001"):
        assert pseudonymise(d, KEY)[1][0][0] == "date"


def test_rows_and_columns_pass_through(spark):
    rows = [(1, "mail a.b@c.example.org"), (None, None), (3, ""), (3, ""), (4, prose(1, 3000) + " 8.8.4.4")]
    docs = documents(spark, rows, "c0 long, personal_data string, t int")
    got = replace_personal_data(docs, "k").collect()
    assert [r.doc_id for r in got] == [1, None, 3, 3, 4] and got[0].c0 == 7
    assert [[x.kind for x in r.personal_data] for r in got] == [["email"], [], [], [], ["address"]]
    assert got[1].text is None and got[4].text[:-7] == rows[4][1][:-7]
    assert replace_personal_data(docs, "k", found_col=None).columns == docs.columns
    assert replace_personal_data(documents(spark, []), "k").collect() == []
    again = replace_personal_data(docs, "k").filter("doc_id = 1").first()
    assert again.text == got[0].text


def luhn(number):
    return luhn_digit(number[:-1]) == number[-1]


def test_luhn_digit():
    assert luhn("4111111111111111") and luhn("79927398713") and not luhn("4111111111111112")


ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_secrets_match_brute_force(spark):
    own, copied = "Qx7fLm29ZtB4kW8sVn3p", "Rr5tYu81OpLk3Jh6Gf2d"
    texts = [None, "", "plain", f"token = {own}", f"PASSWORD:'{copied}' x", f"api_key={copied}", f"secret = {copied}!",
             "secret:token = longvalue1", "password=abc token=abcdefgh", "passwd: short", "AKIA" + "A1" * 8,
             "AKIAAKIA", "xAKIA" + "Z" * 15 + " y", "é😀 token=" + "0123456789abcdef" * 2 + " ü", "f" * 23, "a" * 24 + "g" + "b" * 30,
             "\u0001\u0002 token=\u0001abcdefgh", "token=abcdefgh\u0002 token=hgfedcba", prose(1, 5000) + " token: ZZZZZZ",
             "token=aaaaaa " * 300, "apikey\"  :  \"k-e_y/=+.9\"", "toKen=KKabcdef"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "token=nobody1")]
    docs = documents(spark, rows, "key long, start string, value int").withColumn(
        "source", F.concat(F.lit("s"), F.coalesce(F.col("doc_id") % 4, F.lit(9))))
    got = scan_secrets(docs, F.col("source"), F.col("source"))
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    out = got.select("doc_id", spans_text(base).alias("base"), spans_text(F.col("secrets")).alias("spans"), "secrets").collect()
    assert sorted(((r.doc_id, r.base) for r in out), key=str) == sorted(((i, brute(t)) for i, t in rows), key=str)
    by_id = {r.doc_id: r for r in out}
    assert by_id[3].spans == "assign:0:28,live:8:28"
    assert {s["class"] for i in (4, 5, 6) for s in by_id[i].secrets} == {"copied"}
    assert scan_secrets(docs.limit(0), F.col("source"), F.col("source")).collect() == []
