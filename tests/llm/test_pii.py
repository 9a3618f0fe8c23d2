import hashlib
import random
import re

from courtside.llm import pii, queries
from tests.llm.cases import edge_docs, no_docs

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    d = [int(c) for c in digits[::-1]]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def brute(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(digits(m[0])) <= 15]


def test_random_texts_against_the_patterns():
    rng = random.Random(3)
    for _ in range(20000):
        letters = rng.choice(["a.@-1 ", "0123456789 -", "12.", "+0123 ().-", "ab@.+1é😀", "4111 -", "300.25@+a"])
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert [s for s in pii.find_spans(t) if s[0] in pii.BASE_KINDS] == brute(t), t


def test_added_spans():
    t = "https://bob:pw@intranet/x IBAN: DE89 3704 0044 0532 0130 00, SSN 123-45-6789 acct no. 12345678 http://[2001:db8::1]/"
    assert [(k, t[a:b]) for k, a, b in pii.find_spans(t)] == [
        ("login", "bob:pw"), ("ip6", "2001:db8::1"), ("iban", "DE89 3704 0044 0532 0130 00"),
        ("account", "123-45-6789"), ("account", "12345678")]
    assert pii.find_spans("IBAN DE00 0000, SSN 000-12-3456, accounts 1234567, konto") == []


def test_cues_in_any_case_and_numbers_in_any_grouping():
    for t, number in [("İ😀 Social Security Number: 123-45-6789.", "123-45-6789"), ("Routing Number: 021000021", "021000021"),
                      ("aCCount nO 12345678", "12345678"), ("SSN: 123456789", "123456789"), ("Ssn 123 45 6789,", "123 45 6789")]:
        assert [(k, t[a:b]) for k, a, b in pii.find_spans(t)] == [("account", number)], t
        assert number not in pii.redact(t)
    for t in ("SSN 1234567890", "SSN 000123456", "SSN 123 00 4567", "SSN 987654321", "\u212aonto 12345678"):
        assert pii.find_spans(t) == [], t


def test_redaction():
    assert pii.redact("mail a@b.co or +49 170 1234567.") == "mail [email] or [phone]."
    assert pii.redact("http://u:p@h.io/") == "http://[login]/"  # login and email overlap: both go
    assert pii.redact(None) is None and pii.redact("") == ""


def test_very_long_runs_take_linear_time():
    for t in ("a" * 300000, "1" * 300000, "1." * 150000, "+1 " * 100000, "a@" * 150000):
        pii.find_spans(t)


def test_query_against_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = queries.QUERIES["op9_pii_anchors"](spark, sf_dir).collect()
    assert len(out) == len(texts)
    for r in out:
        base = brute(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == k for s in base) for k in pii.BASE_KINDS]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest() and r["spans"].startswith(joined)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    assert pii.find(docs).count() == docs.count()
    assert pii.redact_documents(docs).columns == docs.columns
    assert pii.find(no_docs(spark)).count() == 0
