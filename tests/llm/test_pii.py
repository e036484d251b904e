import hashlib
import random
import re

from offerloom.llm import pii
from offerloom.llm.queries import QUERIES

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def plain(text):
    """The base rules by the patterns as they are given."""
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    tests = (
        ("email", EMAIL, lambda s: True), ("ip", IP, lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", CARD, lambda s: 16 <= len(digits(s)) <= 19 and pii.luhn(digits(s))), ("phone", PHONE, lambda s: 8 <= len(digits(s)) <= 15),
    )
    return [(k, m.start(), m.end()) for k, pattern, ok in tests for m in re.finditer(pattern, text) if ok(m.group())]


def base_spans(text):
    return [s[:3] for s in pii.find_spans(text) if s[4]]


def test_base_spans_equal_the_patterns_on_random_texts():
    rnd = random.Random(5)
    for alphabet in ("a.@-_b ", "0123456789. ", "45-1 2", "+1 (5)-.x", "a@b.c1+2 -()é"):
        for _ in range(3000):
            text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
            assert base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for run in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+" * 300_000, "a@" * 150_000, "1 " * 150_000, "+1" + " " * 300_000):
        base_spans(run)


def test_address_parts_with_long_runs_of_zeros():
    zeros = "0" * 5000
    assert base_spans(f"{zeros}1.1.1.1") == [("ip", 0, 5007)] and base_spans(f"1.{zeros}.1.{zeros}255") == [("ip", 0, 10_008)]
    assert base_spans(f"{zeros}256.1.1.1") == []


def test_validators():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB83 WEST 1234 5698 7654 32")


def test_method_adds_spans_by_checksum_and_context():
    kinds = lambda text: [(s[0], text[s[1] : s[2]], s[4]) for s in pii.find_spans(text)]
    assert kinds("IBAN GB82WEST12345698765432.") == [("iban", "GB82WEST12345698765432", False)]
    assert kinds("GB83WEST12345698765432") == []
    assert kinds("amex card 378282246310005") == [("card", "378282246310005", False)]
    assert kinds("number 378282246310005") == []
    assert kinds("please call 555-123-4567 now") == [("phone", "555-123-4567", False)]
    assert kinds("part 555-123-4567 now") == []
    with_context, without = pii.find_spans("mail to a@b.de")[0][3], pii.find_spans("zzz a@b.de")[0][3]
    assert with_context > without


def test_operator_and_redaction(make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "x@y.zz and 10.0.0.1"), (3, "x@y.zz and 10.0.0.1"), (None, "é +49 (30) 1234567 é")])
    rows = pii.redact(pii.with_spans(docs)).collect()
    assert sorted(str(r["redacted"]) for r in rows) == sorted(["None", "", "<email> and <ip>", "<email> and <ip>", "é <phone> é"])
    assert pii.with_spans(docs.limit(0)).collect() == []


def test_query_equals_patterns(spark, base):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    got = QUERIES["op2_personal_data"](spark, base).collect()
    assert len(got) == len(docs)
    for r in got:
        want = plain(docs[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in want) for k in ("email", "ip", "card", "phone")]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(r["spans"].split(","))  or not want
