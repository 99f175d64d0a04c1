import hashlib
import re

import pytest
from pyspark.sql import functions as F

from mesonlab.llm import pii
from tests.llm.helpers import EDGE, SF, frame, saved

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else 0,
                  "card": 13 <= len(d) <= 19 and luhn(d or "0"), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


TRICKY = ["a@b.co_x@y.com z@q", "..a@b..c@d.e.f", "a@b@c.de", "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.255 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112",
          "4111111111111111 5 6", "+1 (482) 555-7951, +49 30 123456 ++1234567890 +1 2", "é漢\U0001F600 a.b@c.org \U0001F600 10.0.0.1", "tel +44-20-7946-0958-", "79927398713 0000000000000",
          "12 34-56 78 " * 50, "+1" + " " * 3000 + "2345678 9", "a" * 3000 + "@" + "b" * 3000 + ".c"]


def test_base_kinds_match_plain_patterns(spark, tmp_path):
    rows = [*EDGE, *[(100 + i, t) for i, t in enumerate(TRICKY)]]
    got = pii.op1_pii(spark, saved(spark, tmp_path, documents=frame(spark, rows))).collect()
    want = sorted((repr(i), hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in brute(t)).encode()).hexdigest(),
                   *[sum(x[0] == k for x in brute(t)) for k in BASE]) for i, t in rows)
    assert sorted((repr(r.doc_id), r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got) == want


def test_all_documents_match(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    got = {r.doc_id: r for r in pii.op1_pii(spark, SF).collect()}
    assert len(got) == len(docs)
    for i, t in zip(docs.doc_id, docs.text):
        spans = ",".join(f"{k}:{s}:{e}" for k, s, e in brute(t))
        assert got[i].base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert set(spans.split(",")) - {""} <= set(got[i].spans.split(","))


def test_added_kinds_need_checksum_or_context(spark):
    rows = [(1, "my IBAN is DE89 3704 0044 0532 0130 00 ok"), (2, "IBAN DE89 3704 0044 0532 0130 01"), (3, "ssn 219-09-9999"), (4, "code 219-09-9999"),
            (5, "call me: 555 123 4567 now"), (6, "part 555 123 4567"), (7, "GB82WEST12345698765432")]
    out = {r.doc_id: [x.kind for x in r.pii if not x.base] for r in pii.find_pii(frame(spark, rows)).collect()}
    assert out == {1: ["iban"], 2: [], 3: ["ssn"], 4: [], 5: ["local_phone"], 6: [], 7: ["iban"]}


def test_iban_before_capitals(spark):
    numbers = ["ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "NO93 8601 1117 947"]
    rows = [(i, f"IBAN {n} {tail}") for i, (n, tail) in enumerate((n, t) for n in numbers for t in ("BIC CAIXESBB", "EUR", "A", "2024", "BE68 5390 0754 7034", "ok."))]
    got = {r.doc_id: [r.text[x.start:x.end] for x in r.pii if x.kind == "iban"] for r in pii.find_pii(frame(spark, rows)).collect()}
    assert got == {i: [numbers[i // 6], *(["BE68 5390 0754 7034"] if i % 6 == 4 else [])] for i, _ in rows}


def test_keeps_rows_and_columns(spark):
    df = frame(spark, EDGE).withColumn("kind", F.lit(1)).withColumn("pii", F.lit("old")).withColumn("s", F.lit(2))
    out = pii.find_pii(df)
    assert out.columns == ["doc_id", "text", "kind", "s", "pii"] and out.count() == len(EDGE)
    assert pii.find_pii(df.limit(0)).count() == 0


def test_native(spark):
    plan = pii.op1_pii(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("digits,ok", [("4111111111111111", True), ("4111111111111112", False)])
def test_luhn(spark, digits, ok):
    assert spark.range(1).select(pii.luhn(F.lit(digits))).first()[0] is ok


def test_a_hundred_thousand_spans_in_one_text(spark):
    """A row's cost follows its text: ten times the spans take about ten times the time."""
    import time
    took = {}
    for n in (1_000, 10_000, 100_000):
        df = frame(spark, [(1, "a1@b.de 192.168.1.1 " * n)])
        start = time.time()
        got = pii.find_pii(df).selectExpr("size(pii) AS n", "pii[0] AS first", "pii[size(pii) - 1] AS last").first()
        took[n] = time.time() - start
        assert (got.n, got.first.kind, got.last.kind, got.last.start) == (2 * n, "email", "ip", 20 * n - 12)
    assert took[100_000] < 40 * took[10_000] + 20


def test_scores_stay_within_one(spark):
    got = pii.find_pii(frame(spark, [(1, "Contact mail: someone@example.org, IBAN bank account DE89 3704 0044 0532 0130 00.")])).first()
    assert [x.kind for x in got.pii] == ["email", "iban"] and all(0 < x.score <= 1 for x in got.pii)
