from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from footfall.llm import pii
from footfall.llm.queries import op1_pii
from tests.llm.frames import awkward, documents, noise

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def base(row):
    return [(s.start, s.rank, s.stop, s.kind) for s in row.spans if s.kind in pii.BASE]


def test_base_spans_equal_plain_matching(spark, sf_dir):
    extra = noise("ab.@-+ 0123456789()%_éß😀", 3000, 60)
    extra += ["4111 1111 1111 1111", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "0001.2.3.255 1.2.3.256"]
    made = spark.createDataFrame(list(enumerate(extra)), "doc_id long, text string").repartition(4)
    every = made.unionByName(documents(spark, sf_dir).select("doc_id", "text"))
    for row in pii.find(every).collect():
        assert base(row) == brute(row.text), row.text[:100]


def test_ips_with_a_part_that_is_zero(spark):
    cases = ["10.0.0.1", "at 127.0.0.1, 192.168.0.1", "0.0.0.0", "000.00.0.000", "0.0.0.256"]
    cases += ["1.2.3.0", "0" * 4000 + ".0.0.1", "1.0.0." + "0" * 4000 + "9", "00256.0.0.0", "0.1.2"]
    frame = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    for row in pii.find(frame).collect():
        assert base(row) == brute(row.text), row.text[:100]
    assert [s.kind for s in pii.find(frame).where("doc_id = 0").first().spans] == ["ip"]


def test_awkward_rows(spark):
    rows = pii.find(awkward(spark)).collect()
    assert len(rows) == 11
    for row in rows:
        assert base(row) == brute(row.text)
    assert pii.find(awkward(spark, [])).count() == 0


def test_added_kinds_need_checksum_and_context(spark):
    cases = {
        "GB82 WEST 1234 5698 7654 32": ["iban"],
        "GB83 WEST 1234 5698 7654 32": [],
        "ssn 123-45-6789": ["ssn"],
        "code 123-45-6789": [],
        "ssn 000-45-6789": [],
        "call 555-123-4567": ["local_phone"],
        "sample GB82 WEST 1234 5698 7654 32": [],
    }
    frame = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    found = {r.text: [s.kind for s in r.spans] for r in pii.find(frame).collect()}
    assert found == cases


def test_redact(spark):
    frame = awkward(spark, [(1, "x a@b.com, +1 (499) 555-6503 é"), (2, None), (3, "")])
    rows = pii.redact(frame).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["x <email>, <phone> é", None, ""]
    assert rows[0].asDict().keys() == frame.first().asDict().keys()


def test_redact_leaves_columns_of_other_meaning_alone(spark):
    schema = "doc_id long, text string, spans string, rank int, context string"
    frame = spark.createDataFrame([(1, "write to a@b.com", "mine", 7, "own")], schema)
    row = pii.redact(frame).first()
    assert tuple(row) == (1, "write to <email>", "mine", 7, "own")


def test_scores_name_the_word_that_raised_them(spark):
    cases = {
        "write to a@b.com": "email:9:1.0:write to",
        "see a@b.com": "email:4:0.9:",
        "exemple a@b.com": "email:8:0.6:",
        "Kontakt: a@b.com": "email:9:1.0:kontakt",
        "Konto DE89 3704 0044 0532 0130 00": "iban:6:1.0:konto",
        "tarjeta 4111 1111 1111 1111": "card:8:1.0:tarjeta",
        "": "",
    }
    frame = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    found = pii.find(frame).select("text", pii.scored(F.col("spans")).alias("scores"))
    assert {r.text: r.scores for r in found.collect()} == cases


def test_account_numbers_have_the_length_of_their_country(spark):
    def checked(body, country):
        spelled = "".join(str(int(c, 36)) for c in body + country + "00")
        return f"{country}{98 - int(spelled) % 97:02d}{body}"

    cases = {
        checked("370400440532013000", "DE"): 1,
        checked("3704004405320130001", "DE"): 0,
        checked("NWBK60161331926819", "GB"): 1,
        checked("NWBK6016133192681", "GB"): 0,
        checked("123456789012345", "ZZ"): 1,
    }
    frame = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    for row in pii.find(frame).collect():
        assert sum(s.kind == "iban" for s in row.spans) == cases[row.text], row.text


def test_query(spark, sf_dir):
    rows = op1_pii(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in documents(spark, sf_dir).collect()}
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.n_email == sum(k == "email" for *_, k in spans)
    plan = op1_pii(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
