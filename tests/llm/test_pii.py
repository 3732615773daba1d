"""Personal data: patterns against plain regular expressions, and telling terms."""

import random
import re
from hashlib import sha256

from corpus_helpers import DATA

from commerce_lake.llm import pii, queries

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain(text):
    out = []
    for kind, (name, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if name == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[name]
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_random_texts():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.2@+- 5(4)b%7") for _ in range(rng.randrange(40)))
        assert [m[:3] for m in pii.find_base(text)] == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1(" * 100_000, "a@" * 150_000, "a.b@c-" * 50_000):
        pii.find_base(text)


def test_numbers_of_any_length():
    """Runs of thousands of digits in every part of an address are judged without reading them as one number."""
    for run, good in (("0" * 5000, True), ("0" * 5000 + "255", True), ("0" * 5000 + "256", False), ("7" * 5000, False)):
        for part in range(4):
            text = ".".join(run if k == part else "9" for k in range(4))
            found = [(m[0], m[2]) for m in pii.find_base(f"x {text} y") if m[1] == 1]
            assert found == ([(2, 2 + len(text))] if good else []), (run[:3], part)


def test_terms_that_reveal_an_entity(spark):
    rows = [(k, f"note {k} says zorblax wrote from jane@corp.example about the plan number{k}x") for k in range(6)]
    rows += [(100 + k, f"the plan says nothing from about note wrote again {k}") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(df).collect()}
    place = rows[2][1].index("zorblax")
    assert f"term:{place}:{place + 7}" in got[2].spans.split(",")
    assert "email" in got[2].spans and got[130].spans == "" and got[130].n_term == 0
    assert len(got[2].spans.split(",")) == 2  # common words tell little
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert "zorblax" not in clean[2] and "jane" not in clean[2] and "<EMAIL>" in clean[2] and clean[130] == rows[36][1]


def test_terms_of_rare_entities_far_away_and_with_digits(spark):
    far = " ".join(["the plan says nothing of note"] * 3)
    rows = [(k, f"acct77 owner {far} mail p{k}@rare.example") for k in range(4)]  # each address in one text
    rows += [(10 + k, f"zorblax {far} card 4111 1111 1111 1111 {'x' * (k + 1)}") for k in range(2)]  # an entity in two texts
    rows += [(100 + k, f"owner mail card {far} {k}") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(df).collect()}
    assert all("term:0:6" in got[k].spans.split(",") and got[k].n_term == 1 for k in range(4))
    assert all("term:0:7" in got[10 + k].spans.split(",") and got[10 + k].n_term == 1 for k in range(2))
    assert all(got[100 + k].n_term == 0 for k in range(60))


def test_copies_alone_are_no_evidence(spark):
    df = spark.createDataFrame([(k, "alone unusual word near jane@corp.example") for k in range(9)], "doc_id long, text string")
    assert {r.n_term for r in pii.personal_data(df).collect()} == {0}


def test_edge_cases(docs, no_docs):
    rows = pii.personal_data(docs).collect()
    assert len(rows) == docs.count() and sum(r.n_email for r in rows) == 1
    assert pii.personal_data(no_docs).count() == 0
    out = pii.sanitise(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("text LIKE '%<EMAIL>%'").count() == 1 and out.where("text IS NULL").count() == 2


def test_query(spark):
    got = {r.doc_id: r for r in queries.op5_pii(spark, str(DATA)).collect()}
    kinds = list(PATTERNS)
    for row in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        want, r = plain(row.text or ""), got[row.doc_id]
        text = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        assert r.base_sha256 == sha256(text.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("term")] == [s for s in text.split(",") if s]
