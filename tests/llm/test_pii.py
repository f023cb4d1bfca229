import hashlib
import re

import pytest

from riskloom.llm import pii as P
from tests.llm.conftest import invented

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


TEXTS = [
    "mail me.at+x@mail.example.com, a@b.c.d-e.fx_y@z.org or @a.b or x@y",
    "a@b.co_x@d.ef%%@g.h é@é.com ü.x@mail.de",
    "1.2.3.4.5.6.7.8 300.1.1.1 001.02.0255.9 1.2.3 9.9.9.9.9",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111--1111 0000000000000000 41111111111111111111111",
    "12 4111111111111111 5-4111111111111111 7 - 4111111111111111",
    "+1 (017) 555-7713 ++1234567890 +12 34 +1.2.3.4.5.6.7.8.9 +123456789012345678 +1 (((((((",
    "日本 naïve 👍 a@b.cd 👍 +49 30 1234567 (ok)",
    "My name is John Miller, phone 555 123-4567. Contact Dr. Alice Brown at 12 Long Hill Road.",
    "ssn 123-45-6789, mail john.doe [at] example [dot] com; version 123-45-6789 page 000-00-0000",
    "x" * 3000 + "@" + "y" * 3000 + ".com",
    "",
    None,
]


def shown(spans):
    return ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_base_spans_equal_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS + [t + " " + TEXTS[i % 9] for i, (_, t) in enumerate(invented(1, 50))])]
    got = {r.doc_id: r for r in P.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        spans = brute(t)
        assert got[i].base_sha256 == hashlib.sha256(shown(spans).encode()).hexdigest(), (t, shown(spans), got[i].spans)
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(k == j for _, k, _ in spans) for j in range(4)]
        assert set(filter(None, shown(spans).split(","))) <= set(got[i].spans.split(","))


def test_method_adds_spans(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = {r.doc_id: r.spans for r in P.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    kinds = {x.split(":")[0] for s in got.values() for x in s.split(",") if x}
    assert {"name", "address", "identity", "local", "veiled"} <= kinds
    name = next(x for x in got[7].split(",") if x.startswith("name"))
    a, b = map(int, name.split(":")[1:])
    assert TEXTS[7][a:b] == "John Miller"
    assert "identity" not in got[5] and all(":" in x for x in got[8].split(","))


def test_em_finds_the_reliable_labeler():
    # The first labeler is right 9 times in 10, the second 6 times in 10, the third always agrees with the first.
    counts = [((1, 1, 1), 54.0), ((1, -1, 1), 36.0), ((-1, -1, -1), 54.0), ((-1, 1, -1), 36.0)]
    prior, right, posterior = P.expectation_maximisation(counts)
    assert abs(prior - 0.5) < 0.1 and right[0] > 0.9 > right[1]
    assert posterior[(1, -1, 1)] > 0.5 > posterior[(-1, 1, -1)]


def test_redact_keeps_the_columns(spark):
    schema = "doc_id long, text string, spans string, base int, n_chars long"
    rows = [(1, "to a@b.cd or +49 30 1234567.", "s", 3, 9), (2, None, None, None, None), (3, "1.2.3.4@x.com", "s", 1, 1), (4, "clean é", "", 0, 0)]
    out = P.redact(spark.createDataFrame(rows, schema))
    assert out.columns == ["doc_id", "text", "spans", "base", "n_chars"]
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == "to [EMAIL] or [PHONE]." and got[2].text is None and got[3].text == "[IP][EMAIL]" and got[4].text == "clean é"
    assert got[1].spans == "s" and got[1].base == 3


def test_plan_is_native(spark):
    df = P.find(spark.createDataFrame([(1, TEXTS[7])], "doc_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("which", ["odd", "empty"])
def test_odd_rows(request, which):
    df = request.getfixturevalue(which)
    got = {r.doc_id: r for r in P.find(df).collect()}
    if which == "empty":
        assert got == {} and P.redact(df).collect() == []
        return
    rows = {r.doc_id: r.text for r in df.collect()}
    for i, t in rows.items():
        assert got[i].base_sha256 == hashlib.sha256(shown(brute(t)).encode()).hexdigest()
    assert P.find(df).count() == df.count()
