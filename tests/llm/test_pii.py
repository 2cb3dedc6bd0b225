"""Personal data: strict spans against the plain patterns, added spans on planted cases."""
import hashlib
import random
import re

import pytest

from tidewater.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def strict(text):
    out = []
    for kind, p in PLAIN.items():
        for m in re.finditer(p, text or "", re.ASCII):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(x) > 255 for x in m.group().split(".")) or kind == "phone" and not 8 <= len(d) <= 15
                    or kind == "card" and not (16 <= len(d) <= 19 and luhn(d))):
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


ODD = [None, "", "a@b", "a@b.c", "x..y@-.-", "a@b.c_d@e.f@g.h", "é.a+b%c@é.de a.b@c..d", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255",
       "1.2.3 .1.2.3.4. 00000000000000000000000000255.1.1.1 99999999999999999999999.1.1.1", "4111 1111 1111 1111", "4111-1111 1111-1111-",
       "4111  1111 1111 1111", "+1 (678) 555-5272 4111111111111111", "+1 2", "++12345678+12345678", "+1(((((9 8.7-6 5 4)3 2", "+12345678901234567",
       "a@b.cc 1.1.1.1", "😀 a@b.cc 😀1.2.3.4", "a" * 3000 + "@b.c" + ".d" * 9000, "1 " * 20000, "1." * 20000, "9" * 30000,
       "token = \"2abc3ff2ca8fb1e4c565a0eb63815530a948bdde\" x", "a@" * 5000, "+1" * 5000, "$0 \\1 $1 a@b.cc"]


def fuzz(n):
    r = random.Random(4)
    parts = ["a", "B", "9", "12", "255", "256", ".", ".", "@", "-", "+", " ", "(", ")", "_", "%", "é", "4111111111111111", "\n"]
    return ["".join(r.choice(parts) for _ in range(r.randint(1, 60))) for _ in range(n)]


def test_strict_spans(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows = docs + list(enumerate(ODD + fuzz(1500), 10_000)) + [(None, "a@b.cc"), (10_001, "x")]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id bigint, text string, spans string, start int")
    got = {}
    for r in pii.find_spans(df).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        want = strict(t)
        r = got[i].pop(0)
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (t, r.spans, want)
        counts = [sum(w.startswith(k + ":") for w in want) for k in pii.STRICT]
        assert counts == [r.n_email, r.n_ip, r.n_card, r.n_phone]
        assert (r.spans + ",").startswith(",".join(want) + ("," if want else ""))


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_added_spans(spark, model):
    hex40 = "9742a250774262d69ad6a86100194ed53da5a0ef"
    rows = [(1, f'x token = "{hex40}" y'), (2, "plain words only, version 2.0 of 2024."), (3, f"seen {hex40}" + '" there')]
    got = {r.doc_id: r.spans for r in pii.find_spans(spark.createDataFrame(rows, "doc_id bigint, text string"), model=model).collect()}
    assert got[1] == "secret:11:51" and got[2] == "" and got[3] == "secret:5:45"


def test_few_clean_documents_are_touched(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pii.find_spans(docs, model=model).collect()
    added = [s for r in rows for s in r.spans.split(",") if s and s.split(":")[0] in pii.PROPOSED]
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert added
    for r in rows:
        for s in r.spans.split(","):
            kind, a, b = (s.split(":") + ["0", "0"])[:3]
            if kind == "secret":
                assert re.fullmatch(r"[A-Za-z0-9+/_=-]{16,}", texts[r.doc_id][int(a):int(b)])


def test_redact(spark, model):
    rows = [(1, "mail a.b@c.de now +1 (678) 555-5272 é 1.2.3.4", 9, "x"), (2, None, 5, None), (3, "none", 4, ""), (4, "", 0, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, stop string")
    out = pii.redact(df, model=model)
    assert out.schema == df.schema
    assert sorted(map(tuple, out.collect()))[0] == (1, "mail [EMAIL] now [PHONE] é [IP]", 31, "x")
    assert sorted(map(tuple, out.collect()))[1:] == rows[1:]


def test_trees_learn_and_empty_inputs(spark):
    cells = [((0, d, l, h, 1, 0, 0, 0, 0), 50, 50 if d > 2 and h else 2) for d in range(6) for l in range(4) for h in (0, 1)]
    model = pii.fit_trees(cells)
    assert all((model.score(c[0]) >= model.threshold) == (c[2] == 50) for c in cells)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert pii.find_spans(empty).count() == 0 and pii.redact(empty).count() == 0


def test_native(spark, model):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for out in (pii.find_spans(df, model=model), pii.redact(df, model=model)):
        plan = out._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas|Exchange", plan)
