import hashlib
import random
import re

from pyspark.sql import functions as F

from goldleaf.llm import pii
from goldleaf.llm.queries import op7_bootstrap_pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
            "card": lambda: 13 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()


def base(text):
    return [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if valid(k, m[0])] for k, p in PLAIN.items()]


def expected(rows):
    out = []
    for d, t in rows:
        b = base(t)
        out.append((d, *map(len, b), hashlib.sha256(",".join(sum(b, [])).encode()).hexdigest()))
    return sorted(out, key=str)


def test_base_spans_match_the_plain_forms(spark):
    rng = random.Random(2)
    bits = ["a@b.c", "a@b.c_d@e.f", "x@y", "@", ".", "_", "%", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "001.002.3.0255", "4111111111111111",
            "4111 1111-1111 1111", "+1 (743) 555-3824", "+12", "+1--2", "é", "🙂", " ", "\n", "0" * 30, "5", "-", "+", "(", "a.b+c@d-e.f.g", "1@2.3.4.5.6", "00000000000000"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(30)))) for i in range(400)]
    rows += [(900, None), (901, ""), (None, "a@b.c"), (902, "7" * 30000), (903, "a." * 20000), (904, "1 " * 20000), rows[3]]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, at long")
    got = pii.personal_data(df).select("doc_id", F.explode(F.array_repeat(F.struct("base"), F.col("copies").cast("int"))).alias("x")).select(
        "doc_id", *[pii.count_of(F.col("x.base"), i).alias(k) for i, k in enumerate(PLAIN)], F.sha2(pii.shown(F.col("x.base")), 256).alias("h"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)
    assert pii.personal_data(df.limit(0)).count() == 0


def test_bootstrap_discovers_unseen_identifiers(spark):
    cards = [f"41111111111{n:04d}" for n in range(4000)]
    good = [c + str(next(x for x in range(10) if luhn(c + str(x)))) for c in cards[:12]]
    rows = [(i, f"some text then member number {c} was given") for i, c in enumerate(good)]
    rows += [(100 + i, f"other words and member number {x} was given") for i, x in enumerate(["AB-10293", "ZX99-8811", "77881234"])]
    rows += [(200 + i, f"in the year {2000000 + i} it rained") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.s for r in pii.personal_data(df).select("doc_id", pii.shown(F.col("spans")).alias("s")).collect()}
    for i, x in enumerate(["AB-10293", "ZX99-8811", "77881234"]):
        at = rows[12 + i][1].index(x)
        assert found[100 + i] == f"identifier:{at}:{at + len(x)}"
    assert all(found[200 + i] == "" for i in range(30))


def test_redaction_joins_overlaps(spark):
    df = spark.createDataFrame([("mail a@b.c1 or +1 555 123 4567 end", [(0, 5, 10), (4, 8, 11), (3, 15, 30)]), ("x", [])],
                               "text string, spans array<struct<kind:int,start:int,end:int>>")
    assert [r[0] for r in df.select(pii.redacted(F.col("text"), F.col("spans"))).collect()] == ["mail [PII] or [PII] end", "x"]


def test_query_base_columns(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    got = op7_bootstrap_pii(spark, path).collect()
    assert sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got), key=str) == expected(rows)
    by = {d: ",".join(sum(base(t), [])) for d, t in rows}
    assert all(r.spans.startswith(by[r.doc_id]) for r in got)
    assert sum("identifier" in r.spans for r in got) < 100


def test_one_text_of_many_matches(spark):
    text = " ".join(f"mail user{i}@example{i % 7}.org or id AB-{i:06d}" for i in range(20_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = pii.personal_data(df).select("base", "spans", pii.redacted(F.lit(text), F.col("base")).alias("r")).first()
    assert [(s.start, s.end) for s in got.base] == [m.span() for m in re.finditer(PLAIN["email"], text)]
    assert got.r == re.sub(PLAIN["email"], "[PII]", text)


def test_blocks_and_overlaps_against_plain_python(spark, monkeypatch):
    from goldleaf.llm import text as T

    monkeypatch.setattr(T, "BLOCK", 3)
    rng = random.Random(9)
    rows = []
    for _ in range(200):
        t = "".join(rng.choice("ab é🙂") for _ in range(rng.randrange(60)))
        spans = [tuple(sorted((rng.randrange(len(t) + 1), rng.randrange(len(t) + 1)))) for _ in range(rng.randrange(12))]
        rows.append((t, [(0, a, b) for a, b in spans if a < b]))
    df = spark.createDataFrame(rows, "text string, spans array<struct<kind:int,start:int,end:int>>")
    for r in df.select("text", "spans", pii.redacted(F.col("text"), F.col("spans")).alias("r"), pii._masked(F.col("text"), pii._disjoint(F.col("spans"))).alias("m")).collect():
        joined = []
        for _, a, b in sorted(map(tuple, r.spans)):
            if joined and a < joined[-1][1]:
                joined[-1][1] = max(b, joined[-1][1])
            else:
                joined.append([a, b])
        red, masked, at = "", "", 0
        for a, b in joined:
            red, masked, at = red + r.text[at:a] + "[PII]", masked + r.text[at:a] + pii.MARK * (b - a), b
        assert (r.r, r.m) == (red + r.text[at:], masked + r.text[at:])
