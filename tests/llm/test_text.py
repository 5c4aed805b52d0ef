"""Personal data against plain expressions."""

import hashlib
import re

from pyspark.sql import functions as F

from opsgrain.llm import pii
from opsgrain.llm.queries import QUERIES

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None, "", "nothing", "a@b", "a@b.c", "a@b.c_d@e.f", "a@b.c.d. x%y+z@q-1.r-.s..t", "@x.y a.@b.c@d.e", "é😀 x@y.zz 😀 w@v.uu", "a@b.c-d.e@f.g@h.i",
    "1.2.3.4 256.1.1.1 01.002.0003.255 1.2.3.4.5.6.7.8.9 1.2.3 999999999999.1.1.1", "12.34.56.78.90", "v1.2.3.4b",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 4111111111111111 12", "378282246310005 6011 0009 9013 9424", "0000 0000 0000 00", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "+1 (555) 010-9999", "+49 30 1234567 and +1 2", "++12 345 678 901 2", "+1555010999912345678", "+12.34.56.78.90 ) +1 (((((((", "call +44 20 7946 0958 +44 20 7946 0959",
    "GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765433", "DE89370400440532013000", "SSN 123-45-6789", "order 123-45-6789", "social security: 078-05-1120 now",
    "x" * 60_000 + "@" + "y" * 60_000 + ".z", "a." * 30_000 + "@b", "1" * 50_000, "9 " * 30_000, "+" * 20_000, "a@" * 20_000, "a@b." + "c." * 20_000 + "d", "1.2.3.4 " * 400,
    "+1" + "(" * 50_000,
]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def confirmed(kind, hit):
    d = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and luhn(d)
    return kind == "email" or 10 <= len(d) <= 15


def linear(kind, text):
    """Long runs would take the plain expression hours; they have known answers."""
    return not (kind == "email" and len(text) > 10_000 and text[:2] in ("a.", "xx"))


def base_spans(text):
    out = []
    for place, (kind, pattern) in enumerate(BASE.items()):
        if linear(kind, text):
            out += [(m.start(), place, kind, m.end()) for m in re.finditer(pattern, text, re.ASCII) if confirmed(kind, m[0])]
        elif text[0] == "x":
            out.append((0, place, kind, len(text)))
    return sorted(out)


def test_base_spans_match_plain_expressions(spark, tmp_path):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op8_personal_data"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(TEXTS):
        want = base_spans(t or "")
        r = got[i]
        joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in want)
        assert ",".join(s for s in r.spans.split(",") if s.split(":")[0] in BASE) == joined, (t or "")[:60]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        counts = [sum(k == kind for _, _, k, _ in want) for kind in BASE]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
    extra = {t: [s for s in got[i].spans.split(",") if s.startswith(("iban", "ssn"))] for i, t in enumerate(TEXTS)}
    assert extra["GB82 WEST 1234 5698 7654 32"] == ["iban:0:27"] and extra["DE89370400440532013000"] == ["iban:0:22"]
    assert extra["GB82WEST12345698765433"] == [] and extra["order 123-45-6789"] == []
    assert extra["SSN 123-45-6789"] == ["ssn:4:15"] and extra["social security: 078-05-1120 now"] == ["ssn:17:28"]


def test_context_moves_the_score(spark):
    texts = ["card 4111111111111111", "serial 4111111111111111", "4111111111111111"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.spans[0].score for r in pii.find_personal_data(docs).collect()}
    assert got[0] == 1.0 and got[1] == 0.4 and got[2] == 0.7


def iban(country, rest):
    """With its check digits."""
    number = "".join(str(int(c, 36)) for c in f"{rest}{country}00")
    return f"{country}{98 - int(number) % 97:02d}{rest}"


def test_iban_ends_where_its_country_says(spark):
    numbers = ["ES9121000418450200051332", "BE68539007547034", "AT611904300234573201", "PL61109010140000071219812874", "SE4550000000058398257466", "NO9386011117947"]
    numbers += [iban("MT", "MALT011000012345MTLCAST001S"), iban("CH", "00762011623852957")]
    grouped = [" ".join(re.findall(".{1,4}", n)) for n in numbers]
    behind = ["", " Please", " BIC CAIXESBB", " 100 EUR", " FROM", " 12", " 2024", ", thanks", " please", " ES91 2100 0418 4502 0005 1332"]
    texts = [(n, b) for n in numbers + grouped for b in behind]
    texts += [("ES9121000418450200051333", " Please"), ("ES912100041845020005133", ""), ("ES91210004184502000513321", "")]
    docs = spark.createDataFrame([(i, f"IBAN {n}{b}") for i, (n, b) in enumerate(texts)], "doc_id int, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "iban"] for r in pii.find_personal_data(docs).collect()}
    for i, (n, b) in enumerate(texts):
        want = [] if i >= len(texts) - 3 else [(5, 5 + len(n))] + [(6 + len(n), 5 + len(n) + len(b))] * b.startswith(" ES91")
        assert got[i] == want, texts[i]


def test_context_reaches_over_other_matches(spark):
    texts = ["SSN 123-45-6789, 234-56-7890", "é😀 123-45-6789 234-56-7890 is an SSN", "SSN 123-45-6789" + " " * 25 + ".234-56-7890", "SSN 123-45-6789" + " " * 24 + ".234-56-7890"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "ssn"] for r in pii.find_personal_data(docs).collect()}
    assert got == {0: [(4, 15), (17, 28)], 1: [(3, 14), (15, 26)], 2: [(4, 15)], 3: [(4, 15), (40, 51)]}


def test_many_matches_in_one_text_take_time_in_proportion(spark):
    import time

    one = "mail user{0}@host{0}.org now 10.{1}.7.{2} card 4111 1111 1111 1111, SSN 123-45-6789; call +1 555 010 {0:05d} or é {0}.50 EUR 😀 "

    def run(n):
        text = "".join(one.format(i, i % 250, i % 300) for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
        t = time.time()
        spans = pii.find_personal_data(docs).first()["spans"]
        return time.time() - t, text, spans

    run(50)
    half, _, _ = run(5000)
    whole, text, spans = run(20_000)
    got = [(s.start, s.place, s.kind, s.end) for s in spans if s.kind in BASE]
    assert got == base_spans(text) and len(got) > 60_000
    assert [(s.start, s.end) for s in spans if s.kind == "ssn"] == [(m.start(), m.end()) for m in re.finditer("123-45-6789", text)]
    assert {round(s.score, 1) for s in spans if s.kind == "email"} == {0.9}
    assert whole < 60 and whole < 8 * half + 5, (half, whole)


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a@b.c")], "doc_id int, text string")
    plan = pii.find_personal_data(docs).select(F.size("spans"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan
    assert pii.find_personal_data(docs.limit(0)).count() == 0
