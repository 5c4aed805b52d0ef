"""License scans against expressions over the whole text, and the cases of the contract."""

from __future__ import annotations

import random
import re

import pytest
from opsgrain.llm import licenses
from opsgrain.llm.queries import ORACLE, QUERIES, _wording

SCHEMA = "doc_id bigint, text string, note string"


def plain(text: str | None, templates=licenses.TEMPLATES) -> set[tuple[int, int, int]]:
    """Places by one expression per template, tried at every word."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    out = set()
    for i in range(len(words)):
        rest = "".join(f" {w} " for w in words[i : i + 400])
        for t, template in enumerate(templates):
            # of the ways to match the longest one: every end is tried
            ends = [m for m in range(len(words[i : i + 400]), 0, -1)] if re.match(wordings(template), rest) else []
            for m in ends:
                if re.fullmatch(wordings(template), "".join(f" {w} " for w in words[i : i + m])):
                    out.add((t, i, i + m))
                    break
    return out


def wordings(template: licenses.Template) -> str:
    return _wording(licenses.parse(template.markup))


def place_sets(found) -> dict:
    return {r["doc_id"]: {(p["template"], p["first"], p["behind"]) for p in r["places"]} for r in found.collect()}


def sample_of(items: list, rng: random.Random) -> list[str]:
    out: list[str] = []
    for x in items:
        if isinstance(x, bytes):
            out.append(x.decode())
        elif x[0] == "words":
            out += [rng.choice(["acme", "the", "holders", "ünïcode", "7"]) for _ in range(rng.randint(x[1], x[2]))]
        else:
            out += sample_of(rng.choice(x[1]), rng)
    return out


def test_every_template_accepts_its_wordings_and_no_changed_one():
    rng = random.Random(1)
    automaton = licenses.build(licenses.TEMPLATES)
    for t, template in enumerate(licenses.TEMPLATES):
        items = licenses.parse(template.markup)
        for _ in range(4):
            words = sample_of(items, rng)
            text = ", ".join(["preface", *words, "epilogue"]).encode()
            n, found = licenses.scan(text, automaton)
            assert n == len(words) + 2
            assert any(f[0] == t and f[1] == 1 for f in found), template.label
        # without one of the mandatory words, or with one more between them, the terms are others
        fixed = [i for i, x in enumerate(items) if isinstance(x, bytes)]
        if not fixed:
            continue
        drop = fixed[len(fixed) // 2]
        missing = sample_of(items[:drop] + items[drop + 1 :], rng)
        more = sample_of(items[:drop] + [b"otherwise"] + items[drop:], rng)
        for words in (missing, more) if drop and isinstance(items[drop - 1], bytes) else (missing,):
            _, found = licenses.scan(" ".join(words).encode(), automaton)
            assert not any(f[0] == t and f[1] == 0 and f[2] == len(words) for f in found), (template.label, words)


def test_places_equal_plain_expressions():
    rng = random.Random(7)
    templates = (
        licenses.Template("a", "one <<beginOptional>>two <<beginOptional>>three<<endOptional>><<endOptional>> four", 0.5),
        licenses.Template("b", "one <<var;words=0-2>> four", 0.5, base=True),
        licenses.Template("c", "<<var;match=two|three four>> one <<var;match=five|>>", 0.5),
        licenses.Template("d", "four one", 0.5),
    )
    automaton = licenses.build(templates)
    for _ in range(300):
        text = " ".join(rng.choice(["one", "two", "three", "four", "five"]) for _ in range(rng.randint(0, 30)))
        _, found = licenses.scan(text.encode(), automaton)
        assert set(found) == plain(text, templates), text


def test_pieces_change_nothing():
    rng = random.Random(3)
    automaton = licenses.build(licenses.TEMPLATES)
    notice = licenses.TEMPLATES[3].markup.replace("<<var;words=1-6>>", "software").replace("<<var;words=1-12>>", "the authors")
    notice = notice.replace("<<beginOptional>>(including the next paragraph)<<endOptional>>", "")
    parts = [rng.choice(["word", "Ω", "under the MIT License.", "under the mit under the mit license", notice]) for _ in range(300)]
    text = " ".join(parts).encode()
    whole = licenses.scan(text, automaton)
    assert any(f[0] == 3 for f in whole[1])
    for piece in (1, 17, 100, 5000):
        n, found = licenses.scan(text, automaton, piece)
        assert (n, sorted(found)) == (whole[0], sorted(whole[1])), piece


def test_marks_that_make_no_sense():
    for markup in ("a <<beginOptional>> b", "a <<endOptional>>", "a <<var;words=3-1>>", "a <<other>>", "a <<var;match=>>"):
        with pytest.raises(ValueError):
            licenses.parse(markup)
    for markup in ("", "<<beginOptional>>a<<endOptional>>", "<<var;words=1-2>> a"):
        with pytest.raises(ValueError):
            licenses.build([licenses.Template("x", markup, 1.0)])


def test_cases(spark, tmp_path):
    long = "lorem ipsum " * 200_000 + "Released UNDER the MIT-License."
    rows = [
        (1, "Under the MIT license, under the mit license", "x"),
        (2, None, None),
        (3, "", "y"),
        (4, "...!?", "y"),
        (5, long, "z"),
        (5, long, "z"),
        (None, "Licensed under CC BY-NC 4.0. Apache License, Version 2.0", "n"),
        (7, "This work is licensed under the GNU General Public License, version 3.", "g"),
        (8, "licensed under CC BY 4.0; the licence of under the mit", "g"),
        (9, "underthe mit license under théé the mit license", "g"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("note", "labels")
    out = sorted((tuple(r) for r in licenses.summary(licenses.find_licenses(docs)).collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert out == [
        (1, 8, 2, 0, 4, "mit", "mit", 0.5),
        (2, 0, 0, None, None, "", "", 0.0),
        (3, 0, 0, None, None, "", "", 0.0),
        (4, 0, 0, None, None, "", "", 0.0),
        (5, 400_005, 1, 400_001, 400_001, "mit", "mit", 0.5),
        (5, 400_005, 1, 400_001, 400_001, "mit", "mit", 0.5),
        (7, 12, 0, None, None, "", "gpl-3", 0.8),
        (8, 12, 0, None, None, "", "cc-by", 0.8),
        (9, 8, 0, None, None, "", "", 0.0),
        (None, 12, 2, 2, 7, "apache-2,cc-by-nc", "apache-2,cc-by-nc", 0.5),
    ]
    assert licenses.find_licenses(docs.limit(0)).count() == 0


def test_query_equals_sql(spark, tmp_path):
    import check

    texts = ["x under the mit license " * 3, None, "", "GNU", " ".join(sample_of(licenses.parse(licenses.TEMPLATES[5].markup), random.Random(2)))]
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert check.compare(QUERIES["op11_license_scan"](spark, str(tmp_path)), con, ORACLE["op11_license_scan"]) is None
