"""Exact and near copies against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from opsgrain.llm import exact_dedup, simhash
from opsgrain.llm.shared import components, forest, with_row_keys

DOCS = "doc_id bigint, text string, kept string, row string, rid int"


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "x", "y", 1) for i, t in enumerate(texts)], DOCS).repartition(3)


def test_exact_copies_match_brute_force(spark):
    random.seed(3)
    base = ["", " ", "a", "a" * 64, "a" * 65, "b" * 64 + "c", "é" * 40, "x" * 5000, "x" * 5000 + "y", "long " * 30000]
    texts = [random.choice(base) for _ in range(120)] + [None, None, "only one"]
    got = {r.doc_id: r for r in exact_dedup.mark_copies(docs_of(spark, texts), first_digit=4, wider=4).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        same = [j for j, u in enumerate(texts) if (u or "") == (t or "")]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(same), len(same), i == max(same))
        assert got[i].text_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    kept = {r.doc_id: r for r in exact_dedup.exact_dedup(docs_of(spark, texts)).collect()}
    assert set(kept) == {i for i in got if got[i].kept}
    assert all(r.text == texts[i] and (r.kept, r.row, r.rid) == ("x", "y", 1) for i, r in kept.items())


def test_exact_copies_repeated_and_null_ids(spark):
    rows = [(5, "same", "x", "y", 1)] * 3 + [(None, "same", "x", "y", 1), (None, "alone", "x", "y", 1)]
    got = exact_dedup.mark_copies(spark.createDataFrame(rows, DOCS)).collect()
    same = [r for r in got if r.group_size == 4]
    assert len(same) == 4 and {r.keep_id for r in same} == {5} and sum(r.kept for r in same) == 1
    assert [(r.doc_id, r.keep_id, r.kept) for r in got if r.group_size == 1] == [(None, None, True)]
    out = exact_dedup.exact_dedup(spark.createDataFrame(rows, DOCS))
    assert out.columns == ["doc_id", "text", "kept", "row", "rid"] and out.count() == 2


def test_rows_of_files_are_told_by_their_place(spark, tmp_path):
    """Repeated rows of several files: nothing is lost or doubled, and nothing is checkpointed."""
    rows = [(i % 4, f"text {i % 3}", "x", "y", 1) for i in range(60)]
    spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    keyed = with_row_keys(docs)
    assert keyed.select("rid").distinct().count() == 60 and "RDD" not in keyed._jdf.queryExecution().analyzed().toString()
    out = exact_dedup.exact_dedup(docs)
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(3, f"text {i}") for i in range(3)]
    assert with_row_keys(docs.union(docs)).select("rid").distinct().count() == 120
    doubled = docs.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    assert with_row_keys(doubled).select("rid").distinct().count() == 120


def brute_fingerprint(text, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    grams = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(ids, prints, most):
    label = dict(zip(ids, ids))
    changed = True
    while changed:
        changed = False
        for i, a in zip(ids, prints):
            for j, b in zip(ids, prints):
                if bin(a ^ b).count("1") <= most and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


@pytest.mark.parametrize("most", [3, 4])
def test_near_copies_match_brute_force(spark, most):
    rng = random.Random(5)
    words = ["Alpha", "beta", "gamma x", "délta", "EPS", "zeta", "eta", "theta"]
    texts = [None, "", " \n ", "one", "One", "one two", "ONE\ttwo", "É a b c d"]
    for _ in range(12):
        long = [rng.choice(words) + str(rng.randrange(90)) for _ in range(150)]
        for _ in range(6):
            own = list(long)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(150)] = "changed"
            texts.append(" ".join(own))
    got = {r.doc_id: r for r in simhash.mark_near_copies(docs_of(spark, texts, 7), max_bits=most).collect()}
    prints = [brute_fingerprint(t, 4) for t in texts]
    ids = [7 + i for i in range(len(texts))]
    assert [int(got[i].fingerprint, 16) for i in ids] == prints
    want = brute_components(ids, prints, most)
    assert len(set(want.values())) < len(ids) - 5
    assert {i: got[i].component_id for i in ids} == want
    assert all(got[i].kept == (want[i] == i) for i in ids)
    out = simhash.simhash_dedup(docs_of(spark, texts, 7), max_bits=most)
    assert sorted((r.doc_id, r.text or "", r.row, r.rid) for r in out.collect()) == sorted((i, texts[i - 7] or "", "y", 1) for i in set(want.values()))


def test_collide_equals_all_pairs(monkeypatch):
    """Cut variant space, hot prefixes and plain buckets give the components of all pairs."""
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    prints = []
    for c in centres:
        for _ in range(40):
            flips = rng.choice(64, rng.integers(0, 9), replace=False)
            prints.append(int(c) ^ int(sum(1 << int(f) for f in flips)))
    prints = np.unique(np.array(prints, dtype=np.uint64))
    monkeypatch.setattr(simhash, "HELD", 5000)
    for most in (2, 3, 4):
        radius = (most + 1) // 2
        us, vs = zip(*simhash._collide(prints, np.full(len(prints), radius), 64, radius, most))
        u, v = forest(np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64))
        near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= most
        a, b = np.nonzero(np.triu(near, 1))
        wu, wv = forest(prints[a].view(np.int64), prints[b].view(np.int64))
        assert dict(zip(u, v)) == dict(zip(wu, wv))


def test_prefixes_are_cut_until_all_are_small(spark, monkeypatch):
    rng = np.random.default_rng(2)
    # a dense group: the first 40 bits alike but for a few flips
    centre = int(rng.integers(0, 2**62)) >> 24 << 24
    prints = {centre ^ int(sum(1 << int(f) for f in rng.choice(24, rng.integers(0, 12), replace=False))) for _ in range(600)}
    prints |= {centre ^ int(sum(1 << int(f) for f in rng.choice(60, rng.integers(0, 7), replace=False))) for _ in range(300)}
    prints |= {int(x) for x in rng.integers(-(2**62), 2**62, 1500)}
    frame = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    monkeypatch.setattr(simhash, "HELD", 20_000)
    monkeypatch.setattr(simhash, "PREFIX_ROWS", 16)
    routes = simhash._routes(frame, 2).toPandas()
    assert len(routes["bits"].unique()) > 3 and len(routes) == len(routes.drop_duplicates())
    free = 64 - routes["bits"]
    routes["variants"] = np.select([routes["left"] == 0, routes["left"] == 1], [1, 1 + free], 1 + free + free * (free - 1) // 2)
    groups = routes.groupby(["prefix", "bits"]).agg({"variants": "sum", "fp": "size"})
    assert groups["variants"].max() <= 20_000 and groups["fp"].max() <= 3 * 16 * 37
    # every variant of every fingerprint has exactly one place
    assert (routes.groupby("fp")["variants"].sum() == 1 + 64 + 64 * 63 // 2).all()
    got = {r.node: r.root for r in components(simhash.links(frame, 4)).collect()}
    every = np.array(sorted(prints), dtype=np.int64).view(np.uint64)
    a, b = np.nonzero(np.triu(np.bitwise_count(every[:, None] ^ every[None, :]) <= 4, 1))
    u, v = forest(every[a].view(np.int64), every[b].view(np.int64))
    assert {n: r for n, r in got.items() if n != r} == dict(zip(u.tolist(), v.tolist()))


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert exact_dedup.mark_copies(none).count() == 0
    assert simhash.mark_near_copies(none).count() == 0
    assert simhash.simhash_dedup(none).columns == none.columns


def test_components_of_a_chain_and_a_hub(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[1000 + i] == 1000 for i in range(200))
    assert spark.range(1).select(F.lit(1)).count() == 1
