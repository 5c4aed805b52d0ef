"""Packing and mixing against brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from opsgrain.llm import mixing, packing
from opsgrain.llm.queries import QUERIES

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
SF = "/root/testdata/sf0.01"


def slow_best_fit(lengths, size, bins):
    """(bin, offset) with plain lists."""
    free, made, out = {}, 0, []
    for n in lengths:
        fitting = [b for b in free if free[b] >= n]
        least = min((free[b] for b in fitting), default=None)
        if least is not None:
            b = max(b for b in fitting if free[b] == least and b == [x for x in free if free[x] == least][-1])
        else:
            if len(free) >= bins:
                full = min(free.values())
                del free[[x for x in free if free[x] == full][-1]]
            b, made = made, made + 1
            free[b] = size
        left = free.pop(b)
        out.append((b, size - left))
        if left > n:
            free[b] = left - n  # put last: bins of the same space are taken last in, first out
    return out


def test_best_fit_matches_plain_lists():
    rng = random.Random(8)
    lengths = [rng.choice([rng.randint(1, 100), rng.randint(1, 30)]) for _ in range(3000)]
    packer = packing.BestFit(100, 7)
    assert [packer.place(n) for n in lengths] == slow_best_fit(lengths, 100, 7)


def test_cut():
    assert packing.cut(5, 8) == [(0, 5)] and packing.cut(8, 8) == [(0, 8)] and packing.cut(16, 8) == [(0, 8), (8, 8)]
    assert packing.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def test_both_libraries_give_the_same_ids(spark):
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    encode = packing.encoder(PATH, PATTERN)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["", " ", "\n\n  x", "a" * 5000, "é😀 <|endoftext|> it's 12,3", " " * 5000 + "x", "<|endoftext|>"]
    for t in texts:
        assert encode.ids(t).tolist() == own.encode(t, add_special_tokens=False).ids


def test_added_tokens_have_the_ids_of_an_untouched_tokenizer(spark):
    own = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y", "<|endoftext", "it's <|endoftext|>" + "a" * 5000, "é 😀 plain", " " * 5000 + "x"]
    want = {i: [*own.encode(t, add_special_tokens=False).ids, packing.END] for i, t in enumerate(texts)}
    assert any(50256 in ids for ids in want.values())
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1), PATH, PATTERN, size=100_000).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got} == want


def test_packing_is_whole(spark, tmp_path):
    rng = random.Random(1)
    texts = [None, "", "x"] + [" ".join(rng.choice(["tree", "é", "Haus9"]) for _ in range(rng.choice([3, 200, 4000]))) for _ in range(150)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "null id", 1), (2, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length int")
    own = Tokenizer.from_file(PATH)
    want = {i: [*own.encode(t or "", add_special_tokens=False).ids, 0] for i, t, _ in rows if i is not None}
    got = packing.pack(docs.coalesce(1), PATH, PATTERN).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == {i for i, _, _ in rows} and len(by[2]) == 2
    for i, ids in want.items():
        parts = sorted(by[i], key=lambda r: r.piece)[: 1 if i == 2 else None]
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in parts]).tolist() == ids
        assert [(r.start, r.length) for r in parts] == packing.cut(len(ids))
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        ends = [a + n for a, n in sorted(parts)]
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= packing.SEQUENCE
    assert len(seqs) <= 1.02 * sum(r.length for r in got) / packing.SEQUENCE + 1
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for r in QUERIES["op6_best_fit_packing"](spark, str(tmp_path)).filter("doc_id > 2").collect():
        assert r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id][r.start : r.start + r.length], dtype="<u4").tobytes())
    assert packing.pack(docs.limit(0), PATH, PATTERN).count() == 0


def brute_targets(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in out]
        if not free:
            return out
        level = left / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > most * sizes[s]]
        if not over:
            return out | {s: level * w[s] for s in free}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 50, None: 10}, {"z": 1, "é": 900, "a": 30, "B": 40}, {"a": 0, "b": 7}, {"only": 9}])
def test_targets_match_water_filling(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    assert got == pytest.approx(brute_targets(sizes, (3, 1, 2), 1.5, 2.0))


def test_flight_keeps_totals():
    rng = random.Random(2)
    sizes = [rng.choice([0, 1, rng.randint(1, 3000)]) for _ in range(500)]
    for p in (0.0, 0.31, 1.0):
        now = mixing.flight([p] * 500, sizes, random.Random(3))
        assert sum(0 < x < 1 for x in now) <= 2
        assert sum(now) == pytest.approx(p * 500) and sum(x * s for x, s in zip(now, sizes)) == pytest.approx(p * sum(sizes))
    taken = [sum(mixing.flight([0.3] * 9, sizes[:9], random.Random(s))) for s in range(50)]
    assert taken == pytest.approx([2.7] * 50)
    picks = np.mean([mixing.flight([0.3] * 60, sizes[:60], random.Random(s)) for s in range(3000)], axis=0)
    assert abs(picks - 0.3).max() < 0.06


def test_mix_meets_its_targets(spark):
    rng = random.Random(6)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 300))), rng.choice("aaaaabbcde"), "clash") for i in range(3000)]
    rows += [(None, "\x0bnull  id\u00a0one ", None, "clash"), (5000, None, None, "clash"), (5001, "", "empty", ""), (7, "repeated row", "a", ""), (7, "repeated row", "a", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, target string").repartition(4)
    got = mixing.mix(docs, shard_rows=200).collect()
    assert len(got) == len(rows)
    size = lambda t: sum(1 for w in (t or "").replace("\u00a0", "_").split())
    assert sorted(r.size for r in got) == sorted(size(t) for _, t, _, _ in rows)
    sums, taken = {}, {}
    for r in got:
        s = r.source
        sums[s] = sums.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    want = brute_targets(sums, (3, 1, 2), 1.5, 2.0)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sums[r.source]
    for s in sums:
        assert abs(taken[s] - want[s]) <= 300
        assert s is None or s == "empty" or abs(taken[s] - want[s]) <= 0.005 * want[s] + 150
    again = {(r.doc_id, r.size, r.copies) for r in mixing.mix(docs, shard_rows=200).collect()}
    assert again == {(r.doc_id, r.size, r.copies) for r in got}
    # shards so small that what they leave goes through them again, several times
    few = mixing.mix(docs, shard_rows=6).collect()
    for s in sums:
        assert abs(sum(r.taken for r in few if r.source == s) - want[s]) <= 300
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.agg(F.max("target")).first()[0] == "clash"
    assert mixing.mix(docs.limit(0)).count() == 0
