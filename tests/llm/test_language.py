"""The byte network: gradients, windows, held-out accuracy."""

import zlib

import numpy as np
import pytest

from opsgrain.llm import gru, language_id

SF = "/root/testdata/sf0.01"


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = gru._start(["a", "b", "c"], rng)
    codes = rng.integers(97, 103, (7, 5)).astype(np.int16)
    codes[5:, 2] = gru.PAD
    target = rng.integers(0, 3, 5)
    _, grads = gru.gradients(net, codes, target)
    for p, g in zip(net.parameters(), grads):
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in p.shape)
            if p.shape[-1] == gru.PAD + 1:
                at = (at[0], int(rng.integers(97, 103)))
            keep, eps = p[at], np.float32(1e-2)
            p[at] = keep + eps
            high, _ = gru.gradients(net, codes, target)
            p[at] = keep - eps
            low, _ = gru.gradients(net, codes, target)
            p[at] = keep
            assert g[at] == pytest.approx((high - low) / (2 * float(eps)), rel=0.05, abs=2e-4)


def test_pooling_is_the_mean_of_all_positions():
    net = gru._start(["a", "b"], np.random.default_rng(1))
    texts = [b"", b"x", b"y" * gru.WINDOW, b"long " * 999]
    got = net.pooled(texts)
    assert (got[0] == 0).all() and got[1:].sum(axis=1) == pytest.approx([1, 1, 1], abs=1e-4)
    for t, row in zip(texts[1:], got[1:]):
        codes, _ = gru.windows([t])
        want = net.positions(np.ascontiguousarray(codes.T)).transpose(2, 0, 1).reshape(-1, 2)[: len(t)]
        assert row == pytest.approx(want.mean(axis=0), abs=1e-4)
        assert len(net.label_positions(t)) == len(t)
    assert net.label_positions(b"") == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in language_id.identify(docs, with_rows=False).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert set(got) == set(truth)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    out = [i for i in got if got[i].held_out and truth[i] is not None]
    assert len(out) > 200 and sum(got[i].lang_pred == truth[i] for i in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_and_ids_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    changed = docs.selectExpr("doc_id", "text", "case when crc32(cast(doc_id as string)) % 3 = 1 then 'zz' else lang end as lang", "'s' as source")
    first = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs).collect()}
    assert {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(changed).collect()} == first


def test_odd_rows(spark):
    rows = [(1, None, "en", "x"), (2, "", "en", "x"), (3, "12 !? \n", "de", "x"), (None, "Text with a letter", None, "x"), (5, "und " * 30_000, "de", "x"), (5, "und " * 30_000, "de", "x")]
    rows += [(i, f"the words of it {i}", "en", "x") for i in range(10, 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [(by[i].lang_pred, by[i].score) for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert by[None].lang_pred in ("de", "en") and by[None].held_out is False
    kept = language_id.known_language(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    assert language_id.identify(docs.limit(0)).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_without_labels_documents_with_a_letter_stay(spark):
    rows = [(1, None, None, "x"), (2, "", None, "x"), (3, "12 !? \n", None, "x"), (None, "Text", None, "x"), (5, "日本", None, "x"), (5, "日本", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    kept = language_id.known_language(docs)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if r.text in ("Text", "日本"))
    out = [i for i in range(1, 50) if zlib.crc32(str(i).encode()) % 3 == 1]  # labels in the held-out third only
    docs = spark.createDataFrame([(i, "a text", "en") for i in out], "doc_id bigint, text string, lang string")
    assert language_id.known_language(docs).count() == len(out)


def test_sample_is_the_smallest_hashes_and_moves_little(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('text number ', id) as text", "if(id % 10 = 0, 'rare', 'common') as lang")
    got = language_id.sample(docs, docs_most=40, windows=1)
    labelled = docs.filter(~language_id.held_out()).selectExpr("lang", "text", "xxhash64(doc_id, text) as h").collect()
    for kind in ("rare", "common"):
        want = [r.text.encode() for r in sorted(labelled, key=lambda r: r.h) if r.lang == kind][:20]
        assert [t for t, x in got if x == kind] == want
