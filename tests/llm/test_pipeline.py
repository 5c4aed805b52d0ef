"""Each stage of the pipeline against brute force on its own input."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from test_corpus import brute_targets
from test_dedup import brute_components, brute_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from opsgrain.llm import packing
from opsgrain.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The input and the output of every stage, written and read again."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9001, None, "en", "src1", 0), (9002, "", "en", None, 0), (9003, "12 34 !", "en", "src0", 7), (9004, "twice the same text", "en", "src2", 1), (9005, "twice the same text", "en", "src2", 1)]
    near = " ".join(f"word{i}" for i in range(400))
    odd += [(9006, near, "en", "src3", 1), (9007, near.replace("word7 ", "WORD7\n"), "en", "src4", 1), (9008, None, None, None, None)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out = []
    docs.write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, str(folder)).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append((before, docs.collect(), docs.columns))
    return out, str(folder)


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_dedup", "mix_sources", "best_fit_packing"]
    assert all(columns == ["doc_id", "text", "lang", "source", "n_chars"] for _, _, columns in steps[0][:-1])


def test_only_documents_without_a_letter_go(steps):
    before, after, _ = steps[0][0]
    assert sorted(map(str, after)) == sorted(str(r) for r in before if r.text and any(c.isalpha() for c in r.text))
    assert len(before) - len(after) >= 4


def test_the_last_of_equal_texts_stays(steps):
    before, after, _ = steps[0][1]
    last = {}
    for r in before:
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(last.values()) and len(after) < len(before)


def test_one_of_near_texts_stays(steps):
    before, after, _ = steps[0][2]
    ids = [r.doc_id for r in before]
    want = brute_components(ids, [brute_fingerprint(r.text, 4) for r in before], 4)
    assert sorted(r.doc_id for r in after) == sorted(set(want.values())) and 9007 not in {r.doc_id for r in after}


def test_the_mix_is_near_its_targets(steps):
    before, after, _ = steps[0][3]
    size = {r.doc_id: len(r.text.encode().split()) for r in before}
    sums, taken = collections.Counter(), collections.Counter()
    for r in before:
        sums[r.source] += size[r.doc_id]
    for r in after:
        taken[r.source] += size[r.doc_id]
    most = collections.Counter()
    for r in before:
        most[r.source] = max(most[r.source], size[r.doc_id])
    for s, target in brute_targets(dict(sums), (3, 1, 2), 1.5, 2.0).items():
        assert abs(taken[s] - target) <= most[s]
    assert max(collections.Counter(r.doc_id for r in after).values()) <= 2
    assert {str(r) for r in after} <= {str(r) for r in before}


def test_sequences_hold_every_document(steps, spark):
    before, after, _ = steps[0][4]
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for r in before:
        ids = np.array([*own.encode(r.text, add_special_tokens=False).ids, 0], dtype="<u4")
        for piece, (start, length) in enumerate(packing.cut(len(ids))):
            want[(r.doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes()))] += 1
    assert want == collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in after)
    places = collections.defaultdict(list)
    for r in after:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        parts.sort()
        assert [a for a, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) <= 2048


def test_run_gives_the_rows_of_the_stages(steps, spark):
    got = collections.Counter((r.doc_id, r.piece, r.start, r.ids_crc32) for r in corpus_pipeline.run(spark, steps[1]).collect())
    assert got == collections.Counter((r.doc_id, r.piece, r.start, r.ids_crc32) for r in steps[0][4][1])


def test_every_operator_has_one_query():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(ORACLE) < set(QUERIES) <= set(names) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_duckdb(spark, name):
    from check import compare, connect

    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) is None
