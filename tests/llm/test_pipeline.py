"""The pipeline and the registered queries against a plain version of each stage."""

import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from obralake.llm import queries
from obralake.llm.packing import WordEncoder
from obralake.llm.pseudonyms import pseudonymise
from obralake.session import store

from ..check_oracles import compare, oracle_connection
from .common import SF, documents, prose
from .test_decontamination import brute as leaks
from .test_jaccard import brute as copies
from .test_jaccard import edited


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, SF), name)
        out.append((name, docs))
    return {name: df for name, df in out}


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_stay(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "decontamination", "pseudonyms", "packing"]
    for name in names[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    kept = rows(stages["toxicity"])
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i, y in labels.items() if not y]
    assert sum(i in kept for i in clean) >= 0.99 * len(clean)
    assert sum(i in kept for i, y in labels.items() if y) <= 0.7 * sum(labels.values())


def test_one_document_of_each_group_stays(stages):
    before = [(r.doc_id, r.text) for r in rows(stages["toxicity"]).values()]
    want = {i for i, n, c, _ in copies(before, 80, 5) if n == 0 or i == c}
    assert set(rows(stages["near_copies"])) == want


def test_near_copies_share_four_fifths_of_their_five_word_shingles(spark):
    base = prose(1, 250)
    rows = [(1, base), (2, edited(base, 20, 70, 120, 170, 220)), (3, edited(base, *range(5, 250, 12))), (4, prose(2, 250))]
    sets = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}
    near = lambda i, j: 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    want = {i for i in sets if not any(near(i, j) for j in sets if j < i)}
    assert want == {1, 3, 4} and 2 in {i for i, _, c, _ in copies(rows) if i == c}  # apart by three words and 0.9
    got = corpus_pipeline.drop_copies(spark, documents(spark, rows), SF)
    assert {r.doc_id for r in got.collect()} == want


def test_leaks_go(spark, stages):
    before = [(r.doc_id, r.text) for r in rows(stages["near_copies"]).values()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {i for i, _, _, _, hit in leaks(before, items) if not hit}
    assert set(rows(stages["decontamination"])) == want


def test_texts_are_pseudonymised_and_packed(spark, stages):
    before, after = rows(stages["decontamination"]), rows(stages["pseudonyms"])
    key = queries.PSEUDONYM_KEY.encode()
    assert {i: r.text for i, r in after.items()} == {i: pseudonymise(r.text, key)[0] for i, r in before.items()}
    encoder = WordEncoder(queries.vocabulary_file())
    ids = {i: encoder.encode(r.text) + np.array([1], "<u4").tobytes() for i, r in after.items()}
    pieces = stages["packing"].collect()
    for r in pieces:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][4 * r.start:4 * (r.start + r.length)])
    assert sum(r.length for r in pieces) == sum(len(x) // 4 for x in ids.values())


def test_run_gives_the_stages_rows(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(got) == key(stages["packing"])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_with_a_twin(spark, name):
    assert compare(spark, oracle_connection(SF), name, SF).startswith("ok")


def test_held_out_rows_are_never_learned_from(spark):
    for name, of, rest in (("op3_toxicity", 5, 0), ("op5_language", 4, 2)):
        for r in entry.queries()[name](spark, SF).collect():
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % of == rest)
            assert 0 <= r.score <= 1
