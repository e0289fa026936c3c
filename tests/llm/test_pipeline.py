"""Each stage of the pipeline is judged on its own input, by brute force."""

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as pipeline
from tests.llm.test_minhash import brute
from wikicells.llm import bpe, mixture
from wikicells.llm.secrets import hidden

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, small):
    out, docs = [small.collect()], small
    for _, stage in pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        out.append(docs.collect())
    return out


def test_names():
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "minhash", "secrets", "mixing", "byte_bpe"]


def test_all_but_the_last_keep_the_columns(results):
    assert all(tuple(rows[0].asDict()) == pipeline.COLUMNS for rows in results[1:-1])


def test_toxic_documents_go(results, spark):
    docs, kept = results[0], {r.doc_id for r in results[1]}
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [r.doc_id for r in docs if toxic.get(r.doc_id) == 0]
    assert all(r in docs for r in results[1]) and sum(i in kept for i in clean) >= 0.98 * len(clean)


def test_one_of_each_group_stays(results):
    rows = [(r.doc_id, r.text) for r in results[1]]
    components, _ = brute(rows, 5, 80)
    assert {r.doc_id for r in results[2]} == set(components.values())
    assert all(r in results[1] for r in results[2])


def test_secrets_are_hidden(results):
    expected = [(r.doc_id, hidden(r.text), r.lang, r.source, len(hidden(r.text))) for r in results[2]]
    assert sorted(map(tuple, results[3])) == sorted(expected)


def test_sources_meet_targets(results, spark):
    rows = mixture.mix(spark.createDataFrame(results[3]), cut=False).collect()
    copies = {r.doc_id: r.copies for r in rows}
    ids = [r.doc_id for r in results[4]]
    assert {i: ids.count(i) for i in copies} == copies
    assert set(results[4]) <= set(results[3])


def test_tokens(results):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    import hashlib
    expected = [(r.doc_id, len(ids := encode(r.text)), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()) for r in results[4]]
    assert sorted(map(tuple, results[5])) == sorted(expected)


def test_run(spark, results):
    assert sorted(map(tuple, pipeline.run(spark, SF).collect())) == sorted(map(tuple, results[5]))


def test_stages_take_odd_rows(spark, odd, nothing):
    for docs in (odd, nothing):
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, SF)
            docs.count()
