"""Every stage of the pipeline on a small fixture, against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tests.llm.test_near_copies import jaccard, shingles
from tideshift.llm import langid, mixing
from tideshift.session import settle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(90_001, None, "en", None, None), (90_002, "", "de", "src1", 0), (90_003, "12 34 !!", None, "src1", 8), (None, "the of and to in", "en", "src2", 16),
           (90_004, "Call +1 (988) 555-2485 or 4111 1111 1111 1111 the of and to in that", "en", "src2", 60)]
    odd += [odd[-1], (90_005, odd[-1][1], "fr", "src9", 60)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("score", docs.n_chars)
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(settle(stage(spark, out[-1], SF)))
    return out


def rows(df):
    return [tuple(r) for r in df.select(*cp.COLUMNS).collect()]


def test_language_stage(stages):
    docs, kept = stages[:2]
    model = langid.fit(langid.learnable(docs))
    bad = {r.doc_id for r in langid.predict(docs, model).where("rejected").collect()}
    assert {90_001, 90_002, 90_003} <= bad and len(bad) < 10
    assert sorted(rows(kept), key=str) == sorted([r for r in rows(docs) if r[0] not in bad], key=str)
    assert kept.columns == cp.COLUMNS


def test_near_duplicate_stage(stages):
    """Exact similarities say who must go: copies at 0.8 or more of a smaller id; who has no partner above 0.5 stays."""
    before, after = rows(stages[1]), {r[0] for r in rows(stages[2])}
    sets = [shingles(r[1]) for r in before]
    order = [(r[0] is None, r[0] or 0) for r in before]
    near, company = set(), set()
    for i, j in itertools.combinations(range(len(before)), 2):
        if sets[i] & sets[j] or not (sets[i] or sets[j]):
            value = jaccard(sets[i], sets[j])
            if value >= 0.8:
                near.add(before[max(i, j, key=lambda k: order[k])][0])
            if value > 0.5:
                company |= {i, j}
    alone = {before[i][0] for i in range(len(before)) if i not in company}
    assert alone <= after and len(near) > 5
    assert len(near & after) <= 0.1 * len(near)
    assert len(rows(stages[2])) == len(after) and after < {r[0] for r in before}


def test_pseudonym_stage(stages):
    before, after = ({r[0]: r for r in rows(s)} for s in stages[2:4])
    assert before.keys() == after.keys()
    changed = [d for d in before if before[d][1] != after[d][1]]
    assert 90_004 in changed
    assert re.fullmatch(r"Call \+1 \([2-9]\d\d\) [2-9]\d\d-\d{4} or 4\d{3} \d{4} \d{4} \d{4} the of and to in that", after[90_004][1])
    for d in before:
        assert before[d][2:4] == after[d][2:4] and after[d][4] == len(after[d][1])
        if d not in changed:
            assert before[d][1] == after[d][1]


def test_mixing_stage(spark, stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert sorted(before, key=str) == sorted(after, key=str)
    place = {r.doc_id: r.mix_position for r in mixing.mix(stages[3]).collect()}
    # Rows in the order of the written files.
    files = sorted(f for f in stages[4].inputFiles())
    laid = [r.doc_id for f in files for r in spark.read.parquet(f).select("doc_id").collect()]
    assert laid == sorted(place, key=place.get)


def test_token_stage(stages):
    library = Tokenizer.from_file(public_tokenizers.path(cp.TOKENIZER))
    texts = {r[0]: r[1] for r in rows(stages[4])}
    made = stages[5].collect()
    assert {r.doc_id for r in made} == set(texts) and len(made) == len(texts)
    for r in made:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.token_ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_result_carries_the_mix(stages):
    """Places in the result are those that the mixing stage laid its rows out by; rows that repeat share theirs in any order."""
    texts = {r[0]: r[1] for r in rows(stages[3])}
    place = {(r.doc_id, r.mix_slot, r.mix_position) for r in mixing.mix(stages[3].repartition(7)).collect()}
    made = {(r.doc_id, r.mix_slot, r.mix_position) for r in stages[5].collect()}
    assert made == place and len({p for _, _, p in made}) == len(made) >= len(texts)


def test_run_and_empty_table(spark, tmp_path):
    whole = cp.run(spark, SF)
    assert whole.columns == ["doc_id", "source", "mix_slot", "mix_position", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256"] and whole.count() > 150
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0
