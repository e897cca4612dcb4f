"""The pipeline against its stages written out one by one on plain lists."""

import os
import re

import numpy as np
import pytest
from common import documents, edited, prose
from test_neardup import brute
from test_packing import places_hold

import corpus_pipeline
from tidelog.llm import pii
from tidelog.llm.decontaminate import tiles
from tidelog.llm.queries import PSEUDONYM_KEY, TOKENIZERS

pytestmark = pytest.mark.skipif(not os.path.exists(f"{TOKENIZERS}/word_bpe_49k.json"), reason="tokenizers not there")

ITEM = " ".join(prose(900, 30))


def cases():
    out = [" ".join(prose(s, 60)) for s in range(10)]
    out += [" ".join(edited(out[s].split(), s, 1)) for s in range(5)] + out[:3]
    out += [f"{out[5]} {ITEM[:70]}", f"before {ITEM} after", None, "", "12 34", "mail jo@a.org card 4111111111111111 and ip 10.1.2.3 " + out[9][:100]]
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    documents(spark, cases(), extra="row,hits,kept,component_id,llm_row").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = {i: t for i, t in enumerate(cases()) if t and re.search("[a-z]", t)}
    kept_at = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, before = stage(spark, docs, folder), docs
        assert docs.columns == before.columns
        if name == "near_duplicates":
            kept = {d for d, _, _, keep in brute(list(want), list(want.values()), 5, 80) if keep}
            want = {d: t for d, t in want.items() if d in kept}
        elif name == "decontamination":
            numbers = lambda t: np.array([hash(w) & (2**63 - 1) for w in t.split()], np.uint64)
            want = {d: t for d, t in want.items() if sum(x[2] for x in tiles(numbers(t), numbers(ITEM))) < 15}
        elif name == "pseudonyms":
            want = {d: new for d, new in ((r.doc_id, r.text) for r in pii.pseudonyms(documents(spark, list(want.values()), list(want)), "text", PSEUDONYM_KEY).collect())}
        assert {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()} == want, name
        kept_at.append(len(want))
    assert kept_at[0] > kept_at[1] > kept_at[2] == kept_at[3] and "10.1.2.3" not in want[23]


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert places_hold(rows, 2048) == -(-sum(r.length for r in rows) // 2048) and not {19, 20, 21, 22} & {r.doc_id for r in rows}
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES][0] == "language"


def test_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
