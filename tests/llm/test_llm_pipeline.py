"""The pipeline on the smallest tables, stage by stage, and on awkward ones."""

import hashlib
import re
from collections import Counter

import cases
import numpy as np
import public_tokenizers

import __spark_entry__ as contract
import corpus_pipeline
from meterline.llm import queries
from meterline.llm.common import stored
from test_llm_dedup import classes, naive_fingerprint, plain

SF = "/root/testdata/sf0.001"


def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF), "stage")
        seen[name] = (before.collect(), docs.collect())
        if name != "bpe_encode":
            assert docs.columns == columns
    given, good = seen["quality_classifier"]
    assert {r.doc_id for r in good} <= {r.doc_id for r in given}
    verdicts = {r.doc_id: r.kept for r in queries.QUERIES["op10_quality_classifier"](spark, SF).collect()}
    assert {r.doc_id for r in good} == {d for d, kept in verdicts.items() if kept}
    given, single = seen["exact_dedup"]
    assert Counter(plain(r.text) for r in single) == Counter({plain(r.text): 1 for r in given})
    given, apart = seen["simhash_near_dedup"]
    given = sorted(given, key=lambda r: r.doc_id)
    roots = classes([naive_fingerprint(r.text) for r in given])
    assert {r.doc_id for r in apart} == {given[i].doc_id for i in set(roots)}
    given, blend = seen["mix_sources"]
    words = Counter()
    for r in given:
        words[r.source] += len((r.text or "").split())
    assert sum(len(r.text.split()) for r in blend) / (1.5 * sum(words.values())) > 0.97
    given, coded = seen["bpe_encode"]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in given:
        ids = np.array(tokenizer.encode(r.text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        want[r.doc_id, hashlib.sha256(ids).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in coded) == want


def test_run_is_the_registered_pipeline(spark):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 100 and "doc_id" in out.columns


def test_awkward_documents(spark, tmp_path):
    (tmp_path / "t").mkdir()
    folder = str(tmp_path / "t")
    spark.createDataFrame([(100 + i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    for docs in (cases.messy(spark), cases.empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            before = docs.columns
            docs = stored(stage(spark, docs, folder), name)
            assert name == "bpe_encode" or docs.columns == before


def test_names(spark):
    names = list(queries.QUERIES)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(contract.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "mix_sources", "bpe_encode"]


def test_queries_with_sql_agree(spark):
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(contract.__file__)), "tools"))
    import compare

    con = compare.connect(SF)
    for name, sql in queries.SQL.items():
        df = queries.QUERIES[name](spark, SF)
        res = con.execute(sql)
        assert compare.rows_of(df.columns, df.collect()) == compare.rows_of([d[0] for d in res.description], res.fetchall()), name
