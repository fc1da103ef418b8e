"""The pipeline: each stage on what the one before kept, by plain means; odd tables; guards."""

import hashlib
import os
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import test_decontam
import test_neardup
from pyspark.sql import functions as F

import corpus_pipeline
from roadspark.llm import langid, quality, queries

SF = "/root/testdata/sf0.001"


def learnable(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 != 2


def plain_quality(docs, sf_dir, spark):
    """Document by document, fitted on rows gathered here."""
    text = {r.doc_id: (r.text or "").encode() for r in docs}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    vector = {d: quality.features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for d, t in text.items()}
    known = [d for d in labels if d in text and learnable(d)]
    x, y = np.array([vector[d] for d in known]), np.array([labels[d] for d in known])
    order = np.lexsort((*x.T, y))
    model = quality.fit(x[order], y[order])
    return {d for d in text if quality.scores(model, vector[d][None])[0] >= quality.CUT}


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages, items = dict(corpus_pipeline.STAGES), [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def step(name, before):
        after = stages[name](spark, before, SF).cache()
        return after, before.collect(), {r.doc_id for r in after.collect()}

    after, rows, kept = step("quality", docs)
    assert after.columns == docs.columns
    assert kept == plain_quality(rows, SF, spark)

    model = langid.train(after)
    after, rows, kept = step("language", after)
    found = {r.doc_id: [x[0] for x in model.predict([r.text])] for r in rows}  # one by one
    assert after.columns == docs.columns
    assert kept == {d for d, (lang, _, known) in found.items() if lang != langid.UNKNOWN and known}

    after, rows, kept = step("near_duplicates", after)
    assert after.columns == docs.columns
    assert kept == {d for d, _, _, first in test_neardup.plain([(r.doc_id, r.text) for r in rows]) if first}

    after, rows, kept = step("decontamination", after)
    assert after.columns == docs.columns
    assert kept == {r[0] for r in test_decontam.plain([(r.doc_id, r.text) for r in rows], items) if not r[5]}

    rows = after.collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = sorted((r.doc_id, hashlib.sha256(np.array(sp.encode(r.text, add_bos=True, add_eos=True), "<u4").tobytes()).hexdigest()) for r in rows)
    assert sorted((r.doc_id, r.ids_sha256) for r in stages["sentencepiece"](spark, after, SF).collect()) == expected
    assert sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()) == expected


def test_good_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = corpus_pipeline.keep_quality(spark, docs, SF).select("doc_id").withColumn("kept", F.lit(1))
    good = labels.where("quality = 1").join(kept, "doc_id", "left")
    assert good.where("kept is null").count() <= 0.02 * good.count()


def test_odd_tables(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, None, None, None, "z"), (None, "", "en", "s", 0, "z"), (2, "word " * 50_000, "en", "s", 1, "z")], "doc_id long, text string, lang string, source string, n_chars long, score string")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    for frame in (docs, docs.limit(0)):
        out = frame
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, str(tmp_path))
            assert out.count() <= frame.count()


def test_every_query_is_registered():
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in queries.QUERIES)] == []


@pytest.mark.parametrize("missing", ["roadspark/llm", "corpus_pipeline.py"])
def test_entry_imports_without_this_subpackage(tmp_path, missing):
    repo = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name != "corpus_pipeline.py":
            os.symlink(f"{repo}/{name}", tmp_path / name)
    (tmp_path / "roadspark").mkdir()
    for name in os.listdir(f"{repo}/roadspark"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{repo}/roadspark/{name}", tmp_path / "roadspark" / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'road_ways' in q and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
