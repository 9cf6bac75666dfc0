"""Each stage on its predecessor's result, against plain versions of the operators."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from quire.llm.queries import op1_quality

from . import test_line_dedup, test_near_copies, test_packing, test_quality, test_repeats, test_simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark):
    found = [(i, t, "en", s, len(t or "")) for i, t, _, s, *_ in test_simhash.rows() if i is not None]
    return spark.createDataFrame(found, DOCS)


@pytest.fixture(scope="module")
def results(spark):
    out, docs = [documents(spark)], documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, "")
        docs = spark.createDataFrame(done.collect(), done.schema)
        out.append(docs)
    return [d.collect() for d in out]


def plain(rows):
    return [(r.doc_id, r.text, None, r.source) for r in rows]


def test_names_and_columns(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "repeat_dedup", "packing"]
    for rows in results[:-1]:
        assert all(r.n_chars == len(r.text or "") for r in rows)


def test_quality_stage(results):
    want = Counter((w[0], w[9]) for w in test_quality.brute(plain(results[0]), 10) if w[8])
    assert Counter((r.doc_id, r.text) for r in results[1]) == want and 0 < len(results[1]) < len(results[0])


def test_line_stage(results):
    want = Counter((i, t) for (i, _, _, t), n in test_line_dedup.brute(plain(results[1])).items() for _ in range(n))
    assert Counter((r.doc_id, r.text) for r in results[2]) == want


def test_near_stage(results):
    want = test_near_copies.brute_rows([(r.doc_id, r.text) for r in results[2]])
    assert sorted(r.doc_id for r in results[3]) == sorted(want)


def test_repeat_stage(results):
    import hashlib

    want = {i: h for (i, _, _, _, h) in test_repeats.brute(plain(results[3]), 400)}
    for r in results[4]:
        sha = hashlib.sha256(r.text.encode()).hexdigest()
        assert sha == want[r.doc_id] or not r.text.isascii()
    assert len(results[4]) == len(results[3])


def test_repeat_stage_takes_passages_of_over_50_words_below_400_bytes(spark):
    passage = " ".join(f"w{k}" for k in range(59))
    found = [(k, f"{' '.join(f'x{k}y{j}' for j in range(40))} {passage} end{k}", "en", "s", 0) for k in range(2)]
    out = corpus_pipeline.repeat_dedup(spark, spark.createDataFrame(found, DOCS), "").collect()
    assert len(passage) < 400 and len(out) == 2 and not any("w3 " in r.text for r in out) and all(f"end{r.doc_id}" in r.text for r in out)


def test_packing_stage(results):
    got = defaultdict(int)
    for r in results[5]:
        got[r.doc_id] += r.length
    assert got == {r.doc_id: len(test_packing.ids_of(r.text)) for r in results[4]}


def test_run_and_queries_accept_a_folder(spark, tmp_path):
    documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert op1_quality(spark, str(tmp_path)).count() == documents(spark).count()
