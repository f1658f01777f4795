"""The pipeline against brute force, stage by stage, and on awkward tables."""

import corpus_pipeline
import pytest
from conftest import SF_SMALL
from stratum.llm import quality
from stratum.llm import sentencepiece_sampling as sp
from stratum.llm.common import table
from stratum.llm.queries import quality_model, vocabulary

from .test_decontaminate import brute as brute_contaminated
from .test_near_dedup import brute_classes


def brute_kept(rows, items):
    """Exact copies (largest id stays), near copies (least id stays), benchmark texts, in this order."""
    last = {}
    for i, t in rows:
        last[t or ""] = max(i, last.get(t or "", i))
    rows = [(i, t) for i, t in rows if last[t or ""] == i]
    classes = brute_classes(rows)
    rows = [(i, t) for i, t in rows if classes[i] == i]
    gone = {d for d, _ in brute_contaminated(rows, items)}
    return [(i, t) for i, t in rows if i not in gone]


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "sentencepiece"]
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run


def test_run_equals_brute_force(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents")
    model = quality_model(spark, docs, SF_SMALL)
    good = {r.doc_id for r in quality.score(docs, model).where("score >= 0.5").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    want = dict(brute_kept(rows, items))
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert len(want) > 100 and {r.doc_id for r in got} == set(want)
    voc = sp.vocabulary(vocabulary("piece_bpe_32k.model"))
    assert all(voc.decode(r.ids) == want[r.doc_id] for r in got)


@pytest.fixture()
def awkward(spark, tmp_path):
    item = "one two three four five six seven eight nine ten"
    long = " ".join(f"w{i}" for i in range(20_000))
    rows = [(1, "a plain text of some words here"), (2, "a plain text of some words here"), (3, None), (4, ""),
            (5, long), (6, long + " tail"), (7, f"so {item}"), (7, f"so {item}"), (8, "kept"), (8, "kept"), (None, "no id")]
    spark.createDataFrame([(*r, None, "s", 1, True) for r in rows],
                          "doc_id long, text string, lang string, source string, n_chars long, kept boolean"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_awkward_tables(spark, awkward):
    docs = table(spark, awkward, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, awkward)
        assert docs.columns == columns, name
    ids = sorted((r.doc_id for r in docs.collect()), key=str)
    assert ids == sorted([2, 4, 5, 8, None], key=str)
    first = {r.doc_id: len(r.ids) for r in corpus_pipeline.STAGES[-1][1](spark, docs, awkward).collect()}
    assert set(first) == {2, 4, 5, 8, None} and first[4] == 0


def test_encode_stage_decodes(spark, awkward):
    docs = table(spark, awkward, "documents")
    got = corpus_pipeline.encode_stage(spark, docs, awkward).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert {r.doc_id for r in got} == set(texts) and all(r.decoded == texts[r.doc_id] for r in got)


def test_empty_tables(spark, awkward, tmp_path):
    empty = tmp_path / "empty"
    for name in ("documents", "benchmark", "labels"):
        table(spark, awkward, name).limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
