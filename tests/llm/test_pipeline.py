"""The pipeline stage by stage, and the registered queries against SQL."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import check
from termspark.llm import decontaminate, language, packing, tokens
from termspark.llm.common import map_rows, read_once, struct
from termspark.llm.queries import ORACLES, QUERIES
from test_similar import slow_kept

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert check(spark, SF, QUERIES[name], ORACLES[name]) is None


def test_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, kept = [n for n, _ in corpus_pipeline.STAGES], [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made, _ = read_once(stage(spark, kept[-1], SF), name)
        assert made.columns == docs.columns
        kept.append(made)
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in kept]
    assert all(later <= earlier for earlier, later in zip(ids, ids[1:]))
    # each stage drops what its operator says, and nothing else
    langs = language.language_report(docs).collect()
    assert ids[1] == {r["doc_id"] for r in langs if r["lang_pred"] != "und" and not r["ambiguous"]}
    assert ids[2] == set(slow_kept([(r["doc_id"], r["text"]) for r in kept[1].collect()])) and len(ids[2]) < len(ids[1])
    leaks = decontaminate.contamination_report(kept[2], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    assert ids[3] == {r["doc_id"] for r in leaks if not r["contaminated"]} and len(ids[3]) < len(ids[2])
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == ids[3]
    assert names == ["language_id", "near_dedup", "benchmark_decontamination", "packing"]


def test_odd_rows(spark, odd_docs, no_docs, clashing, tmp_path):
    for n, docs in enumerate((clashing(odd_docs), no_docs)):
        folder = f"{tmp_path}/{n}"
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
        assert (corpus_pipeline.run(spark, folder).count() > 0) == (n == 0)


def test_workers_hand_memory_back(spark):
    """A worker that needed 128 MB for a batch has not kept it when the next one comes."""

    def start():
        import re

        import pyarrow as pa
        import pyarrow.compute as pc

        def held():
            with open("/proc/self/status") as status:
                return int(re.search(r"RssAnon:\s+(\d+)", status.read())[1]) // 1024

        def work(batch):
            before = held()
            kept = [pc.add(pa.array(range(8192)), 1) for _ in range(2000)]
            made = {"batch": batch["id"][0].as_py(), "before": before, "most": held() + 0 * len(kept)}
            return {name: [value] * batch.num_rows for name, value in made.items()}

        return work

    docs = spark.range(5000).coalesce(1)
    out = struct("batch bigint, before bigint, most bigint")
    first, *later = sorted(map_rows(docs, {"id": "bigint"}, out, start).distinct().collect())
    assert len(later) == 2 and first["most"] - first["before"] > 100
    assert all(r["before"] - first["before"] < 40 for r in later), (first, later)


def test_packer_of_the_pipeline_keeps_few_words(spark, odd_docs, monkeypatch):
    """It asks for its own, smaller caches, which change no row."""
    asked = []
    given = packing.pack_documents
    monkeypatch.setattr(packing, "pack_documents", lambda *a, **more: asked.append(more["cached"]) or given(*a, **more))
    made = corpus_pipeline.pack_sequences(spark, odd_docs.coalesce(1), SF)
    assert asked[0] < tokens.CACHED_WORDS
    plain = given(odd_docs.coalesce(1), tokens.tokenizer_path("byte_bpe_50k.json"))
    assert sorted(map(str, made.collect())) == sorted(map(str, plain.collect()))
    small = tokens.encoder(tokens.tokenizer_path("byte_bpe_50k.json"), 3)
    small.encode(["a b c d e f g h i j"])
    assert len(small.words) <= 3 and len(small.words.old) <= 3
