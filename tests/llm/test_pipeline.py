import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline as pipeline
from tests.llm.brute import components
from tests.llm.frames import DOCS, awkward, none
from vacanta.llm import mixing
from vacanta.llm.common import park, read


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """Rows before and after each stage."""
    docs, found = read(spark, sf_dir, "documents"), {}
    for name, stage in pipeline.STAGES:
        out = park(stage(spark, docs, sf_dir), "test-stage")
        found[name] = (docs, out)
        docs = out
    return found


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_and_columns(steps, spark, sf_dir):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_files"]
    columns = read(spark, sf_dir, "documents").columns
    assert all(out.columns == columns for name, (_, out) in steps.items() if name != "token_files")


def test_toxicity_keeps_clean_documents(steps, spark, sf_dir):
    before, after = steps["toxicity"]
    labels = {r["doc_id"]: r["toxic"] for r in read(spark, sf_dir, "labels").collect()}
    gone = ids(before) - ids(after)
    assert sum(labels.get(i) == 0 for i in gone) <= 0.02 * sum(v == 0 for v in labels.values())


def test_one_document_of_each_group_stays(steps):
    before, after = steps["near_duplicates"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    assert ids(after) == set(components(texts, 5, 80).values())
    assert after.count() == len(ids(after))


def test_benchmark_passages_go(steps, spark, sf_dir):
    before, after = steps["decontamination"]
    split = lambda t: f" {' '.join(re.findall(r'[^\W_]+', t.lower()))} "
    passages = [split(r["text"]) for r in read(spark, sf_dir, "benchmark").collect()]
    holds = {r["doc_id"] for r in before.collect() if any(p in split(r["text"]) for p in passages)}
    assert ids(after) == ids(before) - holds


def test_mixing_takes_whole_documents(steps):
    before, after = steps["mixing"]
    texts = {r["doc_id"]: (r["text"], r["source"]) for r in before.collect()}
    rows = after.collect()
    assert all(texts[r["doc_id"]] == (r["text"], r["source"]) for r in rows)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sources = sorted({s for _, s in texts.values()})
    sizes = [sum(words(t) for t, s in texts.values() if s == name) for name in sources]
    goals = mixing.targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(sizes))])
    for name, goal in zip(sources, goals, strict=True):
        own = [words(t) for t, s in texts.values() if s == name]
        assert goal - max(own) <= sum(words(r["text"]) for r in rows if r["source"] == name) <= goal + 0.5


def test_tokens_are_those_of_the_rows(steps):
    before, after = steps["token_files"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    crc = lambda t: zlib.crc32(np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes())
    want = sorted((r["doc_id"], crc(r["text"])) for r in before.collect())
    assert [(r["doc_id"], r["ids_crc32"]) for r in after.orderBy("start").collect()] == want


def test_awkward_and_empty_documents_pass_through(spark, sf_dir):
    for docs in (awkward(spark), none(spark)):
        for name, stage in pipeline.STAGES:
            out = park(stage(spark, docs, sf_dir), "test-awkward")
            docs = out if name != "token_files" else docs
            assert name == "token_files" or out.schema == spark.createDataFrame([], DOCS).schema


def test_registered():
    assert driver.queries()["pipeline"] is pipeline.run and pipeline.ORACLE_SQL is None
    assert [n for n in driver.queries() if n.startswith("op")] == [
        "op1_sharding", "op2_url_filter", "op3_toxicity", "op4_quality_rules", "op5_token_files",
        "op6_mixing", "op7_minhash", "op8_license_scan", "op9_decontaminate", "op10_byte_cnn",
        "op11_centroids", "op12_line_dedup", "op13_lexical_search",
    ]
