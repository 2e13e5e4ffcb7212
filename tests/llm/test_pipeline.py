"""Every pipeline stage on its own input, against brute force."""

import hashlib
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from churnlens.llm import ordinal
from churnlens.llm.store import written
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_near_dup import brute as brute_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) of each stage over the whole tables."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        result = written(stage(spark, docs, SF), name.replace(" ", "-"))
        out[name] = docs, result
        docs = result
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.dtypes == before.dtypes, name


def test_quality_classifier(spark, stages):
    before, after = stages["quality classifier"]
    model = ordinal.train(before, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in ordinal.classify(before, model).where("kept").collect()}
    source = rows(before)
    got = rows(after)
    assert set(got) == kept and len(got) > 0.5 * len(source)
    assert all(got[d] == source[d] for d in got)


def test_line_dedup(stages):
    before, after = stages["line dedup"]
    source, got = rows(before), rows(after)
    for d, text, _, cut in brute_lines([(r.doc_id, r.text) for r in source.values()]):
        if cut and not re.search(r"[^\x20\x09-\x0D]", text):
            assert d not in got
        else:
            assert got[d].text == text
            assert got[d].n_chars == (len(text) if cut else source[d].n_chars)


def test_near_dedup(stages):
    before, after = stages["minhash near-dedup"]
    source, got = rows(before), rows(after)
    kept = {d for d, _, _, k in brute_groups([(r.doc_id, r.text) for r in source.values()], 80) if k}
    assert set(got) == kept and all(got[d] == source[d] for d in got)


def test_decontamination(spark, stages):
    before, after = stages["benchmark decontamination"]
    fold = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    items = [fold(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    source, got = rows(before), rows(after)
    whole = {d for d, r in source.items() if any(i in fold(r.text) for i in items)}
    grams = {tuple(w[k:k + 4]) for i in items for w in [i.split()] for k in range(len(w) - 3)}
    some = {d for d, r in source.items() for w in [fold(r.text).split()]
            if sum(tuple(w[k:k + 4]) in grams for k in range(len(w) - 3)) >= 4}
    assert whole <= set(source) - set(got) <= some
    assert all(got[d] == source[d] for d in got)


def test_decontamination_of_null_and_repeated_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").head().text
    clean = " ".join(f"clean{k}" for k in range(80))
    extra = [(None, item), (None, clean), (-1, item), (-1, clean), (-1, None)]
    more = spark.createDataFrame([(d, t, "x", "added", 1) for d, t in extra],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    out = cp.decontamination(spark, docs.unionByName(more), SF).where("source = 'added'").collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted([(None, clean), (-1, clean), (-1, None)], key=str)


def test_encoding(stages):
    before, after = stages["bpe encoding"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = rows(after)
    for d, r in rows(before).items():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert bytes(got[d].ids) == raw and got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(raw).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert got[d].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_run_and_empty_documents(spark, stages, tmp_path):
    assert rows(cp.run(spark, SF)).keys() == rows(stages["bpe encoding"][1]).keys()
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_near_dedup_of_null_and_repeated_ids(spark, tmp_path):
    """Exact copies under NULL and repeated ids leave one row; a clean text under a shared id stays; so do texts
    without words."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(None, a), (None, a), (7, a), (7, a), (7, b), (None, c), (None, c), (9, ""), (10, ""), (11, None), (12, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/d")
    out = cp.near_dedup(spark, spark.read.parquet(f"{tmp_path}/d"), "")
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(7, a), (7, b), (None, c), (9, ""), (10, ""), (11, None), (12, " ")], key=str)
    assert out.columns == docs.columns


def test_decontamination_shuffles_no_texts(spark):
    """The join that drops the found documents broadcasts them, though the benchmark search reads a larger table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 20_000)
    try:
        plan = cp.decontamination(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
