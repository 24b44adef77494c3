"""The pipeline against its stages done one document at a time, and the registered queries' columns."""

from __future__ import annotations

from collections import Counter

import pytest
from compare import connect, difference
from pyspark.sql import functions as F
from test_decontaminate import smith_waterman
from test_jaccard import brute
from test_mixture import water_fill

import __spark_entry__ as entry
import corpus_pipeline
from activity_engine.llm import decontaminate as dc
from activity_engine.llm import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage returns, as rows; each works on what its predecessor wrote."""
    out, docs = {}, spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, SF_DIR).collect()
        out[name] = rows
        if name != corpus_pipeline.STAGES[-1][0]:
            docs = spark.createDataFrame(rows, docs.schema)
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_stages_do_what_a_loop_does(spark, kept):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic = 1").collect()}
    gone = {r.doc_id for r in docs} - set(ids(kept["toxicity"]))
    assert len(toxic & gone) >= 0.7 * len(toxic) and len(gone - toxic) <= 0.06 * len(docs)
    # The given documents all are in a language.
    assert ids(kept["language"]) == ids(kept["toxicity"])
    before = [(r.doc_id, r.text) for r in kept["language"]]
    assert ids(kept["near_copies"]) == sorted(d for d, _, component in brute(before, 5, 80) if d == component)
    items = [dc.words_of(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    numbers: dict = {}
    number = lambda words: [numbers.setdefault(w, len(numbers) + 1) for w in words]
    items = [number(w) for w in items]
    clean = []
    for r in kept["near_copies"]:
        words = number(dc.words_of(r.text))
        near = [i for i in items if len(set(i) & set(words)) >= len(set(i)) // 3]
        if not any(smith_waterman(i, words) >= dc.LEAST_SCORE * dc.MATCH * len(i) for i in near):
            clean.append(r.doc_id)
    assert ids(kept["decontamination"]) == sorted(clean)
    sizes, source, size = Counter(), {}, {}
    for r in kept["decontamination"]:
        size[r.doc_id], source[r.doc_id] = len((r.text or "").encode().split()), r.source
        sizes[r.source] += size[r.doc_id]
    targets = water_fill(sizes, [5.0, 2.0, 1.0], 1.5, 2.0)
    taken = Counter()
    assert ids(kept["mixing"]) == sorted(clean)
    for r in kept["mixing"]:
        assert r["size"] == size[r.doc_id] and r.target == pytest.approx(targets[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in targets)


def test_run_gives_the_last_stage(spark, kept):
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(found) == sorted(kept["mixing"])


def test_rows_keep_all_columns_and_odd_rows_pass(spark, kept):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert all(list(r.asDict()) == docs.columns for name in ("toxicity", "near_copies") for r in kept[name][:1])
    odd = docs.limit(3).unionByName(
        spark.createDataFrame([(None, "kein id hier", None, None, None), (9_000, None, None, None, 0), (9_000, "twice", "en", "x", 5)], docs.schema)
    ).withColumn("node", F.lit("n")).withColumn("_score", F.lit(1.0)).withColumn("_language", F.lit("l"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF_DIR)
        assert out.columns == odd.columns, name
        assert out.count() <= 6
        assert stage(spark, odd.where("false"), SF_DIR).count() == 0
    assert corpus_pipeline.mix_sources(spark, odd, SF_DIR).count() == 6


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_agrees_with_sql(spark, name):
    con = connect(SF_DIR)
    assert difference(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None
    con.close()


COLUMNS = {
    "op2_licenses": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op4_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op5_jaccard": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op6_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op7_ppm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op8_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_pages": "page_id bigint, url string, text string, n_chars bigint",
    "op10_mixture": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op11_codes": "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string",
    "op12_fingerprints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op13_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_registered_queries(spark, name):
    found = entry.queries()[name](spark, SF_DIR)
    types = dict(found.dtypes)
    for column in COLUMNS.get(name, "doc_id bigint").split(", "):
        wanted, kind = column.split()
        assert types[wanted] == kind, column
    table = {"op9_pages": "pages", "op11_codes": "embeddings"}.get(name, "documents")
    rows = found.count()
    if name in COLUMNS:
        assert rows == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    assert rows > 0
