"""Each stage against a plain-Python version on its own input."""

import public_tokenizers
import pytest
from tests.llm import brute
from tests.llm.conftest import MEDIUM, SMALL
from tests.llm.test_decontaminate import expected as contained
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_packing import check
from tokenizers import Tokenizer

import corpus_pipeline
from kiln.lineage import Scratch
from kiln.llm import line_dedup, packing


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output rows of every stage over the documents table."""
    work, out = Scratch(spark, "test-pipeline"), []
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = work.write(stage(spark, docs, MEDIUM), name)
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns(steps, spark):
    columns = spark.read.parquet(f"{MEDIUM}/documents.parquet").schema
    for name, (_, after) in list(steps.items())[:-1]:
        assert [(f.name, f.dataType) for f in after.schema] == [(f.name, f.dataType) for f in columns], name


def test_language_keeps_documents_with_letters(steps):
    before, after = (texts(x) for x in steps["language_id"])
    assert all(before[k] == t for k, t in after.items())
    gone = set(before) - set(after)
    assert len(gone) <= 0.01 * len(before) and all(any(c.isalpha() for c in before[k]) for k in after)


def test_line_dedup(steps):
    before, after = (texts(x) for x in steps["line_dedup"])
    want = {r[0]: r[3] for r in brute_lines(list(before.items()), line_dedup.MIN_CHARS) if r[2] == 0 or r[3].strip()}
    assert after == want
    assert all(r.n_chars == len(r.text) for r in steps["line_dedup"][1].collect())


def test_near_dedup(steps):
    before, after = (texts(x) for x in steps["minhash_near_dup"])
    found = brute.near_duplicates(list(before.items()), 80)
    assert after == {k: before[k] for k, (_, top) in found.items() if k == top}


def test_decontaminate(steps, spark):
    before, after = (texts(x) for x in steps["decontaminate"])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()]
    bad = {r[0] for r in contained(list(before.items()), items, 80)}
    assert bad and after == {k: t for k, t in before.items() if k not in bad}


def test_pack(steps):
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    before, after = steps["pack"]
    check(after.collect(), texts(before), reference, packing.Limits())


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "offset"]
    assert rows.count() > 100


def test_edge_rows_pass_every_stage(spark):
    same = "a line that is long enough to be counted as a repeated run of lines"
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (None, same, None, None, None), (3, same, "en", "s", 5), (3, same, "en", "s", 5),
            (4, "1234 !!", "en", "s", 7), (5, "word " * 50_000, "en", "s", 9)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
        work = Scratch(spark, "test-edges")
        for name, stage in corpus_pipeline.STAGES:
            docs = work.write(stage(spark, docs, SMALL), name)
        assert (docs.count() > 0) == bool(data)


def test_one_row_stays_of_repeated_and_null_ids(spark):
    text = " ".join(f"word{k}" for k in range(60))
    other = " ".join(f"other{k}" for k in range(60))
    rows = [(None, text)] * 3 + [(7, text)] * 2 + [(5, text + " more")] * 2 + [(9, other)] * 2 + [(3, None), (3, None), (None, other[:90])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    after = corpus_pipeline.dedup_documents(spark, Scratch(spark, "test-copies").write(docs, "docs"), SMALL)
    assert sorted(map(str, ((r.doc_id, r.text) for r in after.collect()))) == sorted(
        map(str, [(5, text + " more"), (9, other), (3, None), (3, None), (None, other[:90])]))
