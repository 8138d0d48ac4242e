import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tests.llm.conftest import SMALL
from tokenizers import Tokenizer

from kiln.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", ["", " ", "a  b\n\n c\t", "don't we'll", "éß漢字😀", "<|endoftext|>x <|endoftext|>", "x" * 5000,
                                  "1234567 !!! ...", "\u200bzero\x00nul", "w " * 30_000, " \n" * 5000])
def test_ids_equal_the_tokenizers_library(reference, text):
    assert packing.token_ids(text, PATH).tolist() == reference.encode(text, add_special_tokens=False).ids + [1]


def check(rows, docs, reference, limits):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(docs)
    for doc, text in docs.items():
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            part = b"".join(x.to_bytes(4, "little") for x in ids[at:at + r.length])
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(ids)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(rows) <= limits.segments
        assert sum(r.loss_tokens for r in rows) <= limits.loss
    return sequences


def test_whole_table(spark, reference):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    limits = packing.Limits()
    sequences = check(packing.pack(docs, PATH).collect(), {r.doc_id: r.text for r in docs.collect()}, reference, limits)
    lengths = [sum(r.length for r in rows) for rows in sequences.values()]
    padding = sum(limits.tokens - n for n in lengths if n & (n - 1))
    assert padding == 0 and sum(n < limits.tokens for n in lengths) <= 11 * 4


def test_three_limits_bind(spark, reference):
    words = ["one two three " * (k % 50 + 1) for k in range(300)]
    docs = spark.createDataFrame([(k, t, len(t) // 20) for k, t in enumerate(words)], "doc_id long, text string, loss long") \
        .coalesce(2)
    for limits in (packing.Limits(256, 3, 256), packing.Limits(256, 50, 40), packing.Limits(64, 2, 16)):
        rows = packing.pack(docs, PATH, limits, loss_col="loss").collect()
        check(rows, dict(enumerate(words)), reference, limits)
        assert sum(r.loss_tokens for r in rows) == sum(len(t) // 20 for t in words)


def test_ids_column_and_edge_rows(make_docs, reference):
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (None, "no id"), (4, "long " * 20_000)]
    out = packing.pack(make_docs(rows), PATH, ids=True).collect()
    assert sorted(r.doc_id for r in out if r.length == r.doc_tokens and r.doc_id in (1, 2, 3)) == [1, 2, 3, 3]
    assert [r.ids for r in out if r.doc_id == 1] == [[1]] and any(r.doc_id is None for r in out)
    assert sum(r.length for r in out if r.doc_id == 4) == len(packing.token_ids("long " * 20_000, PATH))
    assert packing.pack(make_docs([]), PATH).collect() == []


def test_sequences_that_the_segment_limit_ends_need_no_padding(spark, reference):
    words = ["five tokens are here" if k % 3 else "one two three " * (k % 40 + 1) for k in range(600)]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string").coalesce(2)
    for limits in (packing.Limits(256, 3, 256), packing.Limits(256, 8, 100)):
        sequences = check(packing.pack(docs, PATH, limits).collect(), dict(enumerate(words)), reference, limits)
        lengths = [sum(r.length for r in rows) for rows in sequences.values()]
        assert all(n & (n - 1) == 0 for n in lengths) and any(n < limits.tokens for n in lengths)
