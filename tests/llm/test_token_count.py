import random

import public_tokenizers
import pytest
from tests.llm.conftest import SMALL
from tokenizers import Tokenizer
from tokenizers.models import Unigram
from tokenizers.pre_tokenizers import Metaspace

from kiln.llm import catalogue, token_count

PATH = public_tokenizers.path("piece_bpe_32k.model")


def reference(vocabulary):
    """The tokenizers library's unigram model over the same pieces, on the whole text at once."""
    low = min(s for _, s in vocabulary)
    pieces = [("<unk>", low), *vocabulary, *((f"<0x{b:02X}>", low) for b in range(256))]
    model = Tokenizer(Unigram(pieces, unk_id=0, byte_fallback=True))
    model.pre_tokenizer = Metaspace(prepend_scheme="always", split=False)
    return model


@pytest.fixture(scope="module")
def full():
    return reference(token_count.vocabulary(PATH))


@pytest.mark.parametrize("text", ["a", " ", "  two  blanks ", "hello world", "tab\tand\nline\n\nend", "漢字かな 😀 ﷽", "▁raw▁mark", "naïve café",
                                  "x" * 3000, "\x00\x01", "don't, stop... 12345"])
def test_counts_equal_the_library(full, text):
    assert token_count.counter(PATH).count(text) == len(full.encode(text, add_special_tokens=False).ids)


def test_whole_table(spark, full):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    out = {r.doc_id: (r.n_chars, r.n_tokens) for r in catalogue.op2_token_count(spark, SMALL).collect()}
    assert out == {r.doc_id: (len(r.text), len(full.encode(r.text, add_special_tokens=False).ids)) for r in docs}


def test_ties_of_equal_scores():
    draw = random.Random(9)
    pieces = {"▁", "a", "b", "c"}
    while len(pieces) < 60:
        pieces.add("".join(draw.choice("▁abc") if k == 0 else draw.choice("abc") for k in range(draw.randint(2, 5))))
    vocabulary = [(p, -float(draw.randint(1, 4) * len(p))) for p in sorted(pieces)]
    library, own = reference(vocabulary), token_count.UnigramCounter(vocabulary)
    for _ in range(2000):
        text = "".join(draw.choice("abcabc  dé") for _ in range(draw.randint(1, 25)))
        assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_edge_rows(make_docs):
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (None, "x"), (4, "word " * 300_000)]
    out = sorted((str(r.doc_id), r.n_chars) for r in token_count.count_tokens(make_docs(rows), PATH).collect())
    assert out == [("1", 0), ("2", 0), ("3", 4), ("3", 4), ("4", 1_500_000), ("None", 1)]
    assert token_count.count_tokens(make_docs([]), PATH).collect() == []
