import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from tests.llm.conftest import MEDIUM, SMALL
from tokenizers import Tokenizer

from kiln.llm import best_fit

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def check(rows, docs, reference, length=2048):
    """Every rule of the packing but the number of sequences; returns their lengths."""
    want = Counter()
    for doc, text in docs:
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 0]
        edges = [0, *range((len(ids) - 1) % length + 1, len(ids) + 1, length)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            want[doc, piece, a, b - a, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[a:b]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length
    return [sum(size for _, size in pieces) for pieces in sequences.values()]


@lru_cache(maxsize=None)
def fewest(pieces, capacity):
    """Exact number of bins by trying every piece in every bin."""
    best = [len(pieces)]

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(pieces):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= pieces[k]:
                at = rooms.index(room)
                go(k + 1, (*rooms[:at], room - pieces[k], *rooms[at + 1:]))
        go(k + 1, (*rooms, capacity - pieces[k]))

    go(0, ())
    return best[0]


def test_bins_equal_exhaustive_search():
    rng = np.random.default_rng(7)
    harder = 0
    for _ in range(300):
        capacity = int(rng.integers(8, 40))
        pieces = np.sort(rng.integers(1, capacity + 1, rng.integers(0, 11)))[::-1]
        counts = np.bincount(pieces, minlength=capacity + 1)
        bins = best_fit.complete(counts)
        used = Counter()
        for one, times in bins:
            assert sum(one) <= capacity
            for size in one:
                used[size] += times
        assert used == Counter(pieces.tolist())
        exact = fewest(tuple(pieces.tolist()), capacity)
        assert sum(t for _, t in bins) == exact >= best_fit.lower_bound(counts)
        harder += exact < len(best_fit.best_fit(counts))
    assert harder > 0  # some where best fit alone is not enough


def test_branch_and_bound_beats_best_fit_on_triples():
    """Triples that fill a bin exactly are the hardest case: twelve are solved perfectly, forty better than by best fit."""
    for triples, perfect in ((12, True), (40, False)):
        rng = np.random.default_rng(2)
        a, b = rng.integers(260, 380, triples), rng.integers(300, 360, triples)
        counts = np.bincount(np.concatenate([a, b, 1000 - a - b]), minlength=1001)
        best, found = len(best_fit.best_fit(counts)), sum(t for _, t in best_fit.complete(counts))
        assert best > found >= triples and (found == triples or not perfect)


def test_one_length_in_great_number_is_packed_at_once():
    counts = np.zeros(2049, dtype=int)
    counts[[700, 648]] = [400_000, 200_000]
    assert sum(t for _, t in best_fit.complete(counts)) == 200_000
    assert best_fit.complete(np.zeros(11, dtype=int)) == []


def test_dominated_fillings():
    counts = np.array([0, 0, 1, 1, 2, 1, 1])
    sizes = [2, 3, 4, 5, 6]
    assert best_fit.dominated((2,), 2, sizes, counts)  # 3 or 4 fills more
    assert best_fit.dominated((2, 3), 0, sizes, counts)  # 5 stands for both
    assert not best_fit.dominated((6,), 1, sizes, np.array([0, 0, 0, 1, 0, 1, 1]))
    assert not best_fit.dominated((4, 4), 0, [4], counts)


def test_whole_table(spark, reference):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = best_fit.pack(docs, PATH).collect()
    lengths = check(rows, [(r.doc_id, r.text) for r in docs.collect()], reference)
    assert len(lengths) <= -(-sum(lengths) // 2048) + 1


def test_hands_and_second_deal(spark, reference, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    monkeypatch.setattr(best_fit, "HAND", 40)
    rows = best_fit.pack(docs, PATH, ids=True).collect()
    lengths = check(rows, [(r.doc_id, r.text) for r in docs.collect()], reference)
    assert all(len(r.ids) == r.length for r in rows)
    assert len(lengths) <= 1.1 * sum(lengths) / 2048 + 1


def test_edge_rows(make_docs, reference):
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (None, "no id"), (4, "long " * 20_000), (5, "w " * 2047), (6, "w " * 1023 + "w")]
    lengths = check(best_fit.pack(make_docs(rows), PATH).collect(), rows, reference)
    assert max(lengths) == 2048
    check(best_fit.pack(make_docs(rows), PATH, length=16).collect(), rows, reference, 16)
    assert best_fit.pack(make_docs([]), PATH).collect() == []
