"""Best-fit packing by bin completion with branch and bound.

Only documents longer than a sequence are cut, so packing places whole pieces. Pieces are dealt by hash into hands of
bounded size and each hand is packed as a multiset of lengths. A bin is opened with the largest piece that waits, and the
undominated fillings of the rest are its branches: a filling is dominated when a waiting piece could replace some of its
pieces and fill more. Best-fit decreasing gives the first incumbent. A branch is given up as soon as the room it has
wasted leaves no chance of fewer bins than the incumbent has. The search ends at the lower bound, or after ``NODES`` bins.

Hands waste a little room each; sequences that are left emptier than ``OPEN_FILL`` are taken apart and dealt again, once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.lineage import Scratch
from kiln.llm.packing import byte_bpe

LENGTH = 2048
END_ID = 0
#: Pieces of a hand on average.
HAND = 4096
#: Bins opened by one hand's search before the incumbent is taken.
NODES = 4000
#: Fillings kept as branches of one bin.
BRANCHES = 4
#: Sequences of the first deal that are filled less are dealt again.
OPEN_FILL = 0.98


def lower_bound(counts: np.ndarray) -> int:
    """Martello and Toth's bound L2 on the bins for ``counts[length]`` pieces: pieces over half need a bin each, and those of
    at least k what room the bins of pieces up to ``capacity - k`` leave."""
    capacity = len(counts) - 1
    sizes = np.arange(len(counts))
    pieces, room = np.cumsum(counts), np.cumsum(counts * sizes)
    most, half = pieces[-1], capacity // 2
    best = -(-int(room[-1]) // capacity)
    for k in range(1, half + 1):
        huge = most - pieces[capacity - k]
        large = pieces[capacity - k] - pieces[half]
        filled = room[capacity - k] - room[half] + room[half] - room[k - 1]
        best = max(best, int(huge + large + max(0, -(-int(filled - large * capacity) // capacity))))
    return best


def best_fit(counts: np.ndarray) -> list[tuple[int, ...]]:
    """Best-fit decreasing: each piece, largest first, into the fullest bin that has room."""
    capacity = len(counts) - 1
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = np.zeros(capacity + 1, dtype=bool)
    for size in np.flatnonzero(counts)[::-1].tolist():
        for _ in range(int(counts[size])):
            fitting = int(np.argmax(rooms[size:])) + size
            if rooms[fitting]:
                at = by_room[fitting].pop()
                rooms[fitting] = bool(by_room[fitting])
                bins[at].append(size)
                room = fitting - size
            else:
                at, room = len(bins), capacity - size
                bins.append([size])
            by_room[room].append(at)
            rooms[room] = room > 0
    return [tuple(b) for b in bins]


def _copies(reach: int, size: int, count: int, room: int) -> int:
    """Sums up to ``room`` (as bits) of ``reach`` and at most ``count`` pieces of one size."""
    count, part, mask = min(count, room // size), 1, (1 << (room + 1)) - 1
    while count > 0:
        part = min(part, count)
        reach |= (reach << part * size) & mask
        count, part = count - part, part * 2
    return reach


def dominated(filling: tuple[int, ...], slack: int, sizes: list[int], counts: np.ndarray) -> bool:
    """Whether a piece that waits beside the filling could take the place of some of its pieces, or of none, and fill more, or
    stand alone for several of the same sum."""
    one = several = 0
    for size in filling:  # sums of one piece, and of two and more
        several |= (one | several) << size
        one |= 1 << size
    some = 1 | one | several
    for size in sizes:
        if counts[size] > filling.count(size):
            span = (some >> max(size - slack, 0)) & ((1 << min(slack, size)) - 1)
            if span or several >> size & 1:
                return True
    return False


def fillings(room: int, counts: np.ndarray, below: np.ndarray) -> list[tuple[int, tuple[int, ...]]]:
    """The best undominated fillings (waste, pieces, largest first) of ``room``: least waste first, of equals those with the
    largest pieces.

    Fillings of two pieces are looked at together. If none is perfect, the sums of all waiting pieces up to each size are
    worked out as bits, which gives the fullest filling for every choice of its largest piece.
    """
    first = int(below[room])
    if not first:
        return [(room, ())]
    sizes = np.flatnonzero(counts[: first + 1])
    left = room - sizes
    second = below[np.minimum(left, sizes)]
    second = np.where(counts[second] > (second == sizes), second, below[np.maximum(second - 1, 0)])
    perfect = np.flatnonzero(left == second)[::-1][:BRANCHES]
    if len(perfect):
        return [(0, tuple(x for x in (int(sizes[k]), int(second[k])) if x)) for k in perfect]
    waiting = sizes.tolist()
    reach = [1]
    for size in waiting:
        reach.append(_copies(reach[-1], size, int(counts[size]), room))
    options: list[tuple[int, int]] = []
    full = 0
    for k in range(len(waiting) - 1, -1, -1):
        rest = room - waiting[k]
        sums = _copies(reach[k], waiting[k], int(counts[waiting[k]]) - 1, room) & ((1 << (rest + 1)) - 1)
        options.append((rest + 1 - sums.bit_length(), k))
        full += options[-1][0] == 0
        if full == BRANCHES:
            break
    options.sort(key=lambda o: (o[0], -o[1]))
    out = []
    for waste, k in options[:BRANCHES]:
        pieces, rest, spared = [waiting[k]], room - waiting[k] - waste, 1
        while rest:
            size = waiting[k]
            copies = min(int(counts[size]) - spared, rest // size)
            while not reach[k] >> (rest - copies * size) & 1:
                copies -= 1
            pieces += [size] * copies
            rest, k, spared = rest - copies * size, k - 1, 0
        out.append((waste, tuple(pieces)))
    good = [f for f in out if not f[0] or not dominated(f[1], f[0], waiting, counts)]
    return good or out[:1]


def complete(counts: np.ndarray, nodes: int = NODES) -> list[tuple[tuple[int, ...], int]]:
    """Bins (pieces, how often) for ``counts[length]`` waiting pieces of length 1 to ``len(counts) - 1``.

    Depth first over the fillings of the bin that holds the largest waiting piece. Equal bins are opened at once.
    """
    capacity, total = len(counts) - 1, int((counts * np.arange(len(counts))).sum())
    if not total:
        return []
    incumbent = [(b, 1) for b in best_fit(counts)]
    fewest, least = len(incumbent), lower_bound(counts)
    waiting = counts.astype(np.int64).copy()
    below = np.maximum.accumulate(np.where(waiting > 0, np.arange(capacity + 1), 0))

    def change(pieces: tuple[int, ...], times: int) -> None:
        nonlocal below
        np.add.at(waiting, list(pieces), times)
        below = np.maximum.accumulate(np.where(waiting > 0, np.arange(capacity + 1), 0))

    opened: list[tuple[tuple[int, ...], int]] = []
    used = wasted = 0
    branches = [iter([])]

    def expand() -> Iterator[tuple[int, tuple[int, ...]]]:
        largest = int(below[-1])
        waiting[largest] -= 1
        under = np.maximum.accumulate(np.where(waiting[: capacity - largest + 1] > 0, np.arange(capacity - largest + 1), 0))
        options = fillings(capacity - largest, waiting, under)
        waiting[largest] += 1
        return iter([(waste, (largest, *pieces)) for waste, pieces in options])

    branches = [expand()]
    while branches and nodes > 0 and fewest > least:
        step = next(branches[-1], None)
        if step is None:  # all branches of this bin are done: take back the one before
            branches.pop()
            if opened:
                pieces, times = opened.pop()
                used, wasted = used - times, wasted - times * (capacity - sum(pieces))
                change(pieces, times)
            continue
        nodes -= 1
        waste, pieces = step
        # fewer bins than the incumbent's leave this much room to waste
        spare = (fewest - 1) * capacity - total - wasted
        if waste > spare:
            continue
        need = {x: pieces.count(x) for x in pieces}
        times = min(int(waiting[x]) // n for x, n in need.items())
        if waste:
            times = min(times, max(1, spare // waste))
        opened.append((pieces, times))
        used, wasted = used + times, wasted + times * waste
        change(pieces, -times)
        if below[-1] == 0:
            if used < fewest:
                incumbent, fewest = list(opened), used
            pieces, times = opened.pop()
            used, wasted = used - times, wasted - times * (capacity - sum(pieces))
            change(pieces, times)
        elif used + 1 < fewest:
            branches.append(expand())
        else:
            pieces, times = opened.pop()
            used, wasted = used - times, wasted - times * (capacity - sum(pieces))
            change(pieces, times)
    return incumbent


def place(lengths: np.ndarray, capacity: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset, tokens in that sequence) of each piece of a hand, in the order given."""
    counts = np.bincount(lengths, minlength=capacity + 1)
    order = np.argsort(lengths, kind="stable")
    following = np.searchsorted(lengths[order], np.arange(capacity + 2))[:-1]
    sequence, offset, filled = (np.zeros(len(lengths), dtype=np.int64) for _ in range(3))
    number = 0
    for pieces, times in complete(counts):
        for _ in range(times):
            at = 0
            for size in pieces:
                row = order[following[size]]
                following[size] += 1
                sequence[row], offset[row], filled[row] = number, at, sum(pieces)
                at += size
            number += 1
    return sequence, offset, filled


def cut(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): whole documents, and those longer than ``length`` in pieces of that
    length, of which the first may be shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = byte_bpe(tokenizer).encode(text.as_py() or "", allowed_special="all")
                tokens.append(end_id)
                data = np.array(tokens, dtype="<u4")
                edges = [0, *range((len(data) - 1) % length + 1, len(data) + 1, length)]
                for number, (start, end) in enumerate(zip(edges, edges[1:], strict=False)):
                    rows.append((doc_id, number, start, end - start, zlib.crc32(data[start:end].tobytes())))
                    if ids:
                        parts.append(data[start:end].astype(np.int32))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            if ids:
                arrays.append(pa.array(parts, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if ids else "")
    names = [field.split()[0] for field in kind.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kind)


def _hands(pieces: DataFrame, count: int, first: int, length: int) -> DataFrame:
    """``pieces`` with sequence_id, offset and filled, each hand packed by itself; ``first`` tells the deals apart."""
    kept = pieces.select("row", "length", F.pmod(F.xxhash64("row", F.lit(first)), F.lit(max(1, -(-count // HAND)))).alias("hand"))

    def packed(table: pa.Table) -> pa.Table:
        sequence, offset, filled = place(table["length"].to_numpy(), length)
        base = (first + table["hand"][0].as_py()) << 32
        return pa.table({"row": table["row"], "sequence_id": pa.array(base + sequence), "offset": pa.array(offset),
                         "filled": pa.array(filled)})

    return kept.groupBy("hand").applyInArrow(packed, "row long, sequence_id long, offset long, filled long")


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]): every piece with its place in a sequence.

    ``docs`` has doc_id and text; other columns are ignored. A null or empty text is the end id alone. Repeated rows are
    packed one by one, a null doc_id stays null, and an empty table gives no rows. Pieces of full length are sequences of
    their own. The pieces are written and numbered first; only (number, length) is dealt into hands, by a hash of the number,
    so no length or document can make a hand large.
    """
    work = Scratch(docs.sparkSession, "best-fit")
    pieces = work.write(cut(docs, tokenizer, length, end_id, ids).withColumn("row", F.monotonically_increasing_id()), "pieces")
    short = pieces.where(F.col("length") < length)
    dealt = work.write(_hands(short, short.count(), 1 << 20, length), "first-deal")
    poor = F.col("filled") < OPEN_FILL * length
    again = dealt.where(poor).select("row").join(short.select("row", "length"), "row")
    again = work.write(again, "again")
    placed = dealt.where(~poor).drop("filled").unionByName(_hands(again, again.count(), 1 << 21, length).drop("filled"))
    placed = work.write(placed, "places")
    work.drop("first-deal")
    work.drop("again")
    alone = pieces.where(F.col("length") >= length).withColumn("sequence_id", F.col("row")).withColumn("offset", F.lit(0).cast("long"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + (["ids"] if ids else [])
    return short.join(placed, "row").select(*columns).unionByName(alone.select(*columns))
