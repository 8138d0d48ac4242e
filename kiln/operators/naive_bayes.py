"""Multinomial Naive Bayes as plain aggregation (M7, SQL form) and n-gram terms.

Model: ``logP(c) = ln(n_c / n)``, ``logP(t|c) = ln((N_tc + a) / (N_c + a*V))``. The model is kept sparse: only
(term, class) pairs seen in training are stored; an unseen pair contributes ``ln(a / (N_c + a*V))``. So a document
score is

    score(d, c) = logP(c) + T_d * ln(a / (N_c + a*V)) + sum_t tf * ln((N_tc + a) / a)

where ``T_d`` counts the document's in-vocabulary term occurrences. Training is one aggregation of counts made by chunks of
texts, where (document, term, tf) of the texts to be scored meet the counts of their terms; scoring is one aggregation per
document.
Classes are rows: there is no class list on the driver, no column per class and no bound on their number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kiln.functions.text import clean_text, ngrams
from kiln.lineage import Scratch
from kiln.operators.blobs import packed, unpacked
from kiln.operators.common import global_index


def cleaned_tokens(text_col: str) -> Column:
    """T1 text split on blanks."""
    return F.filter(F.split(clean_text(text_col), " "), lambda x: x != F.lit(""))


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Tokens whose n-grams are counted together, and characters of text whose counts a task of the reduction gets on average.
CHUNK_TOKENS, PART_CHARS = 1 << 17, 1 << 23


def ngram_counts(df: DataFrame, keys: list[str], tokens: Column, n_min: int = 1, n_max: int = 3, cell: str | None = None) -> DataFrame:
    """(*keys, ta, tb, held long, n array<int>): how often each key has each n-gram, in the cells that the bits of ``held`` name.

    (ta, tb) is a 96-bit id made of the words' digests, so no n-gram string is built; two of m distinct n-grams share an id
    with probability about m^2 / 2^97. ``cell`` is a column of numbers below 58 (none: all rows are in cell 0). Tasks count some texts
    that follow each other at a time, in bounded memory, so a key and term may have several rows: their counts add up. A
    row without ta and tb holds the number of all n-grams of a key.
    """
    rows = df.select(*keys, (F.col(cell) if cell else F.lit(0)).cast("long").alias("_cell"), tokens.alias("_tok"))
    kind = rows.select(*keys).schema.add("ta", "long").add("tb", "long").add("held", "long").add("n", T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(partial(_count_ngrams, n_min, n_max, [f.name for f in kind]), kind)


def _count_ngrams(n_min: int, n_max: int, names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in _gram_chunks(n_min, n_max, batches):
        yield from _count_chunk(*chunk, names)


def _gram_chunks(n_min: int, n_max: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key columns, a row of each key, then for each n-gram: ta, tb, number of its key, cell)."""
    for batch in batches:
        *keys, cell, tokens = batch.columns
        length = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.list_flatten(tokens).dictionary_encode()
        words, code = word_ids(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)
        places: dict[tuple, int] = {}
        owner = np.array([places.setdefault(k, len(places)) for k in zip(*(c.to_pylist() for c in keys), strict=True)], np.int64)
        first = np.unique(owner, return_index=True)[1]
        cells, ends = cell.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(length)
        cuts = np.flatnonzero(np.diff((ends - 1) // CHUNK_TOKENS)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(length)], strict=True):
            part = code[ends[low] - length[low]:ends[high - 1]] if high > low else code[:0]
            if len(part):
                row = np.repeat(np.arange(low, high), length[low:high])
                ta, tb, at, _ = gram_ids(words[part], row, n_min, n_max)
                if len(ta):
                    yield keys, first, ta, tb, owner[row[at]], cells[row[at]]


def word_ids(words: pa.Array) -> np.ndarray:
    """Two numbers for each word."""
    return np.frombuffer(b"".join(hashlib.blake2b(w.encode(), digest_size=16).digest() for w in words.to_pylist()), np.uint64).reshape(-1, 2)


def gram_ids(words: np.ndarray, row: np.ndarray, n_min: int, n_max: int) -> list[np.ndarray]:
    """ta, tb, place of the first word and number of words of the n-grams of ``words`` (by ``word_ids``) that lie in one ``row``."""
    a = b = np.zeros(len(words), np.uint64)
    grams = [(a[:0], b[:0], np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for n in range(1, n_max + 1):
        m = len(words) - n + 1
        if m <= 0:
            break
        a, b = _mix(a[:m] + words[n - 1:, 0] + np.uint64(n)), _mix((b[:m] ^ words[n - 1:, 1]) + np.uint64(n))
        at = np.flatnonzero(row[:m] == row[n - 1:])  # n-grams end with their text
        if n >= n_min and len(at):
            grams.append((a[at], b[at] >> np.uint64(32), at, np.full(len(at), n)))
    return [np.concatenate(x) for x in zip(*grams, strict=True)]


def _count_chunk(keys, first, ta, tb, own, cell, names) -> Iterator[pa.RecordBatch]:
    # equal terms of a key come together, by cell; should others come between, they only have more rows
    order = np.argsort((_mix(ta ^ _mix(own.astype(np.uint64))) << np.uint64(6)) | cell.astype(np.uint64), kind="stable")
    ta, tb, own, cell = ta[order], tb[order], own[order], cell[order]
    starts = np.ones(len(ta), bool)
    starts[1:] = (ta[1:] != ta[:-1]) | (tb[1:] != tb[:-1]) | (own[1:] != own[:-1])
    runs = starts.copy()
    runs[1:] |= cell[1:] != cell[:-1]
    start, run = np.flatnonzero(starts), np.flatnonzero(runs)
    counts = _count_rows(keys, first[own[start]], ta[start], tb[start], np.searchsorted(run, start), cell[run], np.diff(run, append=len(ta)), names)
    # rows of a key and of the same cells follow each other: the shuffle then compresses all but their ids
    yield counts.take(pa.array(np.lexsort((counts.column(len(keys) + 2).to_numpy(), own[start]))))
    total = np.unique(np.stack([own, cell]), axis=1, return_counts=True)
    whole = np.flatnonzero(np.diff(total[0][0], prepend=-1))
    yield _count_rows(keys, first[total[0][0][whole]], None, None, whole, total[0][1], total[1], names)


def _count_rows(keys, at, ta, tb, starts, cell, n, names) -> pa.RecordBatch:
    ids = [pa.nulls(len(at), pa.int64()) if x is None else pa.array(x.view(np.int64)) for x in (ta, tb)]
    held = np.bitwise_or.reduceat(np.int64(1) << cell, starts)
    counts = pa.ListArray.from_arrays(pa.array([*starts, len(n)], pa.int32()), pa.array(n, pa.int32()))
    return pa.RecordBatch.from_arrays([*(k.take(pa.array(at)) for k in keys), *ids, pa.array(held), counts], names=names)


#: Counts that a task gathers before it packs them, and occurrences that a packed number holds for certain.
WAITING, MOST = 1 << 22, 1 << 31


def packed_counts(df: DataFrame, key: str, tokens: Column, parts: int, n_min: int = 1, n_max: int = 3, cell: str | None = None) -> DataFrame:
    """(part int, keys array, data binary): the counts of ``ngram_counts`` for one key, for a shuffle by part.

    An id has 80 bits here (two of m distinct n-grams share one with probability about m^2 / 2^81), and its first bits name its
    part. A task adds up the counts of many chunks, puts the ids of a part in order and packs their differences, so an n-gram takes
    about half the bytes of a row. ``_unpacked`` reads a row's data; key numbers in it are places in ``keys``.
    """
    rows = df.select(F.col(key).alias("_key"), (F.col(cell) if cell else F.lit(0)).cast("long").alias("_cell"), tokens.alias("_tok"))
    kind = T.StructType().add("part", "integer").add("keys", T.ArrayType(rows.schema["_key"].dataType)).add("data", "binary")
    return rows.mapInArrow(partial(_pack_ngrams, n_min, n_max, parts), kind)


def _pack_ngrams(n_min: int, n_max: int, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting, places, kind, seen = [], {}, None, 0
    for (key,), first, ta, tb, own, cell in _gram_chunks(n_min, n_max, batches):
        code = np.array([places.setdefault(v, len(places)) for v in key.take(pa.array(first)).to_pylist()], np.int32)
        waiting.append(_added(ta, (tb >> np.uint64(16)).astype(np.uint16), code[own], cell.astype(np.int8), np.ones(len(ta), np.uint32)))
        kind, seen = key.type, seen + len(ta)
        if sum(len(w[0]) for w in waiting) >= WAITING or seen >= MOST:
            yield _packed(waiting, pa.array(list(places), kind), parts)
            waiting, places, seen = [], {}, 0
    if waiting:
        yield _packed(waiting, pa.array(list(places), kind), parts)


def _order(ta: np.ndarray, low: np.ndarray | None = None) -> np.ndarray:
    """Places in order of the first bits of ``ta``, then of ``low``, then as they are: one sort of plain numbers, in which a place has the last bits."""
    place = max(1, (len(ta) - 1).bit_length())
    rest = place + (int(low.max()).bit_length() if low is not None and len(low) else 0)
    if rest > 40:  # too few bits of ta would be left
        return np.lexsort((ta,) if low is None else (low, ta))
    order = (ta >> np.uint64(rest) << np.uint64(rest)) | np.arange(len(ta), dtype=np.uint64)
    if low is not None:
        order |= low.astype(np.uint64) << np.uint64(place)
    order.sort()
    return (order & np.uint64((1 << place) - 1)).astype(np.int64)


def exact_order(ta: np.ndarray, tb: np.ndarray) -> np.ndarray:
    """Places with equal (ta, tb) next to each other, in order of them where the first bits of ta are equal."""
    order = _order(ta)
    a, b = ta[order], tb[order]
    same = np.zeros(len(a), bool)  # as the row before by the bits in order, but perhaps not whole
    bits = np.uint64(max(1, (len(a) - 1).bit_length()))
    same[1:] = a[1:] >> bits == a[:-1] >> bits
    odd = np.flatnonzero(same[1:] & ((a[1:] != a[:-1]) | (b[1:] != b[:-1]))) + 1
    if len(odd):
        run = np.cumsum(~same)
        at = np.flatnonzero(np.isin(run, run[odd]))
        order[at] = order[at[np.lexsort((b[at], a[at], run[at]))]]
    return order


def _added(ta, tb, own, cell, n) -> tuple[np.ndarray, ...]:
    """Counts of equal ids, keys and cells added up, in order of ta, key and cell; should equal ids not be neighbours, they only have more counts."""
    cells = int(cell.max()) + 1 if len(cell) else 1
    order = _order(ta, own.astype(np.int64) * cells + cell)
    ta, tb, own, cell = ta[order], tb[order], own[order], cell[order]
    at = np.flatnonzero(changes(ta, tb, own, cell))
    return ta[at], tb[at], own[at], cell[at], np.add.reduceat(n[order], at).astype(np.uint32)


def changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _packed(waiting: list[tuple], keys: pa.Array, parts: int) -> pa.RecordBatch:
    ta, tb, own, cell, n = _added(*map(np.concatenate, zip(*waiting, strict=True))) if len(waiting) > 1 else waiting[0]
    row = np.flatnonzero(changes(ta, tb, own))
    held, ends = np.bitwise_or.reduceat(np.int64(1) << cell.astype(np.int64), row), np.append(row[1:], len(ta))
    ta, tb, own = ta[row], tb[row], own[row]
    part = ((ta >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(changes(part))
    found, data = [], []
    for low, high in zip(cuts, np.append(cuts[1:], len(part)), strict=True):
        used, local = np.unique(own[low:high], return_inverse=True)
        found.append(used)
        planes = [np.diff(ta[low:high], prepend=np.uint64(0)), tb[low:high], local.astype(np.uint32), held[low:high], n[row[low]:ends[high - 1]]]
        data.append(packed(planes))
    lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), keys.take(pa.array(np.concatenate(found))))
    return pa.RecordBatch.from_arrays([pa.array(part[cuts], pa.int32()), lists, pa.array(data, pa.binary())], names=["part", "keys", "data"])


def _unpacked(data: bytes) -> list[np.ndarray]:
    """ta, tb, place of the key, held, and the counts of the held cells, row by row."""
    steps, *others = unpacked(data, [np.uint64, np.uint16, np.uint32, np.int64, np.uint32])
    return [np.cumsum(steps, dtype=np.uint64), *others]


def _meet(cells: int, schema: pa.Schema, table: pa.Table) -> pa.Table:
    """The counts of a part: rows of kind 0 say how many terms are ``held`` by a set of cells, those of kind 1 are a text's terms that were seen
    in training with their counts per class and cell, that of kind 2 has the sum of all counts per class and cell."""
    classes: dict = {}
    seen, asked, ids = [], [], []
    for cls, its, data in zip(*(table.column(c).to_pylist() for c in ("cls", "ids", "data")), strict=True):
        ta, tb, own, held, n = _unpacked(data)
        if its is None:
            seen.append((ta, tb, np.array([classes.setdefault(c, len(classes)) for c in cls], np.int64)[own], held, n))
        else:
            asked.append((ta, tb, own.astype(np.int64) + len(ids), n))
            ids += its
    if not seen:
        return schema.empty_table()
    ta, tb, own, held, n = map(np.concatenate, zip(*seen, strict=True))
    counted = np.bitwise_count(held).astype(np.int64)
    start = np.cumsum(counted) - counted

    def cell_counts(rows, k: int) -> np.ndarray:
        here, bit = held[rows], np.int64(1) << np.int64(k)
        at = start[rows] + np.bitwise_count(here & (bit - np.int64(1)))
        return np.where(here & bit != 0, n[np.minimum(at, len(n) - 1)].astype(np.int64), 0)

    # terms are numbered together with those asked for
    want = list(map(np.concatenate, zip(*asked, strict=True))) if asked else [ta[:0], tb[:0], own[:0], n[:0]]
    all_a, all_b = np.concatenate([ta, want[0]]), np.concatenate([tb, want[1]])
    order = exact_order(all_a, all_b)
    new = changes(all_a[order], all_b[order])
    term = np.empty(len(order), np.int64)
    term[order] = np.cumsum(new) - 1
    cells_of = np.bitwise_or.reduceat(np.concatenate([held, np.zeros(len(want[0]), np.int64)])[order], np.flatnonzero(new))
    term, wanted = term[:len(ta)], term[len(ta):]
    sets, terms = np.unique(cells_of[cells_of != 0], return_counts=True)
    mass = np.stack([np.bincount(own, cell_counts(slice(None), k), len(classes)).astype(np.int64) for k in range(cells)], 1)
    # the counts of the terms asked for, by term and class
    is_asked = np.zeros(len(cells_of), bool)
    is_asked[wanted] = True
    rows = np.flatnonzero(is_asked[term])
    rows = rows[np.lexsort((own[rows], term[rows]))]
    at = np.flatnonzero(changes(term[rows], own[rows]))
    dense = np.stack([np.add.reduceat(cell_counts(rows, k), at) if len(at) else at for k in range(cells)], 1)
    rows = rows[at]
    names = pa.array(list(classes), schema.field("classes").type.value_type.field("cls").type)

    def lists(offsets, own, dense) -> pa.Array:
        n = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * cells, pa.int32()), pa.array(dense.ravel(), pa.int64()))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([names.take(pa.array(own)), n], ["cls", "n"]))

    one = np.flatnonzero(changes(term[rows]))
    place = np.full(len(cells_of), -1, np.int64)
    place[term[rows[one]]] = np.arange(len(one))
    hit = np.flatnonzero(place[wanted] >= 0)
    by_term = lists([*one, len(rows)], own[rows], dense).take(pa.array(place[wanted[hit]]))
    owners = pa.array(ids, schema.field("id").type).take(pa.array(want[2][hit]))

    def made(kind: int, m: int, **columns) -> pa.Table:
        columns["kind"] = pa.array(np.full(m, kind), pa.int32())
        return pa.table([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(m, f.type) for f in schema], schema=schema)

    return pa.concat_tables([made(0, len(sets), held=pa.array(sets), n=pa.array(terms, pa.int64())),
                             made(1, len(hit), id=owners, n=pa.array(want[3][hit].astype(np.int64)), classes=by_term),
                             made(2, 1, classes=lists([0, len(classes)], np.arange(len(classes)), mass))])


def _hit_sums(fits: list, cells: int, alpha: float, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(config, id, _t, _s) of the hits (id, tf, classes), in order of id: the number of a text's terms that a configuration has, and
    per class the sum of tf * ln((n + alpha) / alpha). The sums of a text wait for the next batch, not its hits."""
    member = np.zeros((cells, len(fits)))
    for j, (_, held) in enumerate(fits):
        np.add.at(member[:, j], [k for k in held if 0 <= k < cells], 1)
    configs, codes, rest = pa.array([c for c, _ in fits], schema.field("config").type), {}, None

    def made(ids: pa.Array, t: np.ndarray, own: np.ndarray, cls: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
        # the classes of a text follow each other
        text, config = np.nonzero(t > 0)
        starts = np.searchsorted(own, np.arange(len(ids) + 1))
        size = np.diff(starts)[text]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - starts[text], size)
        names = pa.array(list(codes), schema.field("_s").type.value_type.field("cls").type).take(pa.array(cls[at]))
        lists = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.StructArray.from_arrays([names, pa.array(s[at, np.repeat(config, size)])], ["cls", "s"]))
        columns = [configs.take(pa.array(config)), ids.take(pa.array(text)), pa.array(t[text, config]), lists]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for batch in batches:
        ids, tf, classes = batch.columns
        if not len(ids):
            continue
        code = ids.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        new = changes(code)
        first, own = np.flatnonzero(new), np.cumsum(new) - 1
        ids, tf = ids.take(pa.array(first)), tf.to_numpy(zero_copy_only=False).astype(np.float64)
        # each hit has classes
        row, flat = np.repeat(np.arange(len(tf)), pc.list_value_length(classes).to_numpy(zero_copy_only=False)), pc.list_flatten(classes)
        named = flat.field("cls").dictionary_encode(null_encoding="encode")
        known = np.array([codes.setdefault(c, len(codes)) for c in named.dictionary.to_pylist()], np.int64)
        cls = known[named.indices.to_numpy(zero_copy_only=False)]
        n = pc.list_flatten(flat.field("n")).to_numpy(zero_copy_only=False).reshape(-1, cells) @ member
        has = np.add.reduceat(n, np.flatnonzero(changes(row)), axis=0) > 0
        t = np.add.reduceat(tf[:, None] * has, first, axis=0)
        s, own = tf[row, None] * np.log((n + alpha) / alpha), own[row]
        if rest is not None:
            if len(pc.unique(pa.concat_arrays([rest[0], ids.slice(0, 1)]))) == 1:
                t[0] += rest[1][0]
            else:
                ids, t, own = pa.concat_arrays([rest[0], ids]), np.concatenate([rest[1], t]), own + 1
            own, cls, s = np.concatenate([rest[2], own]), np.concatenate([rest[3], cls]), np.concatenate([rest[4], s])
        order = np.lexsort((cls, own))
        own, cls = own[order], cls[order]
        at = np.flatnonzero(changes(own, cls))
        own, cls, s = own[at], cls[at], np.add.reduceat(s[order], at, axis=0) if len(at) else s
        last = np.searchsorted(own, len(ids) - 1)
        if len(ids) > 1:
            yield made(ids.slice(0, len(ids) - 1), t[:-1], own[:last], cls[:last], s[:last])
        rest = ids.slice(len(ids) - 1), t[-1:], own[last:] - (len(ids) - 1), cls[last:], s[last:]
    if rest is not None:
        yield made(*rest)


def term_occurrences(df: DataFrame, keys: list[str], tokens: Column, n_min: int = 1, n_max: int = 3) -> DataFrame:
    """One row per n-gram occurrence: (*keys, term)."""
    # tokens get their own projection: the n-gram lambdas then read a plain
    # column instead of re-running the regex chain per element
    toks = df.select(*keys, tokens.alias("_tok"))
    return toks.select(*keys, F.explode(ngrams(F.col("_tok"), n_min, n_max)).alias("term"))


def term_counts(df: DataFrame, key: str, tokens: Column, n_min: int = 1, n_max: int = 3) -> DataFrame:
    """(key, term, n long): how often the texts of a key have each n-gram. Tasks count some texts that follow each other at a
    time and make one string for each n-gram of those, so a key and term may have several rows: their counts add up."""
    rows = df.select(key, tokens.alias("_tok"))
    kind = rows.select(key).schema.add("term", "string").add("n", "long")
    return rows.mapInArrow(partial(_count_terms, n_min, n_max, kind.names), kind)


def _count_terms(n_min: int, n_max: int, names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = np.flatnonzero(np.diff((np.cumsum(length) - 1) // (4 * CHUNK_TOKENS))) + 1
        for low, high in zip([0, *cuts], [*cuts, len(length)], strict=True):
            yield from _count_part(batch.slice(low, high - low), length[low:high], n_min, n_max, names)


def _count_part(part: pa.RecordBatch, length: np.ndarray, n_min: int, n_max: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    keys, coded = part.column(0), pc.list_flatten(part.column(1)).dictionary_encode()
    code, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    places: dict = {}
    owner = np.array([places.setdefault(k, len(places)) for k in keys.to_pylist()], np.int64)
    first = np.unique(owner, return_index=True)[1]
    text, gram = np.repeat(np.arange(len(length)), length), code
    for n in range(1, n_max + 1):
        m = len(code) - n + 1
        if m <= 0:
            return
        if n > 1:
            gram = np.unique(gram[:m] * len(words) + code[n - 1:], return_inverse=True)[1]
        at = np.flatnonzero(text[:m] == text[n - 1:])  # n-grams end with their text
        if n >= n_min and len(at):
            _, shown, counts = np.unique(owner[text[at]] * (gram.max() + 1) + gram[at], return_index=True, return_counts=True)
            at = at[shown]
            parts = [words.take(pa.array(code[at + k])) for k in range(n)]
            terms = pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(first[owner[text[at]]])), terms, pa.array(counts, pa.int64())], names=names)


def fit_predict(train: DataFrame, test: DataFrame, id_col: str, text_col: str, label_col: str, alpha: float = 0.1,
                n_min: int = 1, n_max: int = 3, tokens: Column | None = None, prior: float = 0.0) -> DataFrame:
    """Fit on (label, text) of ``train`` and predict ``test`` (id, text, ...); its text is dropped. Rows without a label teach
    nothing. ``tokens`` are by default the words of the cleaned text; ``prior`` is added to the texts of every class."""
    tokens = cleaned_tokens(text_col) if tokens is None else tokens
    one = train.sparkSession.createDataFrame([(0, [0])], "config int, members array<int>")
    texts = train.where(F.col(label_col).isNotNull()).withColumn("cell", F.lit(0))
    return cell_predictions(texts, test, one, 1, id_col, text_col, label_col, tokens, alpha, n_min, n_max, prior, bare=True).drop(text_col, "config")


def cell_predictions(texts: DataFrame, test: DataFrame, configs: DataFrame, cells: int, id_col: str, text_col: str, label_col: str,
                     tokens: Column, alpha: float, n_min: int = 1, n_max: int = 3, prior: float = 0.0, bare: bool = False) -> DataFrame:
    """``test`` (id, ...) with config and prediction: one fit per configuration, all by the same jobs; ties go to the smallest class.

    ``texts`` (cell, label, text) are the training texts, each in one of ``cells`` disjoint cells; ``configs`` (config,
    members array<int>) says which cells a configuration trains on. Counts of the training texts meet the terms of the
    test texts in one shuffle by term, packed. What leaves it is the size of the vocabulary by the cells that a term occurs in, and the
    counts of those terms only that a test text has: the others enter a score by their number alone. A term enters it once per class
    and many chunks of texts, so no term makes that shuffle uneven. With ``bare`` a configuration without any term predicts by its priors;
    otherwise it has no rows.
    """
    work = Scratch(texts.sparkSession, "naive-bayes")
    spark, a = texts.sparkSession, F.lit(float(alpha))
    plans = work.write(configs.select("config", "members"), "configs")
    chars = texts.select(text_col).unionByName(test.select(text_col)).agg(F.sum(F.length(text_col))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // PART_CHARS))
    seen = packed_counts(texts, label_col, tokens, parts, n_min, n_max, "cell").withColumnRenamed("keys", "cls")
    asked = packed_counts(test.where(F.col(id_col).isNotNull()), id_col, tokens, parts, n_min, n_max).withColumnRenamed("keys", "ids")
    label, key = seen.schema["cls"].dataType.elementType, asked.schema["ids"].dataType.elementType
    counts = T.ArrayType(T.StructType().add("cls", label).add("n", T.ArrayType(T.LongType())))
    kind = T.StructType().add("kind", "integer").add("id", key).add("held", "long").add("n", "long").add("classes", counts)
    schema = to_arrow_schema(kind)

    def met(table):
        return _meet(cells, schema, table)

    terms = seen.unionByName(asked, allowMissingColumns=True).repartition(parts, "part").groupBy("part").applyInArrow(met, kind)
    terms = work.write(terms, "terms", "zstd")

    def chosen(n: Column) -> Column:
        return F.aggregate("members", F.lit(0).cast("long"), lambda s, k: s + F.get(n, k))

    # totals per class and cell, and the vocabulary size per set of cells that a term occurs in
    mass = (terms.where("kind = 2").select(F.explode("classes").alias("c")).groupBy("c.cls")
            .agg(F.array(*[F.sum(F.get("c.n", F.lit(k))) for k in range(cells)]).alias("mass")))
    docs = texts.groupBy(F.col(label_col).alias("cls")).agg(F.array(*[
        F.sum(F.when(F.col("cell") == k, 1).otherwise(0)).cast("long") for k in range(cells)]).alias("docs"))
    shapes = terms.where("kind = 0").groupBy("held").agg(F.sum("n").alias("terms"))
    bits = F.aggregate("members", F.lit(0).cast("long"), lambda s, k: s + F.pow(F.lit(2.0), k).cast("long"))
    size = (plans.crossJoin(shapes).where(F.col("held").bitwiseAND(bits) != 0)
            .groupBy("config").agg(F.sum("terms").alias("v")))
    classes = (plans.crossJoin(docs.join(mass, "cls", "left")).join(size, "config", "left" if bare else "inner")
               .select("config", "cls", F.coalesce("v", F.lit(0)).cast("double").alias("v"), chosen(F.col("docs")).alias("d"),
                       F.coalesce(chosen(F.col("mass")), F.lit(0)).alias("m")).where("d > 0"))
    total = Window.partitionBy("config")
    weight = F.col("m") + a * F.col("v")
    classes = classes.select("config", F.struct(
        "cls", F.log((F.col("d") + prior) / (F.sum("d").over(total) + prior * F.count(F.lit(1)).over(total))).alias("prior"),
        F.when(weight > 0, F.log(a / weight)).otherwise(F.lit(0.0)).alias("miss")).alias("c"))
    heads = work.write(classes.groupBy("config").agg(F.array_sort(F.collect_list("c")).alias("all")), "classes")
    # dealt by text: its counts are read once for all configurations, which are few numbers
    fits = [(r["config"], r["members"]) for r in plans.collect()]
    hits = terms.where("kind = 1").select("id", F.col("n").alias("tf"), "classes").repartition("id").sortWithinPartitions("id")
    kind = (T.StructType().add("config", plans.schema["config"].dataType).add("id", key).add("_t", "double")
            .add("_s", T.ArrayType(T.StructType().add("cls", label).add("s", "double"))))
    sums = (hits.mapInArrow(partial(_hit_sums, fits, cells, float(alpha), to_arrow_schema(kind)), kind)
            .select("config", F.col("id").alias(id_col), "_t", F.map_from_entries("_s").alias("_s")))
    base = test.drop(text_col).join(F.broadcast(heads), F.lit(True), "left" if bare else "inner")
    scored = base.join(sums, ["config", id_col], "left")
    best = F.array_max(F.transform("all", lambda c, i: F.struct(
        (c["prior"] + F.coalesce("_t", F.lit(0.0)) * c["miss"]
         + F.coalesce(F.try_element_at("_s", c["cls"]), F.lit(0.0))).alias("score"), (-i).alias("i"), c["cls"].alias("cls"))))
    return scored.withColumn("prediction", best["cls"]).drop("_t", "_s", "all")


def parameter_search(docs: DataFrame, id_col: str, text_col: str, label_col: str, held_out: Column, trials: list[dict],
                     n_min: int = 1, n_max: int = 2) -> DataFrame:
    """M8: (trial, alpha, max_features, accuracy): every trial fitted on the rows that are not held out, scored on the others.

    Texts are tokenised once for all trials: terms of the fitted texts are counted by class in the task that has the texts, those of
    the others by document. Terms that occur as often as the last one of the largest vocabulary, or more, are ranked once by their
    number of occurrences (ties in the order of the terms). The vocabulary of a trial is a prefix of that ranking, its class
    masses are sums over the prefix, and its alpha only enters the formula. So trials are rows that meet the
    hits of the held-out documents, and neither the vocabulary nor a class matrix leaves the tasks. Held-out rows without a
    label are not scored; without any hit a document gets the class with the greatest prior.
    """
    spark = docs.sparkSession
    work = Scratch(spark, "parameter-search")
    table = F.broadcast(spark.createDataFrame([(n, float(t["alpha"]), int(t["max_features"])) for n, t in enumerate(trials)],
                                              "trial int, alpha double, max_features int"))
    most = max(int(t["max_features"]) for t in trials)
    rows = docs.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("cls"), held_out.alias("held"), text_col)
    found = (term_counts(rows.where("NOT held"), "cls", cleaned_tokens(text_col), n_min, n_max).repartition("term")
             .groupBy("term", "cls").agg(F.sum("n").alias("n"))
             .groupBy("term").agg(F.sum("n").alias("total"), F.collect_list(F.struct("cls", "n")).alias("classes")))
    found = work.write(found, "found")
    # a row per number of occurrences; the terms above the one that fills the largest vocabulary are put in order
    steps = found.groupBy("total").agg(F.count(F.lit(1)).alias("n")).withColumn("n", F.sum("n").over(Window.orderBy(F.desc("total"))))
    least = steps.agg(F.coalesce(F.max(F.when(F.col("n") >= most, F.col("total"))), F.lit(0)).alias("_least"))
    asked = found.join(F.broadcast(least), F.col("total") >= F.col("_least")).drop("_least")
    terms = work.write(global_index(asked, [F.desc("total"), "term"], out="place").where(F.col("place") <= most)
                       .select("term", "place", "classes"), "terms")
    counts = (term_occurrences(rows.where("held"), ["id"], cleaned_tokens(text_col), n_min, n_max)
              .groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf")))
    # class masses and vocabulary of each trial, from the counts of its prefix
    prefix = terms.join(table, F.col("place") <= F.col("max_features"))
    size = prefix.groupBy("trial").agg(F.count(F.lit(1)).alias("v"))
    mass = prefix.select("trial", F.explode("classes").alias("c")).groupBy("trial", F.col("c.cls").alias("cls")).agg(F.sum("c.n").alias("mass"))
    fitted = rows.where("NOT held").groupBy("cls").agg(F.count(F.lit(1)).alias("docs"))
    priors = fitted.crossJoin(fitted.agg(F.sum("docs").alias("all")))
    model = work.write(
        priors.crossJoin(table).join(mass, ["trial", "cls"], "left").join(size, "trial", "left")
        .select("trial", "cls", F.log(F.col("docs") / F.col("all")).alias("prior"),
                F.log(F.col("alpha") / (F.coalesce("mass", F.lit(0)) + F.col("alpha") * F.coalesce("v", F.lit(0)))).alias("miss")), "model")
    hits = (counts.join(terms, "term").join(table, F.col("place") <= F.col("max_features"))
            .select("trial", "alpha", "id", "tf", F.explode(F.concat(
                "classes", F.array(F.struct(F.lit(None).cast(terms.schema["classes"].dataType.elementType["cls"].dataType).alias("cls"),
                                            F.lit(0).cast("long").alias("n"))))).alias("c")))
    gain = F.when(F.col("c.cls").isNull(), F.col("tf").cast("double")).otherwise(F.col("tf") * F.log((F.col("c.n") + F.col("alpha")) / F.col("alpha")))
    sums = hits.groupBy("trial", "id", F.col("c.cls").alias("cls")).agg(F.sum(gain).alias("s"))
    sums = work.write(sums, "sums")
    truth = rows.where("held").select("id", F.col("cls").alias("truth"))
    scored = (truth.join(model).join(sums.where("cls IS NOT NULL"), ["trial", "id", "cls"], "left")
              .join(sums.where("cls IS NULL").select("trial", "id", F.col("s").alias("t")), ["trial", "id"], "left")
              .withColumn("score", F.col("prior") + F.coalesce(F.col("t") * F.col("miss"), F.lit(0.0)) + F.coalesce("s", F.lit(0.0))))
    # the greatest score, of equals the smallest class
    best = scored.groupBy("trial", "id", "truth").agg(F.min(F.struct((-F.col("score")).alias("o"), "cls")).alias("b"))
    right = best.groupBy("trial").agg(F.avg((F.col("b.cls") == F.col("truth")).cast("double")).alias("accuracy"))
    return table.join(right, "trial", "left").select("trial", "alpha", "max_features", "accuracy")
