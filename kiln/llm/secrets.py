"""Secret scans by dictionary-primed zstandard novelty.

Three fixed kinds are found by pattern. Beyond them, strings in a sensitive context are candidates: the marginal
size of a candidate is how many bytes it adds when the code around it is compressed with a dictionary of
identifiers. Ordinary names cost little next to their surroundings; keys cost nearly their own entropy.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.lineage import Scratch

KINDS = ("assign", "access", "hex", "novel")
# The patterns of the contract.
_ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
                     r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")

#: Words that make their surroundings sensitive, within ``REACH`` characters before a candidate.
SENSITIVE = ("password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "access_key",
             "auth", "bearer", "credential", "private_key", "private key", "signature", "session", "cookie", "jwt", "salt")
_CONTEXT = re.compile("|".join(map(re.escape, SENSITIVE)), re.IGNORECASE | re.ASCII)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_IDENTIFIER = re.compile(r"([A-Za-z_][A-Za-z0-9_]{2,63})[\"']?\x20*[:=](?![:=])")
REACH, AROUND = 48, 160
#: A candidate is reported when it adds at least this many bytes per character. Names are mostly letters alone, so one that doesn't mix
#: letters with digits has to add ``PLAIN_NOVELTY``: it compresses not at all next to its surroundings.
NOVELTY, PLAIN_NOVELTY = 0.55, 1.0
#: Most identifiers in the dictionary, by the number of documents that assign to them, each at most 64 bytes.
IDENTIFIERS = 4096


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed kinds, leftmost and non-overlapping in each kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Candidate spans in a sensitive context that no base span touches."""
    places = [m.end() for m in _CONTEXT.finditer(text)]
    starts = [s for s, _, _ in base]
    ends = list(accumulate((e for _, _, e in base), max))  # the furthest end up to each span
    out, seen = [], -1
    for place in places:
        for m in _CANDIDATE.finditer(text, max(place, seen), min(len(text), place + REACH + 16)):
            start = m.start()
            if start - place > REACH:
                break
            seen = end = _CANDIDATE.match(text, start).end()  # the whole run, past the window too
            before = bisect_left(starts, end)  # base spans that begin before the candidate ends
            touched = before > 0 and ends[before - 1] > start
            if not touched:
                out.append((start, end))
    return sorted(set(out))


class Novelty:
    """Marginal compressed size against a primed dictionary."""

    def __init__(self, identifiers: list[str]):
        words = "\n".join([*identifiers, *SENSITIVE]).encode()
        primed = zstandard.ZstdCompressionDict(words.ljust(8, b"\n"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=9)
        self._compressor = zstandard.ZstdCompressor(dict_data=primed, write_content_size=False, write_dict_id=False)

    def __call__(self, before: str, value: str, after: str) -> float:
        """Bytes that ``value`` adds, per character."""
        size = lambda x: len(self._compressor.compress(x.encode("utf-8", "surrogatepass")))
        return max(0, size(before + value + after) - size(before + after)) / len(value)


def least_novelty(value: str, novelty: float = NOVELTY, plain: float = PLAIN_NOVELTY) -> float:
    """What a candidate has to add to be reported."""
    return novelty if any(c.isdigit() for c in value) and any(c.isalpha() for c in value) else plain


def _first_pass(docs: DataFrame) -> DataFrame:
    """Base spans, candidates with what surrounds them, and identifiers, of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, found, names = [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                near = candidates(text, base)
                bases.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                found.append([{"start": s, "end": e, "before": text[max(0, s - AROUND): s], "value": text[s:e],
                               "after": text[e: e + AROUND]} for s, e in near])
                names.append(sorted(set(_IDENTIFIER.findall(text))) if ("=" in text or ":" in text) else [])
            base_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
            near_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("before", pa.string()),
                                            ("value", pa.string()), ("after", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bases, base_type), pa.array(found, near_type),
                                              pa.array(names, pa.list_(pa.string()))],
                                             names=["doc_id", "base", "near", "names"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, base array<struct<start int, kind int, end int>>, "
             "near array<struct<start int, end int, before string, value string, after string>>, names array<string>")


def scan(docs: DataFrame, identifiers: int = IDENTIFIERS, novelty: float = NOVELTY, plain: float = PLAIN_NOVELTY) -> DataFrame:
    """(doc_id, spans): one row per document, spans array<struct<start, kind, end>> in order.

    ``docs`` has doc_id and text; other columns are ignored. Offsets are code points of the whole text, ends are
    exclusive. A null or empty text has no spans; repeated rows are scanned one by one; an empty table gives no
    rows. Every run of at least 16 characters of A-Za-z0-9+/_=- in a sensitive context is measured for novelty; one that doesn't mix
    letters with digits needs ``plain`` instead of ``novelty``. The identifier dictionary counts all documents; only its
    ``identifiers`` commonest names, a bounded table, reach the tasks. Texts are read once and never shuffled.
    """
    seen = Scratch(docs.sparkSession, "secrets").write(_first_pass(docs), "first-pass")
    common = (seen.select(F.explode("names").alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "name").limit(identifiers).toArrow()["name"].to_pylist())
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Novelty(shared.value[::-1])  # the commonest last: nearest to the text
        for batch in batches:
            out = []
            for base, near in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                spans = [(x["start"], x["kind"], x["end"]) for x in base]
                spans += [(x["start"], 3, x["end"]) for x in near
                          if measure(x["before"], x["value"], x["after"]) >= least_novelty(x["value"], novelty, plain)]
                out.append([{"start": s, "kind": KINDS[k], "end": e} for s, k, e in sorted(spans)])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["doc_id", "spans"])

    return seen.select("doc_id", "base", "near").mapInArrow(
        run, "doc_id long, spans array<struct<start int, kind string, end int>>")


def digests(scanned: DataFrame) -> DataFrame:
    """Counts per fixed kind, the digest of the fixed spans and all spans as text."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select(
        "doc_id", *(count(k) for k in KINDS if k != "novel"),
        F.sha2(text(F.filter("spans", lambda s: s["kind"] != "novel")).cast("binary"), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"), count("novel"))
