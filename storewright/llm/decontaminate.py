"""Benchmark passages in documents: q-gram lemma filter in diagonal bands, then banded alignment.

Texts are compared lower-cased with white space runs as one blank, as UTF-8
bytes. A passage of m bytes occurs when some part of a document is within k
edits of the whole of it, k = min(rate * m, what the lemma allows). Such a part
shares at least t = m - q + 1 - k * q of the passage's q-grams, on diagonals
that differ by at most k. Shared q-grams are counted in bands of 2 (k + 1)
diagonals that overlap by half; bands with t or more are verified. Of any s of the
passage's q-grams at least s - k * q are shared, so q-grams that many places of
the benchmark have, as of a common template, are left out of the index as long
as more than k * q others are there; they are counted only in the bands that
reach the rest. Results are the same. A passage of fewer than q bytes occurs where its bytes do, neither beginning nor ending
within a word (letters, marks, digits, underscore).

Distinct passages are dealt to written parts of about ``part_bytes`` bytes; their
item ids stay in a written side table that is joined to what was found. A
benchmark of one part, the usual size, goes to the tasks with the code. Parts
beyond that never reach the driver: the documents are written in chunks, and each
chunk meets one part after the other, as rows of a task.

Defined results: a null or empty text holds nothing; passages that are null or
empty take no part; a repeated passage is reported for each item id; null ids
are kept; positions are those of the compared bytes.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from storewright.llm.chunks import Chunk, ragged, write_chunks
from storewright.llm.workers import releasing
from storewright.session import shared_folder

FOUND = "doc_id long, passage long, start long, end long, distance int"
PARTS = "part long, texts array<string>"
MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
FILTER_BITS = 22
SLICE_BYTES = 2_000_000
OFTEN = 16  # a q-gram in more places of a part is looked up only where the lemma needs it
ENTRIES = 2_000_000  # shared q-grams that are expanded at a time
COMPARED = 4_000_000  # places of a band in which the left out q-grams are counted before it is aligned


@dataclass(frozen=True)
class LeakSpec:
    q: int = 12
    rate: float = 0.05
    part_bytes: int = 8_000_000


def compared(text: str | None) -> bytes:
    return " ".join((text or "").lower().split()).encode("utf-8", "surrogatepass")


@lru_cache(maxsize=1)
def _in_words() -> np.ndarray:
    """Code point -> whether it belongs to a word."""
    return np.array([unicodedata.category(chr(c))[0] in "LMN" or c == 95 for c in range(0x110000)], bool)


def within_words(data: bytes) -> np.ndarray:
    """Per byte, and for the end, whether the characters before and at it belong to one word."""
    codes = np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
    word = _in_words()[codes]
    sizes = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
    out = np.zeros(len(data) + 1, bool)
    out[np.cumsum(sizes)[:-1]] = word[:-1] & word[1:]
    return out


def ends_of_grams(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last up to eight bytes of the n bytes at every position, n up to 16, as numbers."""
    count = max(0, len(data) - n + 1)
    padded = data + bytes(16)
    eight = np.empty(len(data) + 1, np.uint64)
    for o in range(min(8, len(eight))):
        eight[o::8] = np.frombuffer(padded, "<u8", len(range(o, len(eight), 8)), o)
    if n < 8:
        return eight[:count] & np.uint64((1 << 8 * n) - 1), np.zeros(count, np.uint64)
    return eight[:count], eight[n - 8 : n - 8 + count]


def gram_hashes(data: bytes, q: int) -> np.ndarray:
    """A 64-bit hash of the q-gram at every position, q from 8 to 16."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    padded = data + bytes(16)
    eight = np.empty(n + q - 8, np.uint64)
    for o in range(min(8, len(eight))):
        eight[o::8] = np.frombuffer(padded, "<u8", len(range(o, len(eight), 8)), o)
    return eight[:n] * MULTIPLIERS[0] + eight[q - 8 :][:n] * MULTIPLIERS[1]


def banded_distance(pattern: np.ndarray, text: np.ndarray, low: int, high: int, k: int) -> tuple[int, int, int]:
    """Least edits of the whole pattern within the text over diagonals low..high, with start and end; k + 1 if more.

    A diagonal is text position minus pattern position. Costs and starts are
    kept together in one number, so the smaller start wins among equal costs.
    """
    whole = text.tobytes().find(pattern.tobytes(), max(0, low))
    if 0 <= whole <= high:
        return 0, whole, whole + len(pattern)
    diagonals = np.arange(low, high + 1, dtype=np.int64)
    big = np.int64(1) << 40
    valid = (diagonals >= 0) & (diagonals <= len(text))
    row = np.where(valid, diagonals, big * (k + 2))  # cost 0, start = column
    step = np.arange(len(diagonals), dtype=np.int64) * big
    codes = text.astype(np.int64)
    for i, symbol in enumerate(pattern):
        at = i + diagonals  # text position that row i + 1 consumes on each diagonal
        inside = (at >= 0) & (at < len(text))
        same = inside & (codes[np.clip(at, 0, len(text) - 1)] == symbol) if len(text) else inside
        cost = np.where(inside, row + np.where(same, 0, big), big * (k + 2))
        skipped = np.append(row[1:], big * (k + 2)) + big  # pattern byte without a text byte
        cost = np.minimum(cost, np.where((at + 1 >= 0) & (at + 1 <= len(text)), skipped, big * (k + 2)))
        run = np.minimum.accumulate(cost - step) + step  # text bytes without a pattern byte
        row = np.where((at + 1 >= 0) & (at + 1 <= len(text)), run, big * (k + 2))
        if row.min() >= big * (k + 1):
            return k + 1, 0, 0
    best = int(row.argmin())
    return int(row[best] // big), int(row[best] % big), int(diagonals[best]) + len(pattern)


def _pieces(count: np.ndarray, cuts: np.ndarray | None, base: int = 0) -> Iterator[tuple[int, int]]:
    """Ranges, of about ENTRIES by ``count`` or of a single row, that end at one of the ``cuts`` (None: anywhere)."""
    ends = np.arange(1, len(count) + 1) if cuts is None else np.append(cuts, len(count))
    total, begin = np.cumsum(count)[ends - 1], 0
    while begin < len(ends):
        before = total[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(total, before + ENTRIES, "right")))
        yield base + (int(ends[begin - 1]) if begin else 0), base + int(ends[stop - 1])
        begin = stop


def _summed(doc: np.ndarray, item: np.ndarray, half: np.ndarray, band: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, ...]:
    """One row per band, its counts added up."""
    keys = (band, half, item, doc)
    order = np.lexsort(keys)
    changes = np.zeros(len(order) - 1, bool)
    for key in keys:
        changes |= key[order[1:]] != key[order[:-1]]
    new = np.flatnonzero(np.concatenate(([True], changes)))
    rows = order[new]
    return doc[rows], item[rows], half[rows], band[rows], np.add.reduceat(shared[order], new)


class Leaks:
    """Index of the q-grams of one part of the benchmark."""

    def __init__(self, items: list[tuple[int | None, str]], spec: LeakSpec):
        self.spec, self.items = spec, []
        grams, owner, place = [], [], []
        self.hashes: list[np.ndarray] = []
        short: dict[int, dict[bytes, list[int]]] = {}
        for item_id, text in items:
            data = compared(text)
            if len(data) < spec.q:
                if data:
                    short.setdefault(len(data), {}).setdefault(data, []).append(len(self.items))
                    self.items.append((item_id, np.frombuffer(data, np.uint8), 0, 1))
                    self.hashes.append(np.zeros(0, np.uint64))
                continue
            hashes = gram_hashes(data, spec.q)
            k = max(0, min(int(spec.rate * len(data)), (len(data) - spec.q) // spec.q))
            grams.append(hashes)
            owner.append(np.full(len(hashes), len(self.items)))
            place.append(np.arange(len(hashes)))
            self.items.append((item_id, np.frombuffer(data, np.uint8), k, len(hashes) - k * spec.q))
            self.hashes.append(hashes)
        empty = np.zeros(0, np.int64)
        grams = np.concatenate([np.zeros(0, np.uint64), *grams])
        order = np.argsort(grams, kind="stable")
        self.grams = grams[order]
        self.owner = np.concatenate([empty, *owner])[order]
        self.place = np.concatenate([empty, *place])[order]
        self.k = np.array([x[2] for x in self.items], np.int64)
        self.least = np.array([x[3] for x in self.items], np.int64)
        self.kept = self._leave_out_frequent()
        self.seen = np.zeros(1 << FILTER_BITS, bool)
        self.seen[self.grams >> np.uint64(64 - FILTER_BITS)] = True
        self.short = []  # of each length: hashes in order, first and last bytes, items
        for n, known in short.items():
            pairs = [ends_of_grams(data, n) for data in known]
            first, last = (np.concatenate(x) for x in zip(*pairs, strict=True))
            hashes = first * MULTIPLIERS[0] + last * MULTIPLIERS[1]
            order, own = np.argsort(hashes, kind="stable"), list(known.values())
            self.short.append((n, hashes[order], first[order], last[order], [own[i] for i in order]))

    def _leave_out_frequent(self) -> np.ndarray:
        """Per item how many of its q-grams stay in the index: all rare ones, and at least k * q + 1."""
        sizes = np.array([len(h) for h in self.hashes], np.int64)
        if not len(self.grams):
            return sizes
        edges = np.flatnonzero(np.concatenate(([True], self.grams[1:] != self.grams[:-1], [True])))
        places = np.repeat(np.diff(edges), np.diff(edges))
        order = np.lexsort((self.place, places, self.owner))  # of each item, the rarest first
        nth = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        stays = np.zeros(len(order), bool)
        stays[order] = (places[order] <= OFTEN) | (nth <= self.k[self.owner[order]] * self.spec.q)
        self.grams, self.owner, self.place = self.grams[stays], self.owner[stays], self.place[stays]
        return np.bincount(self.owner, minlength=len(sizes))

    def regions(self, data: bytes, starts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, item, lowest diagonal) of bands with enough shared q-grams, diagonals from the document's start."""
        hashes = gram_hashes(data, self.spec.q)
        at = np.flatnonzero(self.seen[hashes >> np.uint64(64 - FILTER_BITS)])
        first = np.searchsorted(self.grams, hashes[at], "left")
        count = np.searchsorted(self.grams, hashes[at], "right") - first
        at, first, count = at[count > 0], first[count > 0], count[count > 0]
        if not len(at):
            return
        least = self.kept - self.k * self.spec.q  # of the q-grams in the index
        partial = self.kept < self.least + self.k * self.spec.q
        doc = np.searchsorted(starts, at, "right") - 1
        for a, b in _pieces(count, np.flatnonzero(doc[1:] != doc[:-1]) + 1):  # whole documents
            bands = [self._bands(at[i:j], first[i:j], count[i:j], starts) for i, j in _pieces(count[a:b], None, a)]
            d, i, half, band, shared = _summed(*(np.concatenate(x) for x in zip(*bands, strict=True)))
            low = (2 * band - half) * (self.k[i] + 1)
            for n in np.flatnonzero(shared >= least[i]):
                if not partial[i[n]] or self._enough(hashes, int(starts[d[n]] + low[n]), int(i[n])):
                    yield int(d[n]), int(i[n]), int(low[n])

    def _bands(self, at: np.ndarray, first: np.ndarray, count: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, item, half, band, shared q-grams) of bands of two widths; half 1 is the set moved by one width."""
        entry = ragged(first, count)
        item, doc = self.owner[entry], np.repeat(np.searchsorted(starts, at, "right") - 1, count)
        diagonal = np.repeat(at, count) - starts[doc] - self.place[entry]
        width = self.k[item] + 1
        sets = [(doc, item, np.full(len(doc), h), (diagonal + h * width) // (2 * width), np.ones_like(doc)) for h in (0, 1)]
        return _summed(*(np.concatenate(x) for x in zip(*sets, strict=True)))

    def _enough(self, hashes: np.ndarray, low: int, item: int) -> bool:
        """Whether a band can share enough of all q-grams of an item, those left out of the index too."""
        own, diagonals = self.hashes[item], 2 * (int(self.k[item]) + 1)
        if len(own) * diagonals > COMPARED:
            return True
        window = np.zeros(len(own) + diagonals - 1, np.uint64)
        begin, end = max(0, low), min(len(hashes), low + len(window))
        window[begin - low : max(begin, end) - low] = hashes[begin : max(begin, end)]
        return int((sliding_window_view(window, len(own)) == own).sum()) >= self.least[item]

    def short_places(self, data: bytes, starts: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, start, end) of the first occurrences of passages shorter than a q-gram."""
        within = within_words(data) if self.short else None
        ends = np.append(starts[1:], len(data)) - self.spec.q
        for n, known, first, last, items in self.short:
            a, b = ends_of_grams(data, n)
            hashes = a * MULTIPLIERS[0] + b * MULTIPLIERS[1]
            at = np.flatnonzero(~(within[: len(hashes)] | within[n : n + len(hashes)]))
            key = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
            same = (first[key] == a[at]) & (last[key] == b[at])
            at, key = at[same], key[same]
            doc = np.searchsorted(starts, at, "right") - 1
            at, key, doc = (x[at + n <= ends[doc]] for x in (at, key, doc))
            for i in np.unique(doc * len(known) + key, return_index=True)[1]:
                start = int(at[i] - starts[doc[i]])
                yield from ((int(doc[i]), item, start, start + n) for item in items[key[i]])

    def find(self, texts: list[str | None]) -> list[list[tuple[int | None, int, int, int]]]:
        """Per text the items in it: (item_id, start, end, distance), the nearest occurrence of each."""
        found: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        parts, starts, size, base = [], [], 0, 0

        def flush(upto: int) -> None:
            data, offsets = b"".join(parts), np.array(starts, np.int64)
            for doc, item, low in self.regions(data, offsets):
                _, pattern, k, _ = self.items[item]
                text = np.frombuffer(parts[doc], np.uint8)[: -self.spec.q]
                lowest, highest = low - k, low + 2 * (k + 1) + k
                # Only the part of the text that these diagonals reach.
                left = max(0, lowest)
                part = text[left : max(left, highest + len(pattern))]
                cost, start, end = banded_distance(pattern, part, lowest - left, highest - left, k)
                if cost <= k:
                    seen = found[base + doc].get(item)
                    here = (cost, start + left, end + left)
                    found[base + doc][item] = min(seen, here) if seen else here
            for doc, item, start, end in self.short_places(data, offsets):
                found[base + doc][item] = (0, start, end)

        for n, text in enumerate(texts):
            data = compared(text)
            parts.append(data + bytes(self.spec.q))  # no q-gram of a passage holds a zero byte
            starts.append(size)
            size += len(parts[-1])
            if size > SLICE_BYTES:
                flush(n)
                parts, starts, size, base = [], [], 0, n + 1
        if parts:
            flush(len(texts))
        return [
            [(self.items[i][0], start, end, cost) for i, (cost, start, end) in sorted(x.items())] for x in found
        ]


def _parts(benchmark: DataFrame, spec: LeakSpec) -> tuple[DataFrame, int]:
    """The distinct passages, one row of texts per part, written; and the number of parts."""
    texts = benchmark.select(F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull()).distinct()
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // spec.part_bytes))
    dealt = texts.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(parts)))
    rows = dealt.groupBy("part").agg(F.sort_array(F.collect_list("text")).alias("texts"))
    path = shared_folder(benchmark.sparkSession)
    rows.write.parquet(path)
    return benchmark.sparkSession.read.schema(PARTS).parquet(path), parts


def _items(benchmark: DataFrame, parts: DataFrame) -> DataFrame:
    """Which items have which passage, written."""
    places = parts.select("part", F.posexplode("texts").alias("place", "text"))
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).join(places, "text")
    path = shared_folder(benchmark.sparkSession)
    rows.select(_passage(F.col("part"), F.col("place")).alias("passage"), "item_id").write.parquet(path)
    return benchmark.sparkSession.read.schema("passage long, item_id long").parquet(path)


def _passage(part: Column, place: Column) -> Column:
    return F.shiftleft(part, 32) + place


def _only_part(parts: DataFrame) -> list[str]:
    row = parts.first()
    return row["texts"] if row else []


def _meet(chunks: DataFrame, parts: DataFrame) -> DataFrame:
    """Each chunk, followed by all parts."""
    own = chunks.withColumns({"part": F.lit(-1).cast("long"), "texts": F.lit(None).cast("array<string>")})
    pairs = chunks.select("chunk").crossJoin(parts)
    rows = own.unionByName(pairs, allowMissingColumns=True)
    return rows.repartition("chunk").sortWithinPartitions("chunk", "part")


def _hits_of_chunks(batches: Iterator[pa.RecordBatch], spec: LeakSpec) -> Iterator[tuple[Chunk, list[list[tuple]]]]:
    """Each chunk with the hits of its texts in all parts."""
    chunk, texts, hits = None, [], []
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["part"] < 0:
                if chunk:
                    yield chunk, hits
                chunk = Chunk(row)
                texts = [t.decode("utf-8", "surrogatepass") for t in chunk.texts()]
                hits = [[] for _ in texts]
            else:
                first = row["part"] << 32
                leaks = Leaks([(first + n, t) for n, t in enumerate(row["texts"])], spec)
                for own, more in zip(hits, leaks.find(texts), strict=True):
                    own.extend(more)
    if chunk:
        yield chunk, hits


def _found(ids: list[int | None], hits: list[list[tuple]]) -> pa.RecordBatch:
    rows = [(ids[n], *hit) for n, own in enumerate(hits) for hit in own]
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "passage", "start", "end", "distance"]
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, spec: LeakSpec | None = None) -> DataFrame:
    """One row per document and passage in it."""
    spec = spec or LeakSpec()
    parts, count = _parts(benchmark, spec)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if count == 1:
        texts = _only_part(parts)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            leaks = Leaks(list(enumerate(texts)), spec)
            for batch in batches:
                yield _found(batch.column(0).to_pylist(), leaks.find(batch.column(1).to_pylist()))

        found = rows.mapInArrow(releasing(find), FOUND)
    else:

        def find_in_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chunk, hits in _hits_of_chunks(batches, spec):
                yield _found(chunk.id_column().to_pylist(), hits)

        found = _meet(write_chunks(docs.sparkSession, rows), parts).mapInArrow(releasing(find_in_chunks), FOUND)
    return found.join(_items(benchmark, parts), "passage").select("doc_id", "item_id", "start", "end", "distance")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, spec: LeakSpec | None = None) -> DataFrame:
    """The documents that hold no passage, all columns as they are."""
    spec = spec or LeakSpec()
    at = docs.columns.index("text")
    parts, count = _parts(benchmark, spec)
    if count == 1:
        texts = _only_part(parts)

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            leaks = Leaks(list(enumerate(texts)), spec)
            for batch in batches:
                found = leaks.find(batch.column(at).to_pylist())
                yield batch.filter(pa.array([not hits for hits in found], pa.bool_()))

        return docs.mapInArrow(releasing(keep), docs.schema)
    target = to_arrow_schema(docs.schema)

    def keep_of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, hits in _hits_of_chunks(batches, spec):
            kept = [n for n, own in enumerate(hits) if not own]
            if kept:
                texts = list(chunk.texts())
                rows = chunk.rows(np.array(kept, np.int64), [texts[n] for n in kept])
                yield from pa.table({n: rows[n] for n in target.names}, target).to_batches()

    return _meet(write_chunks(docs.sparkSession, docs, carry=True), parts).mapInArrow(releasing(keep_of_chunks), docs.schema)
