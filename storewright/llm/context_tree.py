"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions, each a node of a binary tree over the 256
values. Every node has, for each context of up to ``depth`` preceding bytes, the
Krichevsky-Trofimov estimate of its decisions in the training texts, and the
estimates of all depths are mixed with the weights of context-tree weighting,

    P(s) = KT(s) / 2 + product of P(c s) over the next older byte c / 2,

with P(s) = KT(s) at the full depth. A text is scored by the conditional
probabilities that this mixture gives after the training texts; the model is
not changed while scoring. Texts are lower-cased (A-Z), begin after a context of
end marks and end with an end mark (byte 255, which UTF-8 never has), so the
scores are probabilities of whole texts. An unseen context predicts 1/2 a bit.

How it runs: chunks count their distinct (depth + 1)-grams; these go, packed, to
buckets by the two youngest context bytes, where the tree above two bytes is
complete. A first pass over the buckets yields the sums for the contexts of no
and one byte, a table of at most 65,791 nodes that the driver finishes. A second
pass sends each chunk the logarithm of the probability of each of its grams. No
text is moved, nothing is sampled, and all counts are over all training rows.
Unigram counts of words travel the same way, by 64-bit hash.

Defined results: a null text is empty (one end token, one end mark); a null id
belongs to the training rows, as does every id whose crc32 has another
remainder than the held-out one; repeated rows count each; with no training rows
every word is unknown and every bit costs one bit.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storewright.llm.chunks import (
    Chunk, bucket_count, distinct, pack, per_bucket, per_chunk, unpack, with_chunk, write_chunks,
)
from storewright.session import shared_folder

END_MARK = 255
END_TOKEN = 0  # key of the end token among the words' hashes
LEVELS = 8
SLICE_BYTES = 2_000_000
ASKED = "kind int, bucket int, chunk long, keys binary, counts binary"
ANSWERED = "kind int, bucket int, chunk long, values binary"
OUT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
    "score double, n_bytes long, bits_per_byte double"
)
WORDS, GRAMS = 0, 1


@dataclass(frozen=True)
class LmSpec:
    depth: int = 5
    modulus: int = 7
    remainder: int = 2
    bucket_bytes: int = 16_000_000


def is_held_out(doc_id: int | None, spec: LmSpec) -> bool:
    told = "" if doc_id is None else str(doc_id)
    return zlib.crc32(told.encode()) % spec.modulus == spec.remainder


def held_out_rows(chunk: Chunk, spec: LmSpec) -> np.ndarray:
    ids = zip(chunk.ids.tolist(), chunk.known.tolist(), strict=True)
    return np.array([is_held_out(i if known else None, spec) for i, known in ids], bool)


# --- the mixture -------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after moving the argument up by eight."""
    moved = np.ones_like(x)
    for i in range(8):
        moved *= x + i
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(moved)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    n = zeros + ones
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(n + 1.0) - math.log(math.pi)


def node_of(byte: np.ndarray, level: int) -> np.ndarray:
    """Which of the 255 decisions comes at a level: a one followed by the bits so far."""
    return (byte >> (LEVELS - level)) | (1 << level)


def bit_of(byte: np.ndarray, level: int) -> np.ndarray:
    return (byte >> (LEVELS - 1 - level)) & 1


@dataclass
class Nodes:
    """Of one depth: codes (context << 8 | node), sorted, with the counts of both decisions and log probabilities."""

    code: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    kt: np.ndarray
    mixed: np.ndarray

    def own_share(self) -> np.ndarray:
        """Posterior weight of the node's own estimate."""
        return np.exp(self.kt - math.log(2) - self.mixed)


def count_nodes(symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """codes, zeros, ones of (context << 8 | byte) with counts."""
    context, byte = symbols >> 8 << 8, symbols & 255
    codes = np.concatenate([context | node_of(byte, level) for level in range(LEVELS)])
    bits = np.concatenate([bit_of(byte, level) for level in range(LEVELS)])
    code, at = np.unique(codes, return_inverse=True)
    n = np.tile(counts, LEVELS).astype(np.float64)
    return code, np.bincount(at, n * (bits == 0), len(code)), np.bincount(at, n * bits, len(code))


def mix(own: np.ndarray, children: np.ndarray) -> np.ndarray:
    return np.logaddexp(own, children) - math.log(2)


def summed_to_parents(child: Nodes, parent: np.ndarray) -> np.ndarray:
    """Sum of the children's log probabilities; a child's context has one older byte at its low end."""
    above = child.code >> 16 << 8 | child.code & 255
    return np.bincount(np.searchsorted(parent, above), child.mixed, len(parent))


def build(keys: np.ndarray, counts: np.ndarray, depth: int, least: int) -> dict[int, Nodes]:
    """Nodes of all depths from ``least`` up; keys are context bytes, youngest first, then the byte."""
    seen = counts > 0
    keys, counts = keys[seen].astype(np.int64), counts[seen]
    out: dict[int, Nodes] = {}
    for d in range(depth, least - 1, -1):
        symbols = keys >> (8 * (depth - d) + 8) << 8 | keys & 255
        symbols, at = np.unique(symbols, return_inverse=True)
        code, zeros, ones = count_nodes(symbols, np.bincount(at, counts, len(symbols)))
        kt = log_kt(zeros, ones)
        out[d] = Nodes(code, zeros, ones, kt, kt if d == depth else mix(kt, summed_to_parents(out[d + 1], code)))
    return out


def log2_probabilities(keys: np.ndarray, trees: dict[int, Nodes], depth: int) -> np.ndarray:
    """Of the byte of each key after its context: the sum over its eight decisions."""
    keys, total = keys.astype(np.int64), np.zeros(len(keys))
    byte = keys & 255
    for level in range(LEVELS):
        node, one = node_of(byte, level), bit_of(byte, level) == 1
        chance = np.full(len(keys), 0.5)
        for d in range(depth, -1, -1):
            tree = trees[d]
            code = keys >> (8 * (depth - d) + 8) << 8 | node
            at = np.minimum(np.searchsorted(tree.code, code), max(0, len(tree.code) - 1))
            found = tree.code[at] == code if len(tree.code) else np.zeros(len(keys), bool)
            at = at[found]
            n = np.where(one[found], tree.ones[at], tree.zeros[at])
            own = (n + 0.5) / (tree.zeros[at] + tree.ones[at] + 1)
            share = 1.0 if d == depth else tree.own_share()[at]
            chance[found] = share * own + (1 - share) * chance[found]
        total += np.log2(chance)
    return total


# --- what chunks ask ---------------------------------------------------------


def gram_slices(chunk: Chunk, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, row) of every byte and end mark, in slices of bounded size."""
    gap = bytes([END_MARK]) * depth
    data = chunk.data.lower()
    row = 0
    while row < len(chunk.sizes):
        last, size = row, 0
        while last < len(chunk.sizes) and (last == row or size + chunk.sizes[last] <= SLICE_BYTES):
            size += int(chunk.sizes[last])
            last += 1
        parts = [data[a:b] for a, b in zip(chunk.starts[row:last], chunk.ends[row:last], strict=True)]
        text = np.frombuffer(gap + gap.join(parts) + gap, np.uint8)
        sizes = chunk.sizes[row:last]
        begin = depth + np.cumsum(sizes + depth) - (sizes + depth)
        for a in range(0, last - row):  # a text above the slice size is cut; its keys look back over the cut
            if sizes[a] <= SLICE_BYTES:
                continue
            for cut in range(0, int(sizes[a]) + 1, SLICE_BYTES):
                stop = min(cut + SLICE_BYTES, int(sizes[a]) + 1)
                at = np.arange(begin[a] + cut, begin[a] + stop)
                yield _keys(text, at, depth), np.full(len(at), row + a)
        if last - row > 1 or sizes[0] <= SLICE_BYTES:
            owner = np.repeat(np.arange(last - row), sizes + 1)
            at = np.arange(len(owner)) + depth + owner * (depth - 1)
            yield _keys(text, at, depth), owner + row
        row = last


def _keys(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    low, high = int(at[0]), int(at[-1]) + 1
    whole = np.zeros(high - low, np.uint64)
    for back in range(1, depth + 1):
        whole = whole << np.uint64(8) | text[low - back : high - back]
    return (whole << np.uint64(8) | text[low:high])[at - low]


def _asked(kind: int, chunk: int, keys: np.ndarray, counts: np.ndarray, bucket: np.ndarray) -> Iterator[dict]:
    """Keys and counts by bucket; keys come sorted and stay so."""
    order = np.argsort(bucket, kind="stable")
    keys, counts, bucket = keys[order], counts[order], bucket[order]
    edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(keys) else [0]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield {
            "kind": [kind], "bucket": [int(bucket[a])], "chunk": [chunk], "keys": [pack(keys[a:b], delta=True)],
            "counts": [pack(counts[a:b].astype(np.uint32))],
        }


def word_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def gram_bucket(keys: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    young = (keys >> np.uint64(8 * (depth - 1))) & np.uint64(0xFFFF)
    return ((young * np.uint64(40503) & np.uint64(0xFFFF)) * np.uint64(buckets) >> np.uint64(16)).astype(np.int64)


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) or 1


def ask(chunk: Chunk, spec: LmSpec, buckets: int) -> Iterator[dict]:
    held = held_out_rows(chunk, spec)
    learned: Counter[bytes] = Counter()
    others: set[bytes] = set()
    for text, out in zip(chunk.texts(), held.tolist(), strict=True):
        words = text.lower().split()
        if out:
            others.update(words)
        else:
            learned.update(words)
    words = [*learned, *(w for w in others if w not in learned)]
    keys = np.array([END_TOKEN, *map(word_key, words)], np.uint64)
    counts = np.zeros(len(keys), np.int64)
    counts[0] = int((~held).sum())
    counts[1 : len(learned) + 1] = list(learned.values())
    keys, at = np.unique(keys, return_inverse=True)
    counts = np.bincount(at, counts, len(keys)).astype(np.int64)
    yield from _asked(WORDS, chunk.chunk, keys, counts, word_bucket(keys, buckets))

    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for keys, row in gram_slices(chunk, spec.depth):
        for train in (True, False):
            some, n = np.unique(keys[held[row] != train], return_counts=True)
            parts.append((some, n * train))
    if parts:
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)
        yield from _asked(GRAMS, chunk.chunk, keys, counts, gram_bucket(keys, spec.depth, buckets))


# --- what buckets answer -----------------------------------------------------


def _merged(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys, summed counts, and where each row's keys are among them."""
    each = [unpack(r["keys"]) for r in rows]
    keys, at = np.unique(np.concatenate(each), return_inverse=True)
    counts = np.bincount(at, np.concatenate([unpack(r["counts"]) for r in rows]), len(keys))
    return keys, counts, np.split(at, np.cumsum([len(k) for k in each])[:-1])


def bucket_sums(rows: list[dict], depth: int) -> Iterator[dict]:
    """Totals of the words; for the grams the parts of nodes with contexts of one byte."""
    keys, counts, _ = _merged(rows)
    if rows[0]["kind"] == WORDS:
        yield {"kind": [WORDS], "code": [0], "zeros": [float((counts > 0).sum())], "ones": [counts.sum()], "below": [0.0]}
        return
    low = min(2, depth)
    trees = build(keys, counts, depth, low)
    if not len(trees[low].code):
        return
    two = trees[low]
    above, at = np.unique(two.code >> 16 << 8 | two.code & 255, return_inverse=True)
    columns = [np.bincount(at, x, len(above)) for x in (two.zeros, two.ones, two.mixed)]
    yield {
        "kind": np.full(len(above), GRAMS, np.int32), "code": above, "zeros": columns[0], "ones": columns[1],
        "below": columns[2],
    }


SUMS = "kind int, code long, zeros double, ones double, below double"


def top_of_tree(rows: list[dict]) -> dict[int, Nodes]:
    """Nodes with contexts of one byte and of none, from their summed parts (at most 65,791 of them)."""
    rows = sorted(rows, key=lambda r: r["code"])
    code = np.array([r["code"] for r in rows], np.int64)
    zeros, ones, below = (np.array([r[c] for r in rows], np.float64) for c in ("zeros", "ones", "below"))
    kt = log_kt(zeros, ones)
    one = Nodes(code, zeros, ones, kt, mix(kt, below))
    root, at = np.unique(code & 255, return_inverse=True)
    zeros, ones = (np.bincount(at, x, len(root)) for x in (zeros, ones))
    kt = log_kt(zeros, ones)
    return {1: one, 0: Nodes(root, zeros, ones, kt, mix(kt, np.bincount(at, one.mixed, len(root))))}


def bucket_answers(rows: list[dict], top: dict[int, Nodes], depth: int) -> Iterator[dict]:
    keys, counts, places = _merged(rows)
    kind = rows[0]["kind"]
    if kind == WORDS:
        values = counts.astype(np.uint64)
    else:
        values = log2_probabilities(keys, build(keys, counts, depth, 2) | top, depth)
    for row, at in zip(rows, places, strict=True):
        own = values[at]
        # As few bytes as the numbers need; a score sums many logarithms, each rounded to seven digits.
        own = own.astype(np.min_scalar_type(int(own.max(initial=0))) if kind == WORDS else np.float32)
        yield {"kind": [kind], "bucket": [row["bucket"]], "chunk": [row["chunk"]], "values": [pack(own)]}


def score_chunk(chunk: Chunk, answers: list[dict], spec: LmSpec, buckets: int, total: int, words_known: int) -> Iterator[dict]:
    held, n_rows = held_out_rows(chunk, spec), len(chunk.sizes)
    values = {(r["kind"], r["bucket"]): r["values"] for r in answers}

    place: dict[bytes, int] = {}
    known, tokens, base = np.zeros(n_rows, np.int64), np.ones(n_rows, np.int64), np.zeros(n_rows)
    used = []
    for text in chunk.texts():
        words = text.lower().split()
        for w in words:
            if w not in place:
                place[w] = len(place) + 1
        used.append(np.fromiter(map(place.__getitem__, words), np.int32, len(words)))
    hashes = np.array([END_TOKEN, *map(word_key, place)], np.uint64)
    keys, at = np.unique(hashes, return_inverse=True)
    counts = np.concatenate([unpack(values[WORDS, b]).astype(np.int64) for b in _in_order(word_bucket(keys, buckets))])[at]
    cost = np.log10((counts + 1) / (total + words_known + 1))
    for i, words in enumerate(used):
        tokens[i] += len(words)
        known[i] = (counts[words] > 0).sum() + (counts[0] > 0)
        base[i] = cost[words].sum() + cost[0]

    bits = np.zeros(n_rows)
    grams = [distinct(keys) for keys, _ in gram_slices(chunk, spec.depth)]
    keys = distinct(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
    if len(keys):
        bucket = gram_bucket(keys, spec.depth, buckets)
        order = np.argsort(bucket, kind="stable")
        cost = np.empty(len(keys))
        cost[order] = np.concatenate([unpack(values[GRAMS, b]).astype(np.float64) for b in _in_order(bucket[order])])
    for own, row in gram_slices(chunk, spec.depth):
        some, at = np.unique(own, return_inverse=True)
        bits += np.bincount(row, cost[np.searchsorted(keys, some)][at], n_rows)

    yield {
        "doc_id": chunk.id_column(), "held_out": held, "n_tokens": tokens, "n_known": known,
        "train_tokens": np.full(n_rows, total), "base_score": base, "score": bits * math.log10(2),
        "n_bytes": chunk.sizes, "bits_per_byte": -bits / np.maximum(chunk.sizes, 1),
    }


def _in_order(bucket: np.ndarray) -> list[int]:
    return bucket[np.concatenate(([True], bucket[1:] != bucket[:-1]))].tolist()


def score(spark: SparkSession, docs: DataFrame, spec: LmSpec | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte."""
    spec = spec or LmSpec()
    chunks = write_chunks(spark, docs)
    buckets = bucket_count(chunks, spec.bucket_bytes)
    path = shared_folder(spark)
    per_chunk(chunks, lambda c: ask(c, spec, buckets), ASKED).write.parquet(path)
    asked = spark.read.parquet(path)
    depth = spec.depth
    sums = (
        per_bucket(asked, ["kind", "bucket"], lambda rows: bucket_sums(rows, depth), SUMS)
        .groupBy("kind", "code")
        .agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")])
        .collect()  # one row for the words, at most 65,536 for contexts of one byte
    )
    words = [r for r in sums if r["kind"] == WORDS]
    words_known, total = (int(words[0]["zeros"]), int(words[0]["ones"])) if words else (0, 0)
    top = top_of_tree([r.asDict() for r in sums if r["kind"] == GRAMS])
    answers = per_bucket(asked, ["kind", "bucket"], lambda rows: bucket_answers(rows, top, depth), ANSWERED)
    return with_chunk(
        chunks, answers, lambda c, rows: score_chunk(c, rows, spec, buckets, total, words_known), OUT
    )
