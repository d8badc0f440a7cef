"""Near-duplicate classes by an exact Jaccard join with adaptive multi-match prefixes.

A text is the set of its distinct shingles of ``words`` words (fewer words: the
whole sequence). Texts whose sets agree to ``percent`` or more link; the answer
is each document's component.

Tokens are ordered by how many documents hold them, rarest first. Two sets that
link share at least l tokens in their prefixes of n - ceil(percent n) + l tokens,
for every l. A document whose prefix would meet many others lengthens it: it
takes the l for which the estimated cost of postings and of verified candidates
is least, and a pair is verified only when it shares min(l, l') prefix tokens.

How it runs. Chunks send their distinct tokens, packed, to buckets and get the
document counts back; equal sets collapse to their smallest document. Tokens
that one document holds make no posting. While the lists hold many more pairs
than postings, and rounds still join components, stars compare each
document with one, later a few, that lead most of its lists and belong to the largest
component there; pairs are then made only between documents that are still in
different components, so a group of thousands of copies costs its size and not
its square. Before they are made, a posting goes when nothing of another component
in its list can link with it, the largest component of a list is not joined with
itself, and parity bits bound from below in how many tokens two sets differ. No pair
is capped or dropped; a pair that meets too late in the order to link, or whose
bits differ in more places than a link allows, is not made. Sets of documents that
have postings are stored once; intersections are built-in array functions.

Tokens are 64-bit hashes. Defined results: a null or blank text has the empty
set and links with nothing; a null id takes the component id of its component
(null if alone); rows with the same id are separate documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storewright.llm.chunks import Chunk, bucket_count, pack, per_bucket, per_chunk, unpack, with_chunk, write_chunks
from storewright.llm.components import components, discard, written
from storewright.llm.workers import releasing

SLICE_BYTES = 1_000_000
ROW_BITS = 20
KEYS, SETS, CHOSEN = 0, 1, 2
ASKED = "kind int, bucket int, chunk long, keys binary, counts binary, more binary"
CLASSES = "node long, chunk long, row long, doc_id long, n_shingles long, high long, low long"
LEVELS = (1, 2, 4, 8, 16, 32, 64)
PARITY_LONGS = 8  # 512 bits tell sets of some hundred tokens apart; larger sets only lose the filter
SIZE_CLASSES = 4  # of each doubling of a set's size, for what a list holds
SLICE_PAIRS = 4096  # pairs that one copy of a centre's set serves


@dataclass(frozen=True)
class JoinSpec:
    words: int = 5
    percent: int = 75
    bucket_bytes: int = 4_000_000
    star_rounds: int = 24
    leaders: int = 6
    pairs_each: int = 4


# --- shingles ----------------------------------------------------------------

_random = np.random.default_rng(20240229)
BYTE_VALUES = _random.integers(0, 2**64, 256, np.uint64)
FACTORS = _random.integers(0, 2**64, 64, np.uint64) | np.uint64(1)
BASE = FACTORS[-1]
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(max(0, n - 1), base))), dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(33)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of lower-cased bytes."""
    text = np.frombuffer(data, np.uint8)
    inside = ~((text == 32) | (text >= 9) & (text <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    start, end = edge[::2], edge[1::2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[text] * _powers(BASE, len(text)), dtype=np.uint64)))
    own = (sums[end] - sums[start]) * _powers(BASE_INVERSE, len(text) + 1)[start]
    return _mix(own + (end - start).astype(np.uint64) * FACTORS[0]), start


def shingle_sets(chunk: Chunk, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text."""
    data, row = chunk.data.lower(), 0
    while row < len(chunk.sizes):
        last, size = row, 0
        while last < len(chunk.sizes) and (last == row or size + chunk.sizes[last] <= SLICE_BYTES):
            size += int(chunk.sizes[last])
            last += 1
        part = b"\n".join([data[a:b] for a, b in zip(chunk.starts[row:last], chunk.ends[row:last], strict=True)])
        hashes, start = word_hashes(part)
        begin = np.cumsum(chunk.sizes[row:last] + 1) - chunk.sizes[row:last] - 1
        edges = np.append(np.searchsorted(start, begin), len(start))
        several = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for i in range(words):
            several += hashes[i : i + len(several)] * FACTORS[1 + i]
        several = _mix(several)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b - a >= words:
                own = np.sort(several[a : b - words + 1])
                yield own[np.concatenate(([True], own[1:] != own[:-1]))]
            elif b > a:
                yield _mix((hashes[a:b] * FACTORS[10 : 10 + b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a))
            else:
                yield hashes[:0]
        row = last


# --- document counts and classes ---------------------------------------------


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


SHORT = np.uint64(16)  # 48 bits of a token tell its document count; a clash only changes the order


def _counted(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct short tokens of a chunk, in how many of its documents each is, and where each token of the sets is."""
    every = np.concatenate(sets) >> SHORT if sets else np.zeros(0, np.uint64)
    keys, at, counts = np.unique(every, return_inverse=True, return_counts=True)
    return keys, counts, at


def ask(chunk: Chunk, spec: JoinSpec, buckets: int) -> Iterator[dict]:
    sets = list(shingle_sets(chunk, spec.words))
    keys, counts, _ = _counted(sets)
    bucket = _bucket(keys << SHORT, buckets)
    edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(keys) else [0]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield {
            "kind": [KEYS], "bucket": [int(bucket[a])], "chunk": [chunk.chunk], "keys": [pack(keys[a:b], delta=True)],
            "counts": [pack(counts[a:b].astype(np.uint32))], "more": [b""],
        }
    digests = np.array([divmod(xxhash.xxh3_128_intdigest(s.tobytes()), 2**64) for s in sets], np.uint64).reshape(-1, 2)
    yield {
        "kind": [SETS], "bucket": [-1], "chunk": [chunk.chunk], "keys": [pack(digests.reshape(-1))],
        "counts": [pack(np.array([len(s) for s in sets], np.int64))],
        "more": [pack(np.concatenate((chunk.ids, chunk.known.astype(np.int64))))],
    }


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document: its place, size and the digest of its set."""
    for batch in batches:
        for row in batch.to_pylist():
            sizes, digests, more = unpack(row["counts"]), unpack(row["keys"]).view(np.int64), unpack(row["more"])
            n, digests = len(sizes), digests.reshape(-1, 2)
            at = np.arange(n)
            columns = [
                pa.array(row["chunk"] << ROW_BITS | at), pa.array(np.full(n, row["chunk"])), pa.array(at),
                pa.array(more[:n], mask=more[n:] == 0), pa.array(sizes), pa.array(digests[:, 0]), pa.array(digests[:, 1]),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in CLASSES.split(", ")])


def count_documents(rows: list[dict]) -> Iterator[dict]:
    each = [unpack(r["keys"]) for r in rows]
    keys, at = np.unique(np.concatenate(each), return_inverse=True)
    counts = np.bincount(at, np.concatenate([unpack(r["counts"]) for r in rows]), len(keys)).astype(np.int64)
    for row, own in zip(rows, np.split(counts[at], np.cumsum([len(k) for k in each])[:-1]), strict=True):
        own = own.astype(np.min_scalar_type(int(own.max(initial=0))))
        yield {
            "kind": [KEYS], "bucket": [row["bucket"]], "chunk": [row["chunk"]], "keys": [b""], "counts": [pack(own)],
            "more": [b""],
        }


# --- prefixes ----------------------------------------------------------------


def least_overlap(n: int, percent: int) -> int:
    """How many tokens a set of n must share with any set that it links to."""
    return -(-percent * n // 100)


def choose_matches(counts: np.ndarray, n: int, percent: int) -> int:
    """The number of required matches with the least estimated cost; counts come in the order of the tokens.

    Postings cost what their lists hold; candidates are at most what the lists
    hold divided by the required matches, and one costs a pass over the set.
    Tokens so late that a set of the same size could not link from there on are
    not counted: the position filter leaves those pairs out.
    """
    needed = least_overlap(n, percent)
    alike = -(-2 * percent * n // (100 + percent))  # what two sets of n must share
    met = np.concatenate(([0], np.cumsum(counts - 1)))
    best, chosen = None, 1
    for matches in LEVELS:
        if matches > needed:
            break
        lists = float(met[n - alike + matches])
        cost = lists + lists / matches * n / 4
        if best is None or cost < best:
            best, chosen = cost, matches
    return chosen


def parity(tokens: np.ndarray) -> bytes:
    """One bit per class of tokens: whether a set has an odd number of them. Two sets differ in at least as many tokens as bits."""
    bits = 64 * PARITY_LONGS
    return np.packbits(np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).tobytes()


PREFIXES = "node long, doc_id long, n long, least int, tokens binary, places binary, shingles binary, parity binary"


def prefixes(chunk: Chunk, answers: list[dict], spec: JoinSpec) -> Iterator[dict]:
    chosen = {r["bucket"] for r in answers if r["kind"] == CHOSEN}  # rows that stand for their class
    sets = list(shingle_sets(chunk, spec.words))
    _, _, at = _counted(sets)
    counts = [r["counts"] for r in sorted(answers, key=lambda r: r["bucket"]) if r["kind"] == KEYS]
    counts = np.concatenate([unpack(c).astype(np.int64) for c in counts])[at] if counts else np.zeros(0, np.int64)
    out: dict[str, list] = {c.split()[0]: [] for c in PREFIXES.split(", ")}
    end = 0
    for row, own in enumerate(sets):
        begin, end = end, end + len(own)
        if row not in chosen or not len(own):
            continue
        n, held = len(own), counts[begin:end]
        order = np.lexsort((own, held))
        least = choose_matches(held[order], n, spec.percent)
        size = n - least_overlap(n, spec.percent) + least
        places = np.flatnonzero(held[order[:size]] > 1)
        met = order[places]
        if not len(met):
            continue
        for name, value in zip(
            out, (chunk.chunk << ROW_BITS | row, chunk.ids[row] if chunk.known[row] else None, n, least,
                  own[met].tobytes(), places.astype(np.int64).tobytes(), own.tobytes(), parity(own)), strict=True,
        ):
            out[name].append(value)
    yield out


def _as_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed 64-bit tokens as array columns."""
    for batch in batches:
        columns = []
        for name in batch.schema.names:
            column = batch.column(name)
            if name in ("tokens", "places", "shingles", "parity"):
                sizes = np.array([len(x.as_py()) // 8 for x in column], np.int64)
                flat = np.frombuffer(b"".join(x.as_py() for x in column), np.int64)
                column = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), flat)
            columns.append(column)
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


ARRAYS = (
    "node long, doc_id long, n long, least int, tokens array<long>, places array<long>, shingles array<long>, "
    "parity array<long>"
)


# --- links -------------------------------------------------------------------


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of written pairs (u, v) those that link.

    Many pairs can share one v, the centre of a star: its set is sent to as many
    tasks as its pairs need.
    """
    slices = F.ceil(F.col("count") / SLICE_PAIRS)
    centres = pairs.groupBy("v").count().select("v", slices.alias("slices"))
    dealt = pairs.join(centres, "v").select("u", "v", F.pmod(F.xxhash64("u"), "slices").alias("slice"))
    of = sets.select("node", "n", "shingles")
    left = of.select(F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("shingles").alias("s_u"))
    right = of.select(F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("shingles").alias("s_v"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice")
    right = right.join(centres, "v").select("v", "n_v", "s_v", every)
    joined = dealt.join(left, "u").join(right, ["v", "slice"])
    shared = F.size(F.array_intersect("s_u", "s_v"))
    return joined.filter(100 * shared >= percent * (F.col("n_u") + F.col("n_v") - shared)).select("u", "v")


def _told_apart(sizes: Column, percent: int) -> Column:
    """Whether sets with this sum of sizes link only when they differ in so few tokens that parity bits tell."""
    return 4 * (100 - percent) * sizes <= 64 * PARITY_LONGS * (100 + percent)


def _may_link(percent: int, matches: Column) -> Column:
    """Whether two documents that meet in a token can still link.

    Besides sizes that fit: tokens are ordered, so from the j-th shared one on at
    most the rest of the shorter tail is shared, and that must make up the
    overlap that these two sizes need, less the j - 1 before it.
    """
    small, large = F.least("n_u", "n_v"), F.greatest("n_u", "n_v")
    tail = F.least(F.col("n_u") - F.col("place_u"), F.col("n_v") - F.col("place_v"))
    enough = (100 + percent) * (tail + matches - 1) >= percent * (F.col("n_u") + F.col("n_v"))
    return (100 * small >= percent * large) & enough


def _stars(postings: DataFrame, turn: int, percent: int, leaders: int) -> DataFrame:
    """Each document with up to ``leaders`` leaders of most of its lists, members of the largest component there; others every turn."""

    def place(number: int) -> Column:
        mixed = F.xxhash64("node", F.lit(turn), F.lit(number)).alias("h")
        return F.struct((-F.col("size")).alias("size"), mixed, "node", "n", "root", "least", "place")

    led = postings.groupBy("token").agg(F.array_distinct(F.array(*[F.min(place(i)) for i in range(leaders)])).alias("led"))
    pairs = postings.join(led, "token").select("node", "n", "root", "least", "place", F.explode("led").alias("leader"))
    pairs = pairs.select(
        F.col("node").alias("u"), F.col("leader.node").alias("v"), F.col("n").alias("n_u"),
        F.col("leader.n").alias("n_v"), "root", F.col("leader.root").alias("other"),
        F.col("least").alias("least_u"), F.col("leader.least").alias("least_v"),
        F.col("place").alias("place_u"), F.col("leader.place").alias("place_v"),
    )
    pairs = pairs.filter((F.col("root") != F.col("other")) & _may_link(percent, F.least("least_u", "least_v")))
    counted = pairs.groupBy("u", "v").count()
    # A document has at most as many rows here as its prefix has tokens, times the leaders.
    order = F.sort_array(F.collect_list(F.struct("count", "v")), asc=False)
    best = counted.groupBy("u").agg(F.slice(order, 1, leaders).alias("best"))
    return best.select("u", F.explode("best.v").alias("v"))


def _merged_roots(spark: SparkSession, roots: DataFrame, found: DataFrame) -> DataFrame:
    """Roots after new links; only the roots that the links join are worked on."""
    of = roots.select("node", "root")
    edges = found.join(of.withColumnsRenamed({"node": "u", "root": "a"}), "u")
    edges = edges.join(of.withColumnsRenamed({"node": "v", "root": "b"}), "v").select(
        F.col("a").alias("u"), F.col("b").alias("v")
    )
    moved = components(spark, edges).select(F.col("node").alias("root"), F.col("root").alias("new"))
    joined = of.join(moved, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
    sizes = joined.groupBy("root").agg(F.count("*").alias("size"))
    return written(spark, joined.join(sizes, "root"))


def _pairs_left(postings: DataFrame) -> tuple[int, int]:
    """How many pairs the lists hold at most, before any filter, and how many postings there are."""
    lists = postings.groupBy("token").agg(F.count("*").cast("double").alias("n"))
    left, held = lists.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.sum("n")).first()
    return int(left or 0), int(held or 0)


def _mixed(postings: DataFrame) -> DataFrame:
    """The postings of tokens that documents of several components have; no other list can give a new pair."""
    mixed = postings.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
    return postings.join(mixed.select("token"), "token", "left_semi")


def _reachable(postings: DataFrame, percent: int) -> DataFrame:
    """The postings for which the sizes and places in their list let something of another component link.

    A list is summed up per class of sizes, so what is looked at per posting
    grows with the logarithm of the largest set.
    """
    tail = F.col("n") - F.col("place")
    classes = postings.groupBy("token", F.floor(SIZE_CLASSES * F.log2("n")).alias("class")).agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max(tail).alias("tail"), F.max("least").alias("least"),
        F.min("root").alias("a"), F.max("root").alias("b"),
    )
    met = classes.groupBy("token").agg(F.collect_list(F.struct("low", "high", "tail", "least", "a", "b")).alias("met"))

    def links(x: Column) -> Column:
        matches = F.when(_told_apart(F.col("n") + x["high"], percent), 1).otherwise(F.least("least", x["least"]))
        shared = F.least(tail, x["tail"]) + matches - 1
        fits = 100 * F.least("n", x["high"]) >= percent * F.greatest("n", x["low"])
        other = (x["a"] != F.col("root")) | (x["b"] != F.col("root"))
        return other & fits & ((100 + percent) * shared >= percent * (F.col("n") + x["low"]))

    return postings.join(met, "token").filter(F.exists("met", links)).drop("met")


def _few_differences(percent: int) -> Column:
    """Whether the parity bits leave a link possible: sets that link differ in at most (100 - percent) / (100 + percent) of their tokens."""
    differ = [F.bit_count(F.col("parity_u")[i].bitwiseXOR(F.col("parity_v")[i])) for i in range(PARITY_LONGS)]
    return (100 + percent) * reduce(add, differ) <= (100 - percent) * (F.col("n_u") + F.col("n_v"))


def _pairs(spark: SparkSession, postings: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that share enough prefix tokens; ``postings`` as `_mixed` leaves them.

    The component with most postings of a list meets the others there, not itself.
    Where parity bits tell sets apart, one shared token is enough: more would make
    a row each, and longer prefixes to find them in.
    """
    matches = F.when(_told_apart(F.col("n_u") + F.col("n_v"), percent), 1).otherwise(F.least("least_u", "least_v"))
    reachable = _reachable(postings, percent)
    most = reachable.groupBy("token", "root").count().groupBy("token").agg(F.max(F.struct("count", "root")).alias("most"))
    marked = reachable.join(most, "token").withColumn("main", F.col("root") == F.col("most.root")).drop("most")
    marked = written(spark, marked.join(sets.select("node", "parity"), "node"))
    left, right = (
        marked.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "least", "place", "root", "main", "parity")])
        for side in "uv"
    )
    met = left.filter(~F.col("main_u")).join(right, "token").filter(
        (F.col("main_v") | (F.col("node_u") < F.col("node_v"))) & (F.col("root_u") != F.col("root_v"))
        & _may_link(percent, matches) & _few_differences(percent)
    )
    counted = met.groupBy(F.least("node_u", "node_v").alias("u"), F.greatest("node_u", "node_v").alias("v")).agg(
        F.count("*").alias("shared"), F.first(matches).alias("needed")
    )
    pairs = written(spark, counted.filter("shared >= needed").select("u", "v"))
    discard(marked)
    return pairs


def _linked_roots(spark: SparkSession, lists: DataFrame, sets: DataFrame, spec: JoinSpec) -> DataFrame:
    """(node, root): rounds of stars first, in which every document is compared with one other, then all pairs that are left.

    A family of near copies has more pairs than anybody could compare, but is one
    component after a few stars. The first round has one leader a list, later ones,
    over the lists that still mix components, have more, for documents at the edge
    of a family, which are near few of its members. Rounds go on while many pairs
    are left and at least a twentieth of the compared documents link.
    """
    columns = ["node", "n", "least", "token", "place"]
    roots = written(spark, sets.select("node", F.col("node").alias("root"), F.lit(1).cast("long").alias("size")))
    turn, active = 0, lists.join(roots, "node")
    while turn < spec.star_rounds:
        tested = written(spark, _stars(active, turn, spec.percent, spec.leaders if turn else 1))
        found = written(spark, verified(tested, sets, spec.percent))
        n_tested, n_found = (df.agg(F.count_distinct("u")).first()[0] for df in (tested, found))
        if not n_found:
            break
        roots, old = _merged_roots(spark, roots, found), roots
        active, before = written(spark, _mixed(active.select(*columns).join(roots, "node"))), active if turn else None
        for table in (old, tested, found, *([before] if before is not None else [])):
            discard(table)
        turn += 1
        left, held = _pairs_left(active)
        if left <= spec.pairs_each * held or 20 * n_found < n_tested:
            break
    if not turn:
        active = _mixed(active)
    pairs = _pairs(spark, active, sets, spec.percent)
    return _merged_roots(spark, roots, written(spark, verified(pairs, sets, spec.percent))).select("node", "root")


def keep_first(spark: SparkSession, docs: DataFrame, spec: JoinSpec | None = None) -> DataFrame:
    """Of each component the row with the smallest id, all columns as they are; rows without words all stay."""
    chunks = write_chunks(spark, docs, carry=True)
    first = _near_duplicates(spark, chunks, spec or JoinSpec()).filter("first")
    low = F.col("node").bitwiseAND((1 << ROW_BITS) - 1)
    chosen = first.select(F.shiftright("node", ROW_BITS).alias("chunk"), low.alias("row"))

    def keep(chunk: Chunk, rows: list[dict]) -> Iterator[dict]:
        at = np.sort(np.array([r["row"] for r in rows], np.int64))
        if len(at):
            yield chunk.rows(at, [chunk.data[chunk.starts[i] : chunk.ends[i]] for i in at.tolist()])

    return with_chunk(chunks, chosen, keep, docs.schema)


def near_duplicates(spark: SparkSession, docs: DataFrame, spec: JoinSpec | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, and whether the row is the one that stands for its component (``first``)."""
    return _near_duplicates(spark, write_chunks(spark, docs), spec or JoinSpec())


def _near_duplicates(spark: SparkSession, chunks: DataFrame, spec: JoinSpec) -> DataFrame:
    buckets = bucket_count(chunks, spec.bucket_bytes)
    asked = written(spark, per_chunk(chunks, lambda c: ask(c, spec, buckets), ASKED))
    rows = written(spark, asked.filter(F.col("kind") == SETS).mapInArrow(releasing(_classes), CLASSES))
    # The smallest document of each set; a null id comes last.
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "node")
    classes = written(spark, rows.groupBy("high", "low").agg(F.min(order).alias("first"), F.count("*").alias("members")))
    empty = F.lit(b"")
    chosen = classes.select(
        F.lit(CHOSEN).alias("kind"),
        (F.col("first.node").bitwiseAND((1 << ROW_BITS) - 1)).cast("int").alias("bucket"),
        F.shiftright("first.node", ROW_BITS).alias("chunk"),
        empty.alias("keys"), empty.alias("counts"), empty.alias("more"),
    )
    counts = per_bucket(asked.filter(F.col("kind") == KEYS), ["bucket"], count_documents, ASKED)
    packed = with_chunk(chunks, counts.unionByName(chosen), lambda c, a: prefixes(c, a, spec), PREFIXES)
    sets = written(spark, packed.mapInArrow(releasing(_as_arrays), ARRAYS), "node")
    lists = sets.select("node", "n", "least", F.explode(F.arrays_zip("tokens", "places")).alias("one")).select(
        "node", "n", "least", F.col("one.tokens").alias("token"), F.col("one.places").alias("place")
    )

    discard(asked)
    roots = _linked_roots(spark, lists, sets, spec)
    # A component is called by the smallest id of its classes.
    named = classes.select("high", "low", F.col("first.node").alias("node"), F.col("first.doc_id").alias("least_id"))
    named = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    called = named.groupBy("root").agg(F.min(F.struct(F.col("least_id").isNull(), "least_id", "node")).alias("called"))
    named = named.join(called, "root").select(
        "high", "low", F.col("called.least_id").alias("component_id"), F.col("called.node").alias("leader")
    )
    # An empty set links with nothing: every such row is its own component.
    out = rows.join(named, ["high", "low"])
    alone = F.col("n_shingles") == 0
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("node") == F.col("leader"))).alias("first"),
        "node",
    )
