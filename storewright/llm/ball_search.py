"""Exact ranked lexical search: inner products over sparse ball trees.

A document's vector has one integer per term, its impact: the term's weight times
a saturating function of how often it occurs and how long the document is. An
item's score of a document is the inner product of that vector with the item's
0/1 vector. Only terms that some item asks for can count, so documents are
written as counts of those terms alone, with the total that their length needs;
document frequencies are counted from these rows.

Items are split into groups of similar ones until a group asks for few terms.
In a task, blocks of documents get one ball tree per group, over the
document vectors restricted to the group's terms: what the group does not ask for
adds nothing to a radius. A node's bound on a score is item * centroid + |item| *
radius, rounded up by more than doubles can lose. An item descends best-first:
the node with the highest bound next, until no bound left can reach the k-th best
score it has, which carries over from block to block. Leaves are scored in
64-bit integers. Tasks give k rows per item; a last step merges them.

Items are searched in parts of ``part_bytes`` of text, one pass over the documents
each: what a task holds of the items is bounded, and so is what the driver
collects (one part's terms, with their frequencies).

Terms are the maximal runs of ASCII letters and digits and of everything beyond
ASCII, A-Z lower-cased, of whole texts; a null text has none. ``search`` returns item_id,
rank (from 1), doc_id, score: the k best documents with a score above 0, equal scores
by ascending doc_id. Documents without terms do not count. A document with a null id counts in all
statistics and is never returned; rows that repeat an id are documents of their
own, each with its rank. An item_id names an item: of several rows with one id the
largest text is searched, null ids are left out, items without terms find nothing. Empty
tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storewright.llm.components import written

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")
SLICE = 1_000_000  # bytes of a text that are cut into terms at once
COUNTED = "doc_id long, n long, terms array<int>, times array<long>"
FOUND = "item_id long, doc_id long, score long"


@dataclass(frozen=True)
class SearchSpec:
    k: int = 10
    group_terms: int = 256  # terms that a group of several items asks for, at most
    docs: int = 8192  # documents in a tree, at most
    cells: int = 2_000_000  # documents x terms of a tree, at most (one document at least)
    leaf: int = 16
    part_bytes: int = 8_000_000


# --- terms ---------------------------------------------------------------------


def count_terms(text: str | None) -> tuple[int, Counter]:
    """How many terms the whole text has, and how often each occurs."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # of bytes: A-Z only
    if len(data) <= SLICE:
        found = TERM.findall(data)
        return len(found), Counter(found)
    total, counts, begin = 0, Counter(), 0
    while begin < len(data):
        cut = BREAK.search(data, begin + SLICE)
        end = cut.start() if cut else len(data)
        found = TERM.findall(data[begin:end])
        total, begin = total + len(found), end
        counts.update(found)
    return total, counts


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, number of terms, and which terms of the vocabulary occur how often; documents without terms left out."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            keep, totals, terms, times, ends = [], [], [], [], [0]
            for i, text in enumerate(batch.column("text")):
                total, counts = count_terms(text.as_py())
                if not total:
                    continue
                keep.append(i)
                totals.append(total)
                for term in counts.keys() & vocabulary.keys():
                    terms.append(number(term))
                    times.append(counts[term])
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(totals, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
                ],
                ["doc_id", "n", "terms", "times"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(each, COUNTED)


# --- weights -------------------------------------------------------------------


@dataclass(frozen=True)
class Corpus:
    """Documents with terms, all their terms, and the weight of each term of the vocabulary."""

    n_docs: int
    n_terms: int
    weights: np.ndarray

    def impacts(self, lengths: np.ndarray, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Impact of each (document, term); ``lengths`` has its document's number of terms."""
        if 90 * int(lengths.max(initial=0)) * self.n_docs < 2**63:
            scaled = 90 * lengths * self.n_docs // self.n_terms
        else:
            scaled = np.array([90 * int(n) * self.n_docs // self.n_terms for n in lengths.tolist()], np.int64)
        return self.weights[terms] * (1_000_000_000 * times // (1000 * times + 8 * (10 + scaled)))


def weight(n_docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))


# --- ball trees ----------------------------------------------------------------


class BallTree:
    """Rows of non-negative integers; nodes are ranges of reordered rows."""

    def __init__(self, rows: np.ndarray, leaf: int):
        points = rows.astype(np.float64)
        self.order = np.arange(len(rows))
        spans, centres, radii, children = [(0, len(rows))], [], [], []
        for begin, end in spans:  # grows as nodes are split
            at = self.order[begin:end]
            these = points[at]
            centre = these.mean(axis=0)
            apart = these - centre
            far = np.sqrt(np.einsum("ij,ij->i", apart, apart))
            centres.append(centre)
            radii.append(far.max() * (1 + 1e-9))
            if end - begin <= leaf or not far.max() > 0:
                children.append(None)
                continue
            cut = self._split(at, these, these[np.argmax(far)], begin)
            children.append((len(spans), len(spans) + 1))
            spans += [(begin, cut), (cut, end)]
        self.spans, self.children = spans, children
        self.centres, self.radii = np.stack(centres), np.array(radii)
        self.rows = rows[self.order]

    def _split(self, at: np.ndarray, these: np.ndarray, one: np.ndarray, begin: int) -> int:
        """Rows by the nearer of two far ones; in half along the line between them where that leaves one side almost empty."""
        apart = these - one
        other = these[np.argmax(np.einsum("ij,ij->i", apart, apart))]
        along = these @ (other - one)
        by = np.argsort(along, kind="stable")
        self.order[begin : begin + len(at)] = at[by]
        near = int(np.searchsorted(along[by], (one + other) @ (other - one) / 2))
        return begin + (near if len(at) <= 8 * min(near, len(at) - near) else len(at) // 2)

    def bounds(self, items: np.ndarray) -> np.ndarray:
        """No row of node i has a larger product with item j than [i, j]; items are 0/1 columns."""
        reach = self.radii[:, None] * np.sqrt(items.sum(axis=0))[None, :]
        return (self.centres @ items + reach) * (1 + 1e-9) + 1


class Best:
    """The k best of one item so far."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        """A score below it cannot be among the k best."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        new = scores >= self.floor
        if new.any():
            ids, scores = np.concatenate((self.ids, ids[new])), np.concatenate((self.scores, scores[new]))
            by = np.lexsort((ids, -scores))[: self.k]
            self.ids, self.scores = ids[by], scores[by]


def descend(tree: BallTree, ids: np.ndarray, columns: np.ndarray, bounds: list[float], best: Best) -> int:
    """Search one item (its columns) best-first; ``ids`` in the tree's order. Returns the number of rows scored."""
    waiting, scored = [(-bounds[0], 0)], 0
    while waiting and -waiting[0][0] >= best.floor:
        _, node = heapq.heappop(waiting)
        if tree.children[node] is None:
            begin, end = tree.spans[node]
            best.add(ids[begin:end], tree.rows[begin:end, columns].sum(axis=1))
            scored += end - begin
        else:
            for child in tree.children[node]:
                if bounds[child] >= best.floor:
                    heapq.heappush(waiting, (-bounds[child], child))
    return scored


# --- items ---------------------------------------------------------------------


def group_items(items: list[np.ndarray], n_terms: int, most: int) -> list[list[int]]:
    """Numbers of items in groups that ask for at most ``most`` terms; each holds similar items, one at least."""
    groups, todo = [], [list(range(len(items)))]
    while todo:
        these = todo.pop()
        terms = np.concatenate([items[i] for i in these])
        if len(these) == 1 or len(np.unique(terms)) <= most:
            groups.append(these)
            continue
        of = np.repeat(np.arange(len(these)), [len(items[i]) for i in these])

        def shared(with_item: int) -> np.ndarray:
            asked = np.zeros(n_terms, bool)
            asked[items[with_item]] = True
            return np.bincount(of, asked[terms], len(these))

        first = shared(these[0])
        other = shared(these[int(np.argmin(first))])
        by = np.argsort(first - other, kind="stable")
        left = int((first < other).sum())
        cut = left if len(these) <= 8 * min(left, len(these) - left) else len(these) // 2
        todo += [[these[i] for i in by[:cut]], [these[i] for i in by[cut:]]]
    return groups


class Group:
    """Items searched in one tree: their terms are its columns."""

    def __init__(self, numbers: list[int], items: list[np.ndarray], n_terms: int):
        self.numbers = numbers
        self.terms = np.unique(np.concatenate([items[i] for i in numbers]))
        self.column = np.full(n_terms, -1, np.int32)
        self.column[self.terms] = np.arange(len(self.terms))
        self.columns = [self.column[items[i]] for i in numbers]
        self.items = np.zeros((len(self.terms), len(numbers)))
        for j, columns in enumerate(self.columns):
            self.items[columns, j] = 1.0


def search_block(block: tuple, groups: list[Group], best: list[Best], spec: SearchSpec) -> tuple[int, int]:
    """One block of documents (ids, and (row, term, impact) entries) for all items; (rows scored, rows there were)."""
    ids, row, term, impact = block
    scored = offered = 0
    for group in groups:
        at = np.flatnonzero(group.column[term] >= 0)
        members = np.unique(row[at])
        size = max(1, min(spec.docs, spec.cells // len(group.terms)))
        for begin in range(0, len(members), size):
            some = members[begin : begin + size]
            first, last = np.searchsorted(row[at], (some[0], some[-1] + 1))  # entries come by row
            of = at[first:last]
            rows = np.zeros((len(some), len(group.terms)), np.int64)
            rows[np.searchsorted(some, row[of]), group.column[term[of]]] = impact[of]
            tree = BallTree(rows, spec.leaf)
            own = ids[some][tree.order]
            bounds = tree.bounds(group.items).T.tolist()
            for number, columns, bound in zip(group.numbers, group.columns, bounds, strict=True):
                scored += descend(tree, own, columns, bound, best[number])
            offered += len(some) * len(group.numbers)
    return scored, offered


def _search(item_ids: list[int], items: list[np.ndarray], corpus: Corpus, spec: SearchSpec):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_terms = len(corpus.weights)
        groups = [Group(g, items, n_terms) for g in group_items(items, n_terms, spec.group_terms)]
        best = [Best(spec.k) for _ in items]
        for block in _blocks(batches, corpus, spec.docs):
            search_block(block, groups, best, spec)
        lengths = [len(b.ids) for b in best]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(item_ids, np.int64), lengths)),
                pa.array(np.concatenate([b.ids for b in best])), pa.array(np.concatenate([b.scores for b in best])),
            ],
            ["item_id", "doc_id", "score"],
        )

    return each


def _blocks(batches: Iterator[pa.RecordBatch], corpus: Corpus, docs: int) -> Iterator[tuple]:
    def joined(parts: list[pa.RecordBatch]) -> tuple:
        table = pa.Table.from_batches(parts).combine_chunks()
        terms, times = table.column("terms").combine_chunks(), table.column("times").combine_chunks()
        held = np.diff(terms.offsets.to_numpy())
        row = np.repeat(np.arange(table.num_rows), held)
        term, lengths = terms.flatten().to_numpy(), table.column("n").to_numpy()
        impact = corpus.impacts(lengths[row], term, times.flatten().to_numpy())
        some = impact > 0
        return table.column("doc_id").to_numpy(), row[some], term[some], impact[some]

    parts, held = [], 0
    for whole in batches:
        for begin in range(0, whole.num_rows, 512):
            parts.append(whole.slice(begin, 512))
            held += parts[-1].num_rows
            if held >= docs:
                yield joined(parts)
                parts, held = [], 0
    if parts:
        yield joined(parts)


def _parts(spark: SparkSession, items: DataFrame, part_bytes: int) -> tuple[DataFrame, int]:
    rows = items.filter("item_id IS NOT NULL").groupBy(F.col("item_id").cast("long").alias("item_id"))
    rows = written(spark, rows.agg(F.max(F.col("text").cast("string")).alias("text")))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // part_bytes))
    return rows.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(n))), n


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, spec: SearchSpec | None = None) -> DataFrame:
    spec = spec or SearchSpec()
    parts, n_parts = _parts(spark, items, spec.part_bytes)
    out = None
    for part in range(n_parts):
        found = _search_part(spark, docs, parts.filter(F.col("part") == part), spec)
        if n_parts > 1:
            found = written(spark, found)  # nothing of a part stays behind but its results
        out = found if out is None else out.unionByName(found)
    return out


def _search_part(spark: SparkSession, docs: DataFrame, items: DataFrame, spec: SearchSpec) -> DataFrame:
    asked = {r.item_id: count_terms(r.text)[1] for r in items.select("item_id", "text").collect()}
    asked = {i: terms for i, terms in sorted(asked.items()) if terms}
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*asked.values())))}
    if not vocabulary:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    numbers = [np.array(sorted(vocabulary[t] for t in terms), np.int64) for terms in asked.values()]
    rows = written(spark, counted(docs, vocabulary))
    n_docs, n_terms = rows.agg(F.count("*"), F.sum("n")).first()
    holding = np.zeros(len(vocabulary), np.int64)
    for term, n in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holding[term] = n
    weights = np.array([weight(n_docs, n) for n in holding.tolist()], np.int64)
    corpus = Corpus(n_docs, n_terms or 1, weights)
    ranked = rows.filter("doc_id IS NOT NULL AND size(terms) > 0")
    best = ranked.mapInArrow(_search(list(asked), numbers, corpus, spec), FOUND)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= spec.k)
    return best.select("item_id", "rank", "doc_id", "score")
