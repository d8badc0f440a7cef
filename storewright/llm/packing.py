"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents are tokenized where they are read; a longer one is cut into whole
sequences, its first piece taking the remainder. Whole pieces are sequences of
their own. The others are packed by best-fit decreasing: a segment tree over
the remaining capacities finds the tightest open bin in logarithmic time. The
packing runs in many groups of bounded size, dealt by row number, so that no
key can make a group large; a group wastes about one bin in thousands.

Defined results: a null text is empty (one end token); a null id is kept;
repeated rows are packed each; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storewright.llm.tokens import SLICE_BYTES, byte_bpe
from storewright.llm.workers import arrow_batches, give_back, releasing
from storewright.session import shared_folder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class CapacityTree:
    """Open bins by remaining capacity: how many, and which."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, room: int, number: int) -> None:
        heapq.heappush(self.bins[room], number)
        self._change(room, 1)

    def take(self, room: int) -> int:
        self._change(room, -1)
        return heapq.heappop(self.bins[room])

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity of an open bin that holds ``need``."""
        count, node = self.count, need + self.size
        if count[node]:
            return need
        while node > 1:
            if not node & 1 and count[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if count[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def best_fit_decreasing(lengths: Iterable[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length; the lengths come in falling order."""
    tree, placed, bins = CapacityTree(capacity), [], 0
    for need in lengths:
        room = tree.tightest(need)
        if room is None:
            number, room, bins = bins, capacity, bins + 1
        else:
            number = tree.take(room)
        placed.append((number, capacity - room))
        if room > need:
            tree.add(room - need, number)
    return placed


def cut_pieces(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of little-endian 32-bit ids; only the first piece may be short."""
    total = len(ids) // 4
    start, stop = 0, total % capacity or min(total, capacity)
    piece = 0
    while start < total:
        yield piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])
        piece, start, stop = piece + 1, stop, stop + capacity


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = byte_bpe(tokenizer), end_id.to_bytes(4, "little")
        for batch in batches:
            rows = [
                (doc, *piece)
                for doc, ids in zip(batch.column(0).to_pylist(), bpe.ids(batch.column(1)), strict=True)
                for piece in cut_pieces(ids + end, capacity)
            ]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )
            give_back()

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(releasing(cut), PIECES)


def pack(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    capacity: int = 1024,
    group_pieces: int = 16_384,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    path = shared_folder(spark)
    # An executor holds a batch several times over, in the JVM and in Python.
    with arrow_batches(spark, SLICE_BYTES):
        token_pieces(docs, tokenizer, end_id, capacity).write.parquet(path)
    # The rows of a written table have fixed numbers, also when a task runs again.
    pieces = spark.read.parquet(path).withColumn("row", F.monotonically_increasing_id())
    short = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group_pieces))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row"], ascending=[False, True], kind="stable")
        placed = best_fit_decreasing(rows["length"].tolist(), capacity)
        group = int(rows["part"].iloc[0]) << 32
        rows["sequence_id"] = [group + b for b, _ in placed]
        rows["offset"] = [o for _, o in placed]
        return rows.drop(columns=["row", "part"])

    schema = PIECES + ", sequence_id long, offset long"
    dealt = short.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(groups)))
    packed = dealt.groupBy("part").applyInPandas(place, schema)
    whole = pieces.filter(F.col("length") >= capacity).select(
        *[c.split()[0] for c in PIECES.split(", ")],
        (-1 - F.col("row")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(whole)
