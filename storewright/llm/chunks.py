"""Documents in chunks of bounded size, and arrays as compact bytes.

Operators that look something up about every part of every text would move far
more rows than the text has bytes if each part were a Spark row. Here a chunk of
a few megabytes of text is one row, and what it asks or learns is a packed array
per bucket of keys, so Spark shuffles a few rows per chunk and bucket.

The chunk table is written once to the shared folder, bucketed by chunk: later
steps read it where it lies, and only the small answers are shuffled to it. Its
numbers are fixed by the written files, so tasks can run again at any time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from storewright.llm.workers import give_back, releasing
from storewright.session import shared_folder

CHUNK_BYTES = 8_000_000
CHUNK = "chunk long, n_bytes long, ids binary, known binary, sizes binary, data binary, rest binary"
NO_TEXT = "text is null"
NO_ID = np.int64(2**63 - 1)


def pack(values: np.ndarray, delta: bool = False) -> bytes:
    """A numeric array, compressed byte plane by byte plane; ``delta`` for sorted unsigned integers."""
    values = np.ascontiguousarray(values)
    if delta and len(values):
        values = np.concatenate((values[:1], values[1:] - values[:-1]))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T) if len(values) else b""
    head = f"{values.dtype.str},{int(delta)};".encode()
    return head + zstandard.ZstdCompressor(level=1).compress(bytes(planes))


def unpack(data: bytes) -> np.ndarray:
    head, _, body = data.partition(b";")
    kind, _, delta = head.decode().partition(",")
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    values = np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)
    return np.cumsum(values, dtype=kind) if delta == "1" else values


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


class Chunk:
    """The documents of one chunk: ids (null ids are the largest number), where each text begins and ends, all bytes."""

    def __init__(self, row: dict):
        self.chunk = row["chunk"]
        self.ids, self.known = unpack(row["ids"]), unpack(row["known"])
        self.sizes = unpack(row["sizes"])
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.data = zstandard.ZstdDecompressor().decompress(row["data"])
        self.rest = row["rest"]

    def rows(self, keep: np.ndarray, texts: list[bytes]) -> dict:
        """Whole input rows with these texts, of a chunk that carries its other columns; null texts stay null."""
        rest = pa.ipc.open_stream(self.rest).read_all().take(pa.array(keep))
        out = {n: rest.column(n) for n in rest.column_names if n != NO_TEXT}
        missing = rest.column(NO_TEXT).to_pylist()
        # A cut may part the bytes of a letter; what is left of it goes too.
        words = [None if no else t.decode("utf-8", "ignore") for t, no in zip(texts, missing, strict=True)]
        return out | {"doc_id": self.id_column().take(pa.array(keep)), "text": pa.array(words, pa.string())}

    def id_column(self) -> pa.Array:
        return pa.array(self.ids, pa.int64(), mask=~self.known)

    def texts(self) -> Iterator[bytes]:
        for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True):
            yield self.data[a:b]


def _stream(parts: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        for part in parts:
            writer.write_batch(part)
    return sink.getvalue().to_pybytes()


def _chunk_row(number: int, ids: list, texts: list[bytes], rest: bytes = b"") -> pa.RecordBatch:
    known = np.array([i is not None for i in ids], bool)
    values = np.array([NO_ID if i is None else i for i in ids], np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
    row = {
        "chunk": [number], "n_bytes": [int(sizes.sum())], "ids": [pack(values)], "known": [pack(known)],
        "sizes": [pack(sizes)], "data": [data], "rest": [rest],
    }
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], list(row))


def write_chunks(
    spark: SparkSession, docs: DataFrame, carry: bool = False, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """doc_id and text (null: empty) of all rows, in chunks, written and read again; with ``carry`` all other columns too."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")] if carry else []

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        ids, texts, rest, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            return _chunk_row(task << 16 | made, ids, texts, _stream(rest) if carry else b"")

        for batch in batches:
            begin, carried = 0, batch.select([NO_TEXT, *others]) if carry else None
            for n, (doc, text) in enumerate(zip(batch.column(0), batch.column(1), strict=True)):
                ids.append(doc.as_py())
                texts.append((text.as_py() or "").encode("utf-8", "surrogatepass"))
                size += len(texts[-1]) + 16
                if size >= chunk_bytes:
                    if carry:
                        rest.append(carried.slice(begin, n + 1 - begin))
                    yield flush()
                    ids, texts, rest, size, made, begin = [], [], [], 0, made + 1, n + 1
            if carry and begin < batch.num_rows:
                rest.append(carried.slice(begin))
        if ids:
            yield flush()

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"chunks_{uuid.uuid4().hex}"
    text = F.col("text").cast("string")
    more = [F.col("text").isNull().alias(NO_TEXT), *others] if carry else []
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"), *more).mapInArrow(releasing(gather), CHUNK)
    rows.write.bucketBy(buckets, "chunk").option("path", shared_folder(spark)).saveAsTable(name)
    return spark.table(name)


def bucket_count(chunks: DataFrame, bytes_each: int, most: int = 1 << 16) -> int:
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return int(max(1, min(most, -(-total // bytes_each))))


def with_chunk(
    chunks: DataFrame, answers: DataFrame, work: Callable[[Chunk, list[dict]], Iterator[dict]], schema: str | StructType
) -> DataFrame:
    """Per chunk its documents together with the answers (rows with a chunk column) that belong to it."""
    target = _arrow_schema(schema)

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        given = right.to_pylist()
        out = [pa.table(x, target) for row in left.to_pylist() for x in work(Chunk(row), given)]
        del given
        give_back()
        return pa.concat_tables(out) if out else target.empty_table()

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(both, schema)


def per_chunk(chunks: DataFrame, work: Callable[[Chunk], Iterator[dict]], schema: str) -> DataFrame:
    target = _arrow_schema(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                for out in work(Chunk(batch.slice(i, 1).to_pylist()[0])):
                    yield from pa.table(out, target).to_batches()

    return chunks.mapInArrow(releasing(each), schema)


def per_bucket(rows: DataFrame, keys: list[str], work: Callable[[list[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """All rows of a bucket at once; the number of buckets keeps that bounded."""
    target = _arrow_schema(schema)

    def each(table: pa.Table) -> pa.Table:
        out = [pa.table(x, target) for x in work(table.to_pylist())]
        give_back()
        return pa.concat_tables(out) if out else target.empty_table()

    return rows.groupBy(*keys).applyInArrow(each, schema)


def _arrow_schema(schema: str | StructType) -> pa.Schema:
    if isinstance(schema, StructType):
        return to_arrow_schema(schema)
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "string": pa.string(),
        "boolean": pa.bool_(),
    }
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] numbers, then the same for the next."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
