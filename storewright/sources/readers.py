"""Tables in: Parquet or CSV with a schema, folders of exports, JDBC."""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from storewright.schemas import rename_columns


def read_table(spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet") -> DataFrame:
    """One table. CSV needs a schema: types are never guessed from the data."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "parquet":
        return reader.parquet(path)
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV table needs a schema")
        # The header is compared with the schema: columns in another order are an error, not other values.
        return reader.csv(path, header=True, encoding="UTF-8", multiLine=False, enforceSchema=False)
    raise ValueError(f"unsupported format {fmt!r}")


def header_forms(spark: SparkSession, path: str, name_contains: str = "") -> list[tuple[list[str], list[str]]]:
    """(column names, files) for each distinct header line among the CSV files of a folder; files without a line left out.

    The first line of a file is the least row number of its first block. Row
    numbers alone are grouped, one per file and task in the shuffle.
    """
    lines = (
        spark.read.option("pathGlobFilter", f"*{name_contains}*")
        .text(path)
        .filter(F.col("_metadata.file_block_start") == 0)
        .select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("row"))
    )
    first = lines.groupBy("file").agg(F.min("row").alias("row"))
    heads = lines.join(first, ["file", "row"]).select("file", F.ltrim("value", F.lit("\ufeff")).alias("header"))
    # A row per header form, with the names of its files, which the driver lists for any scan.
    forms = heads.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [(_unique([n.strip() for n in next(csv.reader([r.header]), [])]), r.files) for r in forms.orderBy("header").collect()]


def _unique(names: list[str]) -> list[str]:
    """A repeated name gets a number; the first of its columns keeps the name."""
    seen: Counter[str] = Counter()
    out = []
    for name in names:
        out.append(f"{name}.{seen[name]}" if seen[name] else name)
        seen[name] += 1
    return out


def read_folder(
    spark: SparkSession,
    path: str,
    schema: str,
    name_contains: str = "",
    fmt: str = "csv",
    required: Sequence[str] = (),
    corrupt: str | None = None,
) -> DataFrame:
    """All files of a folder whose name contains a text, stacked by column name, with ``file_name``.

    Files may have their columns in any order, lack some (NULL then) and have
    others (not read). A file without one of the ``required`` columns is an error at
    plan time. CSV files are read per header form, each form in one scan. With
    ``corrupt``, a column of that name holds the line of every row with a value
    that does not fit its type; without it such a value is NULL.
    """
    if fmt != "csv":
        files = spark.read.schema(schema).option("pathGlobFilter", f"*{name_contains}*").parquet(path)
        return files.select("*", F.col("_metadata.file_name").alias("file_name"))
    fields = StructType.fromDDL(schema).fields
    name = F.col("_metadata.file_name").alias("file_name")
    out = spark.createDataFrame([], StructType([*fields, StructField("file_name", StringType())]))
    if corrupt:
        out = out.withColumn(corrupt, F.lit(None).cast("string"))
    for names, files in header_forms(spark, path, name_contains):
        missing = [c for c in required if c not in names]
        if missing:
            raise ValueError(f"missing columns {missing} in {files[:3]}; found {names}")
        form = _csv(spark, names, fields, corrupt).csv(files)
        columns = [
            F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in fields
        ]
        out = out.unionByName(form.select(*columns, name, *([corrupt] if corrupt else [])))
    return out


def _csv(spark: SparkSession, names: list[str], fields: list[StructField], corrupt: str | None) -> DataFrameReader:
    """A reader of CSV files with these columns, typed where the wanted fields say so. Spark prunes the others in the scan."""
    wanted = {f.name: f.dataType for f in fields}
    kinds = [StructField(n, wanted.get(n, StringType())) for n in names]
    reader = spark.read.options(header=True, encoding="UTF-8")
    if corrupt:
        kinds.append(StructField(corrupt, StringType()))
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(StructType(kinds))


def read_stock_exports(
    spark: SparkSession,
    path: str,
    schema: str,
    names: dict[str, str] | None = None,
    corrupt: str | None = None,
    blank_text: bool = False,
) -> DataFrame:
    """Stock exports, one ``title=...`` folder per product, all in one scan.

    ``schema`` lists the file's own columns, all of them in their order: the header
    is checked against it. ``names`` renames those that are wanted (source -> ours);
    the scan reads no others. An empty export adds no rows. With ``corrupt``, a
    column of that name holds the line of every row with a value that does not fit
    its type, and ``file_name`` says where it stands. With ``blank_text``, a quoted
    empty cell is an empty text and not NULL, as `write_adjustments` writes it.
    """
    extra = f", `{corrupt}` string" if corrupt else ""
    reader = spark.read.schema(f"{schema}, title string{extra}").options(header=True, encoding="UTF-8", enforceSchema=False)
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    if blank_text:
        reader = reader.option("nullValue", "\\N")
    stock = reader.csv(path)
    if corrupt:
        stock = stock.withColumn("file_name", F.col("_metadata.file_path"))
    if names is None:
        return stock
    kept = {**names, "title": "title"} | ({corrupt: corrupt, "file_name": "file_name"} if corrupt else {})
    return rename_columns(stock, kept)


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition: tuple[str, object, object, int] | None = None,
    **options: str,
) -> dict[str, str]:
    """Options of a JDBC read: a table or a query, optionally split into ranges.

    ``partition`` is (column, lower bound, upper bound, number of ranges). Spark
    splits tables only, so a query that is to be split goes in as a derived
    table. Credentials and driver are passed through ``options``.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    out = {"url": url, **options}
    if partition is None:
        out["dbtable" if query is None else "query"] = table or query
        return out
    column, lower, upper, ranges = partition
    out["dbtable"] = table or f"({query}) q"
    out.update(
        partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(ranges)
    )
    return out


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    key: str | None = None,
    ranges: int | None = None,
    small: bool = False,
    **options: str,
) -> DataFrame:
    """A table or a query of a database; a database error fails the job.

    ``key``, a column of numbers, dates or timestamps, splits the read into
    ``ranges`` between its least and greatest value, which are asked first; rows
    without a key go with the first range. Without a key one task reads everything,
    so that has to be asked for by ``small``.
    """
    if (key is None) == (not small) or (key is None) != (ranges is None):
        raise ValueError("give a key and the number of ranges, or say that the read is small")
    source = jdbc_options(url, table, query, **options)
    if key is not None:
        asked = {**jdbc_options(url, query=bounds_query(key, table, query)), **options}
        least, greatest = spark.read.format("jdbc").options(**asked).load().first()
        if least is not None:
            source = jdbc_options(url, table, query, (key, least, greatest, ranges), **options)
    return spark.read.format("jdbc").options(**source).load()


def bounds_query(key: str, table: str | None = None, query: str | None = None) -> str:
    """The least and the greatest key, in SQL."""
    return f"SELECT MIN({key}) AS least, MAX({key}) AS greatest FROM {table or f'({query}) q'}"
