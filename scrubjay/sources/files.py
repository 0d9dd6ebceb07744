"""File sources and sinks, schema inspection and column renaming."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from scrubjay.functions.inference import cast_inferred, infer_types
from scrubjay.sources import versions


# Both sides of a CSV file must agree on these, or texts change on the way: quotes are doubled, outer spaces are kept,
# line feeds may stand within quotes, an empty text is written as two quotes and a null as nothing.
_CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False}
# What the reader takes for null: a field without quotes and text. The marker itself cannot be a text field's value.
_NULL_MARK = "\u0001null\u0001"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             infer: bool = False, multi_line: bool = True) -> DataFrame:
    """CSV scan with a header row; reads back what ``write_csv`` wrote without loss.

    An explicit schema avoids the extra full pass that inference needs; with
    ``infer`` every column gets the narrowest type that no value fails
    (``functions.inference``, one aggregate pass), and without either every
    column is text. With ``multi_line`` texts may hold line feeds, but a file is
    then one task; for large texts prefer Parquet, or pass ``multi_line=False``
    where no field holds a line feed.
    """
    reader = spark.read.options(**_CSV).options(nullValue=_NULL_MARK, emptyValue="", multiLine=multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.csv(path)
    return cast_inferred(rows, infer_types(rows)) if infer and schema is None else rows


def write_csv(df: DataFrame, path: str, single_file: bool = False, order: Sequence[str | Column] = ()) -> str:
    """Write a folder of CSV files with a header row each (no index); with ``single_file``, one file at ``path`` itself.

    With ``order`` the rows are range-partitioned and sorted, so the files in the order of their names hold them in
    order. A single file is joined from such files (``join_files``), so all the work above it and the
    formatting keep their tasks. What lies at ``path`` is replaced only once the new file is whole.
    """
    out = df.orderBy(*order) if order else df
    if not single_file:
        _csv_writer(out, header=True).csv(path)
        return path
    spark = df.sparkSession
    parts = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}"
    _csv_writer(out, header=False).csv(f"{parts}/rows")
    names = spark.createDataFrame([tuple(df.columns)], ", ".join(f"c{i} string" for i in range(len(df.columns))))
    _csv_writer(names.coalesce(1), header=False).csv(f"{parts}/head")
    join_files(spark, [f"{parts}/head", f"{parts}/rows"], path)
    fs, target = _file_system(spark, parts)
    fs.delete(target, True)
    return path


def _csv_writer(df: DataFrame, header: bool):
    return df.write.mode("overwrite").options(**_CSV).options(header=header, nullValue="", emptyValue='""')


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


_PART = re.compile(r"part-(\d+)-.*?(?:-c(\d+))?(?:\.|$)")


def join_files(spark: SparkSession, folders: Sequence[str], path: str) -> int:
    """Joins the part files of ``folders``, in their order, to one file at ``path``; returns how many there were.

    HDFS joins files by their blocks (``concat``), so no byte moves. A file system without that gets the
    bytes copied through a buffer of fixed size by Hadoop's client, which is as slow as one file's writer has to be; there,
    prefer the folder of parts for a large result. The file appears under its name by a rename.
    """
    found = []
    for folder in folders:
        fs, at = _file_system(spark, folder)
        parts = [s.getPath() for s in fs.listStatus(at) if s.getLen() and s.getPath().getName().startswith("part-")]
        found += sorted(parts, key=lambda p: tuple(int(n or 0) for n in _PART.match(p.getName()).groups()))
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    fs, target = _file_system(spark, path)
    _, whole = _file_system(spark, f"{path.rstrip('/')}.whole-{uuid.uuid4().hex}")
    out = fs.create(whole, False)
    if found:
        try:
            out.close()
            listed = gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(found))
            for i, part in enumerate(found):
                listed[i] = part
            fs.concat(whole, listed)
        except UnsupportedOperationException:
            out = fs.create(whole, True)
            try:
                for part in found:
                    piece = fs.open(part)
                    try:
                        jvm.org.apache.hadoop.io.IOUtils.copyBytes(piece, out, 1 << 20, False)
                    finally:
                        piece.close()
            finally:
                out.close()
    else:
        out.close()
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(whole, target):
        raise OSError(f"{path} could not be put in place")
    return len(found)


def save_table(df: DataFrame, path: str | None = None, table: str | None = None,
               partition_by: list[str] | None = None) -> DataFrame:
    """Overwrite a Parquet table (path or catalog name) and return a scan of it.

    Reading back what was written cuts the lineage, so later validation runs on
    the saved rows, not on a recomputation. A path is a versioned table
    (``sources.versions``): the new rows replace the old in one rename, may be
    computed from them and may have another schema.
    """
    spark = df.sparkSession
    if table is not None:
        writer = df.write.mode("overwrite").format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(table)
        return spark.table(table)
    if path is None:
        raise ValueError("give a path or a table name")
    return versions.publish(df, path, partition_by)


def snake_case(name: str) -> str:
    """Lower-case words joined by ``_``: a word is a run of letters and digits of any script.

    A name that would start with a digit gets a leading ``_``, so that it needs no quoting in SQL.
    """
    words = "".join(ch if ch.isalnum() else " " for ch in name.lower()).split()
    joined = "_".join(words)
    return f"_{joined}" if joined[:1].isdigit() else joined


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case; refuse empty names and collisions."""
    new = [snake_case(c) for c in df.columns]
    empty = [old for old, n in zip(df.columns, new) if not n]
    if empty:
        raise ValueError(f"columns clean to an empty name: {empty}")
    seen: dict[str, str] = {}
    clashes = []
    for old, n in zip(df.columns, new):
        if n in seen:
            clashes.append((seen[n], old, n))
        seen.setdefault(n, old)
    if clashes:
        raise ValueError(f"column names collide after cleaning: {clashes}")
    return df.toDF(*new)


def schema_report(df: DataFrame, expected: T.StructType | None = None) -> DataFrame:
    """One row per field: position, name, type and nullability.

    With ``expected`` given, adds the expected type and a match flag. The rows
    come from the schema (metadata), so their number is the column count.
    """
    spark = df.sparkSession
    exp = {f.name: f.dataType.simpleString() for f in (expected.fields if expected else [])}
    rows = [(i + 1, f.name, f.dataType.simpleString(), bool(f.nullable),
             exp.get(f.name), (exp.get(f.name) == f.dataType.simpleString()) if expected else None)
            for i, f in enumerate(df.schema.fields)]
    schema = ("ordinal_position int, column_name string, data_type string, is_nullable boolean, "
              "expected_type string, type_matches boolean")
    out = spark.createDataFrame(rows, schema)
    return out if expected else out.drop("expected_type", "type_matches")
