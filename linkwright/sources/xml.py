"""XML dump loading.

A dump is a folder of ``*.xml`` files, one table per file:
``<root name="T"><Row><col>text</col>...</Row>...</root>``. Two Spark jobs:

1. **Discovery** -- one small task per file (a ``mapInPandas`` over the file
   listing) streams the file with ``iterparse`` and reports the table name
   (root attribute ``name``, else root tag), the row tag (``Row`` found at any
   depth, else the root's children when every child has children) and, for
   files without rows, the columns of the first child. The scan stops at the
   first ``Row``; memory stays constant because parsed elements are cleared.
   Rows that are the root's children may have tags that also occur deeper in
   the file; discovery says so, and names the columns of such files.
2. **Rows** -- Spark's XML source reads all files of one ``(table, row tag)``
   in parallel, every value as text (no type inference, spaces kept, empty
   element -> NULL, attributes dropped). Files of one table are combined with
   ``unionByName(allowMissingColumns=True)``, so a column that only some rows
   or files have is NULL elsewhere (schema evolution, S5). Spark's source finds a
   row tag at any depth, so files whose child tags also occur deeper are streamed
   instead, one task a file: only direct children of the root are rows.

Shapes: a repeated tag keeps its first value; a nested element keeps its own
text before the first child (``_VALUE``) or NULL. Declared difference: a
``Row`` nested inside a ``Row`` is read as part of the outer row only.
"""

from __future__ import annotations

import io
import itertools
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, LongType, StringType, StructField,
                               StructType)

ROW_TAG = "Row"
XML_READ_OPTIONS = {"inferSchema": "false", "ignoreSurroundingSpaces": "false",
                    "nullValue": "", "excludeAttribute": "true", "mode": "FAILFAST"}
_DISCOVERY_SCHEMA = ("path string, table_name string, row_tag string, "
                     "empty_columns array<string>, direct boolean")
# Row tag of files that are streamed: rows are the root's children, whatever their tags.
DIRECT = ""
_ROWS_PER_BATCH = 5000


def _open(path: str):
    """Open a file of any Hadoop-style URI from a Python worker."""
    if path.startswith("file:"):
        local = path[5:]
        while local.startswith("//"):
            local = local[1:]
        return open(local, "rb")
    import pyarrow.fs as pafs
    fs, inner = pafs.FileSystem.from_uri(path)
    return fs.open_input_stream(inner)


def _local_name(tag: str) -> str:
    return tag.rsplit("}", 1)[-1] if isinstance(tag, str) else str(tag)


def inspect_xml(stream) -> tuple[str, str | None, list[str] | None, bool]:
    """(table_name, row_tag, columns, direct) of one XML document; ``direct`` when rows are the root's
    children and a child's tag also occurs deeper. Columns are those of direct rows, or of an empty document."""
    depth = 0
    root_name = None
    child_tags: dict[str, None] = {}   # distinct, in order
    deeper: set[str] = set()
    columns: dict[str, None] = {}
    all_children_nested = True
    first_child_cols: list[str] | None = None
    current_has_children = False
    current_cols: list[str] = []
    root = None
    for event, elem in ET.iterparse(stream, events=("start", "end")):
        tag = _local_name(elem.tag)
        if event == "start":
            depth += 1
            if depth == 1:
                root = elem
                root_name = elem.attrib.get("name") or tag
            elif tag == ROW_TAG:
                return root_name, ROW_TAG, None, False
            elif depth == 2:
                child_tags[tag] = None
                current_has_children = False
                current_cols = []
            else:
                deeper.add(tag)
                if depth == 3:
                    current_has_children = True
                    current_cols.append(tag)
                    columns[tag] = None
        else:
            if depth == 2:
                all_children_nested &= current_has_children
                if first_child_cols is None:
                    first_child_cols = list(current_cols)
                root.clear()   # drop finished children: memory stays constant
            elif depth > 2:
                elem.clear()
            depth -= 1
    if child_tags and all_children_nested:
        if deeper.isdisjoint(child_tags):
            return root_name, "|".join(child_tags), None, False
        return root_name, DIRECT, list(columns), True
    return root_name, None, first_child_cols or [], False


def direct_rows(stream) -> Iterator[dict[str, str | None]]:
    """The root's children as rows: first element of each tag, its own text before its first child; an empty
    element, or one with children and only white space before them, is NULL."""
    depth, root, row = 0, None, {}
    for event, elem in ET.iterparse(stream, events=("start", "end")):
        if event == "start":
            depth += 1
            if depth == 1:
                root = elem
            elif depth == 2:
                row = {}
            continue
        if depth == 3:
            text = elem.text or None
            if len(elem) and text is not None and not text.strip():
                text = None
            row.setdefault(_local_name(elem.tag), text)
        elif depth == 2:
            yield row
            root.clear()   # drop finished children: memory stays constant
        depth -= 1


def _stream_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            with _open(path) as fh:
                rows = direct_rows(io.BufferedReader(fh) if not hasattr(fh, "peek") else fh)
                while held := list(itertools.islice(rows, _ROWS_PER_BATCH)):
                    yield pd.DataFrame({"cells": held})


def read_direct_rows(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """The rows of files whose rows are the root's children, every column as text; one task a file."""
    files = spark.read.format("binaryFile").load(paths).select("path").repartition(len(paths))
    cells = files.mapInPandas(_stream_rows, "cells map<string,string>")
    return cells.select(*[F.col("cells").getItem(c).alias(c) for c in columns])


def _discover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for path in batch["path"]:
            with _open(path) as fh:
                out.append((path, *inspect_xml(io.BufferedReader(fh) if not hasattr(fh, "peek") else fh)))
        yield pd.DataFrame(out, columns=["path", "table_name", "row_tag", "empty_columns", "direct"])


def discover(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """One row per ``*.xml`` file of one or more folders:
    ``(path, table_name, row_tag, empty_columns, direct)``."""
    folders = [folder] if isinstance(folder, str) else list(folder)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.xml")
             .load(folders).select("path"))
    return files.mapInPandas(_discover, _DISCOVERY_SCHEMA)


def _flatten_field(field: StructField):
    """A text column for one inferred field (first value / own text)."""
    c = F.col(f"`{field.name}`")
    dt = field.dataType
    if isinstance(dt, ArrayType):
        c, dt = F.get(c, 0), dt.elementType
    if isinstance(dt, StructType):
        names = [f.name for f in dt.fields]
        c = c.getField("_VALUE").cast("string") if "_VALUE" in names else F.lit(None).cast("string")
    else:
        c = c.cast("string")
    return c.alias(field.name)


def _holds(dt, tag: str) -> bool:
    """Whether a type has a field named ``tag`` at any depth."""
    if isinstance(dt, ArrayType):
        return _holds(dt.elementType, tag)
    return isinstance(dt, StructType) and any(f.name == tag or _holds(f.dataType, tag) for f in dt.fields)


def _with_inner(df: DataFrame, tag: str) -> list[DataFrame]:
    """The rows of ``df`` and those of every ``tag`` element inside them."""
    frames = [df]
    for f in df.schema.fields:
        nested = f.dataType.elementType if isinstance(f.dataType, ArrayType) else f.dataType
        if not isinstance(nested, StructType) or not (f.name == tag or _holds(nested, tag)):
            continue
        c = F.col(f"`{f.name}`")
        c = F.explode(c) if isinstance(f.dataType, ArrayType) else c
        inner = df.select(c.alias("_inner")).where("_inner is not null").select("_inner.*")
        found = _with_inner(inner, tag)
        frames += found if f.name == tag else found[1:]
    return frames


def read_rows(spark: SparkSession, paths: list[str], row_tag: str) -> DataFrame:
    """All rows with ``row_tag`` of the given files, inner ones included, every column as text."""
    df = spark.read.format("xml").options(**XML_READ_OPTIONS).option("rowTag", row_tag).load(paths)
    out = None
    for frame in _with_inner(df, row_tag):
        flat = frame.select(*[_flatten_field(f) for f in frame.schema.fields if f.name != "_VALUE"])
        out = flat if out is None else out.unionByName(flat, allowMissingColumns=True)
    return out


def _empty_table(spark: SparkSession, columns: list[str]) -> DataFrame:
    if columns:
        schema = StructType([StructField(c, StringType(), True)
                             for c in dict.fromkeys(columns)])
    else:
        schema = StructType([StructField("id", LongType(), True)])
    return spark.createDataFrame([], schema)


def load_xml_dump(spark: SparkSession, folder: str | list[str]) -> dict[str, DataFrame]:
    """Every table of an XML dump (M10), one folder or several ->
    ``{table_name: DataFrame}``.

    The discovery result is file metadata (one row per file), so it is
    collected to plan one XML read per ``(table, row tag)``.
    """
    found = discover(spark, folder).collect()
    groups: dict[tuple[str, str], list[str]] = {}
    empties: dict[str, list[str]] = {}
    direct: dict[str, tuple[list[str], dict[str, None]]] = {}
    for r in found:
        if r["direct"]:
            files, columns = direct.setdefault(r["table_name"], ([], {}))
            files.append(r["path"])
            columns.update(dict.fromkeys(r["empty_columns"]))
        elif r["row_tag"] is None:
            empties.setdefault(r["table_name"], list(r["empty_columns"] or []))
        else:
            for tag in r["row_tag"].split("|"):
                groups.setdefault((r["table_name"], tag), []).append(r["path"])
    tables: dict[str, DataFrame] = {}
    for (table, tag), paths in sorted(groups.items()):
        df = read_rows(spark, sorted(paths), tag)
        tables[table] = (tables[table].unionByName(df, allowMissingColumns=True)
                         if table in tables else df)
    for table, (paths, columns) in sorted(direct.items()):
        df = read_direct_rows(spark, sorted(paths), list(columns))
        tables[table] = (tables[table].unionByName(df, allowMissingColumns=True)
                         if table in tables else df)
    for table, cols in empties.items():
        if table not in tables:
            tables[table] = _empty_table(spark, cols)
    return tables


def write_xml(df: DataFrame, path: str, table_name: str, root_tag: str = "table",
              mode: str = "errorifexists") -> None:
    """Write a table in the dump layout: every value as text, one element per
    column inside ``<Row>``, root element named by attribute."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    (text.write.mode(mode).format("xml").option("rowTag", ROW_TAG)
     .option("rootTag", f'{root_tag} name="{table_name}"').save(path))


def save_dump(tables: dict[str, DataFrame], target: str, mode: str = "overwrite",
              fmt: str = "parquet", database: str | None = None) -> None:
    """Write every loaded table (S7, S8): under ``target/<table>`` or, with
    ``database``, as catalog tables ``database.<table>``. The default
    ``overwrite`` makes a re-run idempotent; ``append`` adds rows instead."""
    for name, df in tables.items():
        writer = df.write.mode(mode).format(fmt)
        if database:
            writer.saveAsTable(f"{database}.{name}")
        else:
            writer.save(f"{target.rstrip('/')}/{name}")
