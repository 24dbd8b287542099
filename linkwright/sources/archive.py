"""Zipped CSV export landing.

Each module arrives as ``<module>_exportZoho.zip`` holding CSV files. Spark has
no ZIP codec, and a ZIP is not splittable, so each archive is one task: a
``mapInPandas`` over the file listing opens the archive by path, streams every
member through the ``csv`` module and emits one map per row, from column name to
text. Members are told apart, so their headers may differ; a member of a header
alone still gives its columns. A row longer than its header, or a member that is
no CSV, raises. pandas' NA tokens become NULL. Only landed files are processed;
the HTTP export client of the reference is not part of this library.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import na_tokens_to_null
from ..session import is_shared, scratch_path

# Fixed value: the file name ending of the export archives.
ARCHIVE_SUFFIX = "_exportZoho.zip"

_ROWS_SCHEMA = ("archive string, member string, row_no long, "
                "header array<string>, cells map<string,string>")
_BATCH_ROWS = 10_000


def _open_archive(path: str):
    """A seekable file of any Hadoop-style URI, read by parts."""
    if path.startswith("file:"):
        return open("/" + path[5:].lstrip("/"), "rb")
    import pyarrow.fs as pafs
    fs, inner = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(inner)


def _member_rows(path: str, zf: zipfile.ZipFile) -> Iterator[tuple]:
    """(archive, member, row number, header, cells); row 0 bears the header."""
    for member in zf.namelist():
        if member.endswith("/"):
            continue
        if not member.lower().endswith(".csv"):
            raise ValueError(f"{path}: member {member!r} is no CSV file")
        with zf.open(member) as raw:
            reader = csv.reader(io.TextIOWrapper(raw, encoding="utf-8-sig", newline=""))
            header = next(reader, None)
            if header is None:
                continue
            yield path, member, 0, header, None
            for i, record in enumerate(reader, 1):
                if len(record) > len(header):
                    raise ValueError(f"{path}: {member!r} row {i} has {len(record)} fields, "
                                     f"its header has {len(header)}")
                if record:   # a blank line is no row
                    yield path, member, i, None, dict(zip(header, record))


def _read_archives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["archive", "member", "row_no", "header", "cells"]
    for batch in batches:
        for path in batch["path"]:
            rows = []
            with _open_archive(path) as raw, zipfile.ZipFile(raw) as zf:
                for row in _member_rows(path, zf):
                    rows.append(row)
                    if len(rows) >= _BATCH_ROWS:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)


def read_zip_rows(spark: SparkSession, path: str) -> DataFrame:
    """Long form of every CSV row in the ZIP archives at ``path`` (a file, a
    folder or a glob): ``(archive, member, row_no, header, cells)``."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
             .load(path).select("path"))
    return files.mapInPandas(_read_archives, _ROWS_SCHEMA)


def module_name(archive_path: str) -> str:
    """``Deals_exportZoho.zip`` and split exports ``Deals_exportZoho-<n>.zip``
    both belong to module ``Deals``."""
    name = archive_path.rstrip("/").rsplit("/", 1)[-1]
    marker = ARCHIVE_SUFFIX[:-4]
    if marker in name:
        return name.split(marker, 1)[0]
    return name.rsplit(".", 1)[0]


def load_zip_exports(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """One all-text table per module found in the archives.

    The archives are read once, into one folder per module; the distinct
    headers -- metadata -- name the columns, in order of first appearance.
    """
    module = F.regexp_replace(F.regexp_extract("archive", r"([^/]*)/*$", 1),
                              rf"({ARCHIVE_SUFFIX[:-4]}.*|\.[^.]*)$", "")
    staged = scratch_path(spark, "zip_rows")
    rows = read_zip_rows(spark, path).withColumn("module", module)
    rows.write.partitionBy("module").parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    headers = (rows.where("row_no = 0").groupBy("module", "header")
               .agg(F.min(F.struct("archive", "member")).alias("at")).orderBy("module", "at").collect())
    columns: dict[str, dict[str, None]] = {}
    for h in headers:
        columns.setdefault(h["module"], {}).update(dict.fromkeys(h["header"]))
    return {m: na_tokens_to_null(
                rows.where((F.col("module") == m) & (F.col("row_no") > 0))
                .select(*[F.col("cells")[c].alias(c) for c in names]))
            for m, names in columns.items()}


def _open_output(uri: str):
    if uri.startswith("file:") or uri.startswith("/"):
        local = uri[5:] if uri.startswith("file:") else uri
        while local.startswith("//"):
            local = local[1:]
        import os
        os.makedirs(local.rsplit("/", 1)[0], exist_ok=True)
        return open(local, "wb")
    import pyarrow.fs as pafs
    fs, inner = pafs.FileSystem.from_uri(uri)
    return fs.open_output_stream(inner)


def write_zip_export(df: DataFrame, folder: str, module: str) -> int:
    """Land a text table as zipped CSV exports: one archive per partition,
    ``<module>_exportZoho-<n>.zip``, each written by its own task. Returns the
    number of archives. Used to build landing folders (and test fixtures)."""
    import uuid as _uuid

    if not is_shared(df.sparkSession, folder):
        raise ValueError(f"{folder} is a folder of one machine; name one that all executors share")
    columns = df.columns
    run = _uuid.uuid4().hex[:8]
    base = folder.rstrip("/")

    from pyspark import TaskContext

    def write_part(batches: Iterator[pd.DataFrame], always: bool = False) -> Iterator[pd.DataFrame]:
        buf = io.StringIO()
        writer = csv.writer(buf, lineterminator="\n")
        writer.writerow(columns)
        n = 0
        for batch in batches:
            for rec in batch.itertuples(index=False):
                writer.writerow(["" if v is None else v for v in rec])
                n += 1
        if n == 0 and not always:
            return
        # named by partition, not by attempt: a retried task (lost executor)
        # rewrites the same archive instead of adding a second copy
        part = TaskContext.get().partitionId()
        name = f"{module}{ARCHIVE_SUFFIX[:-4]}-{run}-{part:05d}.zip"
        with _open_output(f"{base}/{name}") as out:
            data = io.BytesIO()
            with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as zf:
                zf.writestr(f"{module}.csv", buf.getvalue())
            out.write(data.getvalue())
        yield pd.DataFrame({"archive": [name], "rows": [n]})

    done = "archive string, rows long"
    written = df.mapInPandas(write_part, done).count()
    if written:
        return written
    # an empty table is one archive with a header: one partition, as every one of them writes an archive here
    def header_only(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _ in batches:
            pass
        yield from write_part(iter(()), always=True)

    return df.sparkSession.range(0, 1, 1, 1).mapInPandas(header_only, done).count()
