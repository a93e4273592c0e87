"""Lists of names and domains out of a folder of differing files.

Each file has a header of its own, or none; they are read whole, one row of
cells for each line, and :mod:`weftline.operators.exclusions` finds the columns
by each file's header. Files that aren't there, can't be decoded or hold no
rows are left out, as is everything under the folder of exports, and a path
that is named twice is read once.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROWS = "file string, line int, cells array<string>"


def _one(path: str) -> str:
    """A path in one spelling: without a scheme for local files, doubled or trailing slashes and dots."""
    head, mark, rest = path.partition("://")
    scheme, rest = (head + mark, rest) if mark else ("", path.removeprefix("file:"))
    if scheme == "file://":
        scheme = ""
    parts: list[str] = []
    for p in rest.split("/"):
        if p == "..":
            parts = parts[:-1]
        elif p not in ("", "."):
            parts.append(p)
    return scheme + ("/" if not scheme else "") + "/".join(parts)


def wanted(paths: list[str], exports: str | None = None) -> list[str]:
    """The paths in order, each once, without those in the folder of exports. They are configured ones, a handful."""
    kept = dict.fromkeys(map(_one, paths))
    inside = _one(exports) if exports else None
    return [p for p in kept if inside is None or not (p == inside or p.startswith(inside + "/"))]


def _files(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{kind}").load(path if "://" in path else f"file://{path}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found.select(F.col("_metadata.file_path").alias("file"), "content")


def _read(spark: SparkSession, paths: list[str], exports: str | None, kind: str) -> DataFrame | None:
    inside = _one(exports) + "/" if exports else None
    found = None
    for path in wanted(paths, exports):
        one = _files(spark, path, kind)
        if one is not None:
            found = one if found is None else found.union(one)
    if found is None:
        return None
    # a folder may hold a file that is named by itself too, and the exports' folder
    once = found.groupBy("file").agg(F.first("content").alias("content"))
    return once if inside is None else once.where(~F.startswith(F.regexp_replace("file", "^file:/+", "/"), F.lit(inside)))


def read_rows(spark: SparkSession, paths: list[str], exports: str | None = None) -> DataFrame:
    """(file, line, cells) of the CSV files at paths or in folders at paths, line 0 being a file's header; a file that can't be read has no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("line", pa.int32()), ("cells", pa.list_(pa.string()))])
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content").to_pylist()):
                try:
                    rows = [r for r in csv.reader(io.StringIO(content.decode("utf-8-sig"), newline=""), strict=True) if any(c.strip() for c in r)]
                except (UnicodeDecodeError, csv.Error):
                    continue
                yield pa.RecordBatch.from_pylist([{"file": file, "line": k, "cells": r} for k, r in enumerate(rows)], schema=schema)

    found = _read(spark, paths, exports, "csv")
    return spark.createDataFrame([], _ROWS) if found is None else found.mapInArrow(run, _ROWS)


def read_lines(spark: SparkSession, paths: list[str], exports: str | None = None) -> DataFrame:
    """(line) of the text files at paths or in folders at paths; bytes that aren't UTF-8 spoil their own line only."""
    found = _read(spark, paths, exports, "txt")
    if found is None:
        return spark.createDataFrame([], "line string")
    return found.mapInArrow(_lines, "line string")


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content").to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(content.decode("utf-8-sig", "replace").splitlines(), pa.string())], names=["line"])


def template(rows: DataFrame) -> DataFrame:
    """(file, header, width, next_index): what an export that is appended to each file must look like, and the number it goes on with, one more than the largest in the column '#', or the first one."""
    heads = rows.where("line = 0").select("file", F.transform("cells", lambda c: F.trim(c)).alias("header"))
    number = F.get("cells", F.greatest(F.array_position("header", "#") - 1, F.lit(0)).cast("int"))
    body = rows.where("line > 0").join(heads, "file").select("file", F.when(F.trim(number).rlike(r"^\d+$"), F.trim(number).try_cast("long")).alias("n"))
    last = body.groupBy("file").agg(F.max("n").alias("n"))
    return heads.join(last, "file", "left").select("file", "header", F.size("header").alias("width"), (F.coalesce("n", F.lit(0)) + 1).alias("next_index"))
