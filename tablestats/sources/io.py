"""Table sources and sinks.

* ``read_table``      CSV (header, quoted multi-line fields) or Parquet scan.
* ``read_or_convert`` use the Parquet copy of a table, converting the CSV
                      when no copy exists or its source has changed.
* ``split_rejects``   well-formed and malformed rows of a CSV, as two tables.
* ``write_table``     Parquet or CSV sink, overwrite.
* ``write_report``    ordered text lines, in one part or several.
* ``read_lines``      written text with the order of its lines.
* ``write_answers``   model answers as text files, in parallel.

Format is chosen explicitly (never by catching errors); every failure surfaces.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',         # a doubled quote inside a quoted field is one quote
    "mode": "PERMISSIVE",
}

#: Where a copy remembers its source; readers pass over names that begin so.
SOURCE_NOTE = "_source.json"


def _format_of(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt.lower()
    lowered = path.rstrip("/").lower()
    if lowered.endswith(".csv") or lowered.endswith(".csv.gz"):
        return "csv"
    return "parquet"


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               fmt: str | None = None, infer: bool = False, multi_line: bool = True) -> DataFrame:
    """Scan a CSV or Parquet table.

    CSV: header row; quoted line breaks stay inside one field, for which one
    task must read each file from its start.  ``multi_line=False`` says that
    no field holds a line break: large files are then split and read in
    parallel.  Columns are text unless a schema is given (``clean_table`` parses numbers, counts and dates from
    text).  ``infer=True`` infers types instead, at the cost of an extra full
    pass over the input.  Parquet: schema from the file footers; filters and
    column pruning reach the reader.
    """
    kind = _format_of(path, fmt)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        reader = reader.options(**CSV_OPTIONS, multiLine=str(multi_line).lower())
        if schema is None and infer:
            reader = reader.option("inferSchema", "true")
        return reader.csv(path)
    return reader.format(kind).load(path)


def _hadoop(spark: SparkSession, path: str):
    """The path's file system and Hadoop's name of it: local folders and shared stores alike."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def _there(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    fs, source = _hadoop(spark, old)
    _, target = _hadoop(spark, new)
    if fs.exists(target) or not fs.rename(source, target):
        raise OSError(f"could not move {old} to {new}")


def _note(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _hadoop(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _noted(spark: SparkSession, path: str) -> str | None:
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return None
    opened = fs.open(p)
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()


def source_state(spark: SparkSession, path: str) -> str | None:
    """Name, length and time of the source's files, as text that changes when they do; None without a source."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return None
    files = [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p)]
    return json.dumps(sorted(f for f in files if f[0][0] not in "._"))


def _is_copy(spark: SparkSession, path: str, has_source: bool) -> bool:
    """A Parquet file or folder; a folder without success marker beside its source was left unfinished."""
    if not _there(spark, path):
        return False
    fs, p = _hadoop(spark, path)
    return not has_source or not fs.getFileStatus(p).isDirectory() or _there(spark, f"{path}/_SUCCESS")


def _beside(spark: SparkSession, target: str, kind: str) -> list[str]:
    """Paths of the folders ``.<target>.<kind>-...`` beside ``target``."""
    base, name = os.path.split(target)
    if not _there(spark, base):
        return []
    fs, p = _hadoop(spark, base)
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return sorted(f"{base}/{n}" for n in names if n.startswith(f".{name}.{kind}-"))


def _recover(spark: SparkSession, target: str) -> None:
    """Finish what an interrupted ``_publish`` left: the new copy if it is complete, else the old one again."""
    old = _beside(spark, target, "old")
    if not _there(spark, target):
        ready = [p for p in _beside(spark, target, "new") if _there(spark, f"{p}/_SUCCESS")]
        if old and (ready or old):
            _rename(spark, (ready or old)[-1], target)
    for path in _beside(spark, target, "old"):
        fs, p = _hadoop(spark, path)
        fs.delete(p, True)


def _publish(spark: SparkSession, ready: str, target: str) -> None:
    """Put the complete folder ``ready`` in the place of ``target``; the old one goes when the new one is there."""
    if _there(spark, target):
        _rename(spark, target, os.path.join(os.path.dirname(target), f".{os.path.basename(target)}.old-{uuid.uuid4().hex}"))
    _rename(spark, ready, target)
    _recover(spark, target)


def _stage(target: str) -> str:
    return os.path.join(os.path.dirname(target), f".{os.path.basename(target)}.new-{uuid.uuid4().hex}")


def read_or_convert(spark: SparkSession, base: str, name: str,
                    schema: StructType | str | None = None,
                    refresh: bool = False, infer: bool = False, multi_line: bool = True,
                    rejects: bool = False) -> DataFrame:
    """Read ``base/name.parquet``; convert ``base/name.csv`` if there is no copy or the CSV has changed since.

    The copy is written beside the old one and takes its place by renames when it
    is complete, so a conversion that fails leaves the old copy as it was, and one
    that is cut off between the renames is finished by the next call.  The copy
    remembers names, lengths and times of its source's files; without a CSV, or for
    a copy that remembers nothing (made elsewhere), the copy is taken as it is.  A
    folder without success marker counts as no copy.  ``refresh`` always converts.
    ``rejects`` keeps malformed rows out of the copy and writes them to
    ``base/name.rejects.parquet`` (see ``split_rejects``).
    """
    target, source = os.path.join(base, f"{name}.parquet"), os.path.join(base, f"{name}.csv")
    _recover(spark, target)
    state = source_state(spark, source)
    if not refresh and _is_copy(spark, target, state is not None):
        stored = _noted(spark, f"{target}/{SOURCE_NOTE}")
        if state is None or stored is None or stored == state:
            return spark.read.parquet(target)
    if state is None and not refresh:
        return spark.read.parquet(target)  # neither: the error names the copy
    ready = _stage(target)
    if rejects:
        bad = os.path.join(base, f"{name}.rejects.parquet")
        staged = _stage(bad)
        split_rejects(spark, source, ready, staged, schema, infer, multi_line)
        _recover(spark, bad)
        _publish(spark, staged, bad)
    else:
        read_table(spark, source, schema=schema, fmt="csv", infer=infer, multi_line=multi_line).write.parquet(ready)
    if state is not None:
        _note(spark, f"{ready}/{SOURCE_NOTE}", state)
    _publish(spark, ready, target)
    return spark.read.parquet(target)


def split_rejects(spark: SparkSession, path: str, good_path: str, reject_path: str,
                  schema: StructType | str | None = None, infer: bool = False, multi_line: bool = True,
                  header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows of a CSV to one Parquet table, malformed ones to another; returns both, read back.

    Malformed are rows with too few or too many fields, an unclosed quote, or a value
    that doesn't fit ``schema``.  Rejects have the whole ``record``, the ``file``, and the
    fields as far as they could be read.  One scan writes both tables: a reader
    that is asked for some columns only doesn't see what is wrong with the others.
    """
    reader = spark.read.options(**{**CSV_OPTIONS, "header": str(header).lower()}, multiLine=str(multi_line).lower())
    if schema is None:
        plain = reader.option("inferSchema", str(infer).lower()).csv(path).schema
    else:
        plain = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    record = next(c for c in ("_record", *(f"_record{i}" for i in range(len(plain) + 1))) if c not in plain.names)
    full = StructType([*plain.fields, StructField(record, StringType())])
    rows = reader.schema(full).option("columnNameOfCorruptRecord", record).csv(path)
    both = _stage(good_path)
    (rows.withColumns({"rejected": F.col(record).isNotNull(), "file": F.input_file_name()})
         .withColumnsRenamed({c: f"f{i}" for i, c in enumerate(plain.names)} | {record: "record"})
         .write.partitionBy("rejected").parquet(both))
    fields = [F.col(f"f{i}").alias(c) for i, c in enumerate(plain.names)]
    read = spark.read.schema(", ".join([*(f"f{i} {f.dataType.simpleString()}" for i, f in enumerate(plain.fields)),
                                        "record string", "file string", "rejected boolean"])).parquet(both)
    read.where(~F.col("rejected")).select(*fields).write.mode("overwrite").parquet(good_path)
    more = [F.col(c) for c in ("record", "file") if c not in plain.names]
    read.where("rejected").select(*more, *fields).write.mode("overwrite").parquet(reject_path)
    fs, p = _hadoop(spark, both)
    fs.delete(p, True)
    return spark.read.parquet(good_path), spark.read.parquet(reject_path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", single: bool = False,
                mode: str = "overwrite") -> None:
    """Write a table as Parquet (default) or CSV with a header row.

    ``single=True`` writes one part file through one task: meant for small
    results (a per-year table, a report), never for the cleaned table itself.
    """
    out = df.coalesce(1) if single else df
    writer = out.write.mode(mode)
    if fmt == "csv":
        writer.options(header="true", escape='"').csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        writer.format(fmt).save(path)


def write_report(lines: DataFrame, path: str, order: tuple[str, ...] = ("section", "seq"),
                 text_col: str = "line", parts: int = 1) -> None:
    """Write lines, in order, as text: part by part, and within a part line by line.

    A report has few lines and goes to a single part.  ``parts`` deals more of them
    out by ranges of ``order``, so that the parts in the order of their names hold the lines in
    order, and no task gets all of them.
    """
    dealt = lines.repartition(1) if parts == 1 else lines.repartitionByRange(parts, *order)
    (dealt.sortWithinPartitions(*order)
          .select(F.coalesce(F.col(text_col), F.lit("")).alias(text_col))
          .write.mode("overwrite").text(path))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``part, start, row, line`` of written text: ordering by the first three gives the lines as written.

    ``start`` is where the read of a file began (large files are read in pieces), ``row``
    counts upwards within it."""
    return spark.read.text(path).select(
        F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"))


def write_answers(answers: DataFrame, path: str, text_col: str = "content") -> None:
    """Write answer texts as text files, in parallel; rows without an answer are left out."""
    (answers.where(F.col(text_col).isNotNull()).select(text_col)
            .write.mode("overwrite").text(path))
