"""Reading raw files into one table with unified types."""

from __future__ import annotations

import json
import posixpath
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def _unified(kind: T.DataType, time_type: str) -> str:
    """The type a column gets, by family: times, numbers, all else as text."""
    if isinstance(kind, T.NumericType):
        return "double"
    return time_type if kind.typeName() in ("date", "timestamp", "timestamp_ntz") else "string"


def normalize(df: DataFrame, time_type: str = "timestamp_ntz") -> DataFrame:
    """Every column as timestamp, double or string; names and order kept."""
    return df.select([F.col(f"`{f.name}`").cast(_unified(f.dataType, time_type)).alias(f.name) for f in df.schema])


def audit(df: DataFrame, layer: str, source_file: bool = False) -> DataFrame:
    """Adds ``_source_file`` (from the scan), ``_ingested_at`` and ``_layer``.

    ``source_file`` needs a frame read straight from files, where ``_metadata`` exists.
    """
    if source_file:
        df = df.withColumn("_source_file", F.col("_metadata.file_path"))
    return df.withColumn("_ingested_at", F.current_timestamp()).withColumn("_layer", F.lit(layer))


#: What a Parquet file begins and ends with; and the bytes of the smallest one.
_MAGIC, _SMALLEST = b"PAR1", 12
#: Stores that executors open by themselves, and the name that takes.
_OPENED = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "abfss": "abfss"}
FOOTERS = "path string, state string, detail string"


def _scheme(path: str) -> str:
    return path.split("://", 1)[0] if "://" in path else path.split(":", 1)[0] if path.startswith("file:/") else ""


def _footer(path: str) -> tuple[str, str | None]:
    """("schema", text of the schema), ("damaged", reason) or ("absent", None); a folder is judged by all its data files.

    Only what the bytes themselves show is damage: no magic number at the end, or a footer that does not parse. Whatever else goes wrong is raised.
    """
    scheme = _scheme(path)
    plain = path.split(":", 1)[1] if scheme else path
    plain = "/" + plain.lstrip("/") if scheme in ("", "file") else plain
    store, at = (fs.LocalFileSystem(), plain) if scheme in ("", "file") else fs.FileSystem.from_uri(f"{_OPENED[scheme]}:{plain}")
    info = store.get_file_info(at)
    if info.type == fs.FileType.NotFound:
        return "absent", None
    files = [info]
    if info.type == fs.FileType.Directory:
        found = store.get_file_info(fs.FileSelector(at, recursive=True))
        files = sorted((f for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))), key=lambda f: f.path)
    shapes = set()
    for f in files:
        with store.open_input_file(f.path) as file:
            if f.size < _SMALLEST:
                return "damaged", f"{f.path} is not a Parquet file: it has {f.size} bytes"
            file.seek(f.size - 8)
            end = file.read(8)
            if end[4:] != _MAGIC:
                return "damaged", f"{f.path} is not a Parquet file: it ends with {end[4:]!r}"
            size = int.from_bytes(end[:4], "little")
            if size > f.size - _SMALLEST:
                return "damaged", f"{f.path} is not a Parquet file: a footer of {size} bytes in {f.size}"
            file.seek(f.size - 8 - size)
            footer = file.read(size + 8)
            try:
                # From here on nothing is read: an error is one of the bytes.
                schema = pq.read_metadata(pa.BufferReader(_MAGIC + footer)).schema
            except (pa.ArrowException, OSError) as error:
                return "damaged", f"{f.path} is not a Parquet file: its footer does not parse ({str(error)[:300]})"
            shapes.add("; ".join(str(schema.column(i)).replace("\n", " ") for i in range(len(schema))))
    return "schema", " | ".join(sorted(shapes))


def footers(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """(path, state, detail) of every path, from footers read by tasks of one job, whatever the number of files."""
    ordered = sorted(set(paths))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            told = [_footer(name) for name in names]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([s for s, _ in told], pa.string()), pa.array([d for _, d in told], pa.string())], ["path", "state", "detail"])

    listed = spark.createDataFrame([(p,) for p in ordered], "path string")
    return listed.repartition(max(1, min(len(ordered), 64 * spark.sparkContext.defaultParallelism))).mapInArrow(read, FOOTERS)


def probe_schemas(spark: SparkSession, paths: Iterable[str]) -> tuple[dict[str, list[str]], list[tuple[str, str]]]:
    """Paths grouped by schema (JSON text), and the damaged ones with the reason.

    One job reads all footers where executors can open the files, and one more file is opened per distinct schema. Paths in other stores are opened
    one by one by Spark, which proves no damage: an error there, as for absent or denied files anywhere, is raised.
    """
    ordered = sorted(set(paths))
    opened = [p for p in ordered if _scheme(p) in _OPENED]
    told = footers(spark, opened).collect() if opened else []
    damaged = sorted((r["path"], r["detail"]) for r in told if r["state"] == "damaged")
    alike: dict[str, list[str]] = defaultdict(list)
    for r in told:
        if r["state"] != "damaged":
            alike[r["path"] if r["state"] == "absent" else f"schema {r['detail']}"].append(r["path"])
    for p in ordered:
        if p not in set(opened):
            alike[p].append(p)
    groups: dict[str, list[str]] = defaultdict(list)
    for found in alike.values():
        groups[spark.read.parquet(min(found)).schema.json()] += sorted(found)
    return {schema: sorted(found) for schema, found in sorted(groups.items(), key=lambda g: min(g[1]))}, damaged


def ingest(spark: SparkSession, paths: Sequence[str], with_audit: bool = True, skip_damaged: bool = False) -> tuple[DataFrame, DataFrame]:
    """Union of parquet files whose schemas drift, and a table (path, reason) of the damaged ones.

    A damaged file is an error unless ``skip_damaged``. Only footers are read while planning. Files of equal
    schema share one scan, read with their own schema, so the vectorised reader stays on and the plan has one branch per schema, not
    one per file.
    """
    groups, damaged = probe_schemas(spark, paths)
    if damaged and not skip_damaged:
        raise ValueError(f"{len(damaged)} damaged file(s), first: {damaged[0]}")
    if not groups:
        raise ValueError(f"no readable parquet file among {len(damaged)} path(s)")
    table = None
    for schema_text, files in groups.items():
        schema = T.StructType.fromJson(json.loads(schema_text))
        part = spark.read.schema(schema).parquet(*files)
        if with_audit:
            part = part.select("*", F.col("_metadata.file_path").alias("_source_file"))
        normal = normalize(part)
        table = normal if table is None else table.unionByName(normal, allowMissingColumns=True)
    if with_audit:
        names = [c for c in table.columns if c != "_source_file"] + ["_source_file"]
        table = audit(table.select(*names), "bronze")
    return table, spark.createDataFrame(damaged, "path string, reason string")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet or CSV, chosen by suffix."""
    suffix = posixpath.splitext(path)[1].lower()
    if suffix == ".parquet":
        return spark.read.parquet(path)
    if suffix == ".csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    raise ValueError(f"unsupported format: {path}")


def _listed(spark: SparkSession, root: str) -> DataFrame | None:
    """Paths of all files below ``root`` by a distributed listing (no contents are read), None if it does not exist."""
    try:
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whatever file system it names."""
    return _listed(spark, path) is not None


def discover(spark: SparkSession, roots: Sequence[str], suffix: str = ".parquet") -> list[str]:
    """Data files below the roots: missing roots and empty files skipped, each file once, sorted by file name."""
    listed = [f for f in (_listed(spark, r) for r in roots) if f is not None]
    if not listed:
        return []
    name = F.element_at(F.split("path", "/"), -1)
    files = reduce(lambda a, b: a.unionByName(b), listed).filter(F.col("path").endswith(suffix)).distinct()
    return [r["path"] for r in files.orderBy(name, "path").collect()]


def context_candidates(year: int, month: int, templates: Sequence[str]) -> list[str]:
    """Paths to try for history before a month: the month before it in every location, then the
    same month a year earlier, locations in reverse (the archive first). Templates use ``{year}``
    and ``{month:02d}``.
    """
    before = (year - 1, 12) if month == 1 else (year, month - 1)
    recent = [t.format(year=before[0], month=before[1]) for t in templates]
    return recent + [t.format(year=year - 1, month=month) for t in reversed(templates)]


def first_available(spark: SparkSession, candidates: Sequence[str]) -> str | None:
    """The first path that exists."""
    return next((p for p in candidates if exists(spark, p)), None)
