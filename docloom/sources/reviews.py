"""Review candidates from sources chosen by name: a catalog table, a JDBC warehouse, candidate files, or result payloads.

Candidate files are Parquet below ``review_required=<bool>/review_trigger=<trigger>`` folders, read by a data source of
their own: filters on these two columns choose the files that become partitions of the scan, other comparisons go to the
row groups of each file.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual,
)

from docloom.operators.review import candidates_from_payloads, candidates_from_rows

COLUMNS = "document_id, canonical_document, standardized_output, insights, job_id, review_trigger, review_required, created_at"
FORMAT = "review_candidates"
_SCHEMA = (
    "document_id string, canonical_document string, standardized_output string, insights string, job_id string, review_trigger string, "
    "review_required boolean, created_at timestamp"
)
_FOLDERS = ("review_required", "review_trigger")
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_ARROW = pa.schema([
    *[(c, pa.string()) for c in ("document_id", "canonical_document", "standardized_output", "insights", "job_id", "review_trigger")],
    ("review_required", pa.bool_()), ("created_at", pa.timestamp("us", tz="UTC")),
])
_COMPARE = {
    EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b,
}


def _system(path: str):
    if "://" in path:
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), "/" + path[5:].lstrip("/") if path.startswith("file:") else path


@dataclass
class CandidateFile(InputPartition):
    """One file, with the values its folders stand for."""

    path: str
    values: dict

    def __post_init__(self) -> None:
        super().__init__(self.path)


class CandidateReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path
        self.folder_filters: list[Filter] = []
        self.row_filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters on folders are done with here; comparisons skip row groups, and Spark evaluates them again on the rows."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in _FOLDERS and isinstance(f, (EqualTo, In, IsNotNull)):
                self.folder_filters.append(f)
                continue
            if name in ("document_id", "job_id", "created_at") and type(f) in _COMPARE:
                self.row_filters.append(f)
            yield f

    def _wanted(self, values: dict) -> bool:
        def holds(f: Filter) -> bool:
            value = values.get(f.attribute[0])
            if isinstance(f, IsNotNull):
                return value is not None
            return value is not None and value in (f.value if isinstance(f, In) else [f.value])

        return all(holds(f) for f in self.folder_filters)

    def partitions(self) -> list[CandidateFile]:
        system, base = _system(self.path)
        found = []
        for info in system.get_file_info(pa.fs.FileSelector(base, recursive=True)):
            if not info.path.endswith(".parquet"):
                continue
            folders = dict(p.split("=", 1) for p in info.path[len(base):].split("/") if "=" in p)
            values = {k: None if v == _NULL_FOLDER else unquote(v) for k, v in folders.items()}
            if "review_required" in values:
                values["review_required"] = values["review_required"] == "true"
            if self._wanted(values):
                found.append(CandidateFile(info.path, values))
        return found

    def read(self, partition: CandidateFile) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, CandidateFile):  # nothing was left to read
            return
        system, _ = _system(self.path)
        rows = pa.dataset.dataset(partition.path, format="parquet", filesystem=system)
        wanted = None
        for f in self.row_filters:
            value = pa.scalar(f.value, rows.schema.field(f.attribute[0]).type) if f.attribute[0] in rows.schema.names else None
            if value is not None:
                test = _COMPARE[type(f)](pc.field(f.attribute[0]), value)
                wanted = test if wanted is None else wanted & test
        for batch in rows.to_batches(filter=wanted):
            columns = []
            for field in _ARROW:
                if field.name in batch.schema.names:
                    columns.append(batch.column(field.name).cast(field.type))
                else:
                    columns.append(pa.array([partition.values.get(field.name)] * batch.num_rows, field.type))
            yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)


class CandidateFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> CandidateReader:
        return CandidateReader(self.options["path"])


def write_candidates(rows: DataFrame, path: str) -> None:
    """Rows of ``COLUMNS`` as candidate files."""
    rows.selectExpr(*COLUMNS.split(", ")).write.partitionBy(*_FOLDERS).parquet(path)


def candidate_files(spark: SparkSession, path: str) -> DataFrame:
    """All rows of candidate files."""
    spark.dataSource.register(CandidateFiles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(FORMAT).load(path)


def file_candidates(spark: SparkSession, path: str) -> DataFrame:
    return candidates_from_rows(candidate_files(spark, path))


def table_candidates(spark: SparkSession, table: str) -> DataFrame:
    return candidates_from_rows(spark.read.table(table).selectExpr(*COLUMNS.split(", ")))


def payload_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidates of a results table, whose parts lie in the canonical payload."""
    return candidates_from_payloads(spark.read.schema("canonical_document string").parquet(path))


def jdbc_candidates(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Open candidates of a warehouse table; the ``review_required`` filter is pushed to the source.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` to read in parallel.
    """
    rows = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return candidates_from_rows(rows.selectExpr(*COLUMNS.split(", ")))


#: Sources by name.
SOURCES: dict[str, Callable[..., DataFrame]] = {"table": table_candidates, "jdbc": jdbc_candidates, "files": file_candidates, "payloads": payload_candidates}


def candidates(spark: SparkSession, source: str, **options: str) -> DataFrame:
    """Open candidates of the source a configuration names."""
    try:
        read = SOURCES[source.lower()]
    except KeyError:
        raise ValueError(f"no review source {source!r}; there are {', '.join(sorted(SOURCES))}") from None
    return read(spark, **options)
