"""Raw document content."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_files(spark: SparkSession, path: str, pattern: str | None = None, max_bytes: int | None = None) -> DataFrame:
    """Files as ``path, content``.  Whole files unless ``max_bytes`` asks for a leading range."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    content = F.substring("content", 1, max_bytes) if max_bytes else F.col("content")
    return reader.load(path).select("path", content.alias("content"))


def attach_content(documents: DataFrame, files: DataFrame, uri: str = "source_uri") -> DataFrame:
    """Left join on the path: a missing object leaves ``content`` null."""
    named = files.select(F.col("path").alias("_path"), F.col("content").alias("content"))
    return documents.join(named, F.col(uri) == F.col("_path"), "left").drop("_path")


@dataclass(frozen=True)
class Fetcher:
    """A resolver in Python: descriptor of a document to its bytes, None or empty where it has none."""

    name: str
    fetch: Callable[[dict], bytes | None]


def _fetched(fetchers: list[Fetcher], descriptor: Column) -> Column:
    """``struct<content, errors>`` of the first of several fetchers that has content; a null descriptor is not asked for.

    A fetcher that fails for a document is passed over for this document and listed in its errors.
    """

    def fetch(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for asked in columns:
            found = []
            for one in asked.to_pylist():
                content, errors = None, []
                for f in fetchers if one is not None else ():
                    try:
                        content = f.fetch(one) or None
                    except Exception as error:  # whatever one resolver does, the next is asked
                        errors.append({"resolver": f.name, "error": f"{type(error).__name__}: {error}"[:500]})
                    if content:
                        break
                found.append({"content": content, "errors": errors})
            yield pa.array(found, pa.struct([("content", pa.binary()), ("errors", pa.list_(_ERROR))]))

    return F.arrow_udf(fetch, f"struct<content:binary,errors:{RESOLVER_ERRORS}>")(descriptor)


RESOLVER_ERRORS = "array<struct<resolver:string,error:string>>"
_ERROR = pa.struct([("resolver", pa.string()), ("error", pa.string())])


def resolve_content(documents: DataFrame, resolvers: list, output: str = "content", descriptor: Sequence[str] = ("source_uri",)) -> DataFrame:
    """Resolver chain of pairs ``(column, resolver)``; the first non-empty column wins.

    A resolver is None for a column that is there, ``DataFrame -> DataFrame`` adding that column, or a ``Fetcher``, which is
    asked with the ``descriptor`` columns, for documents without content so far only, and may fail for some of them:
    ``resolver_errors`` lists what went wrong and later resolvers go on.
    """
    found = F.lit(None).cast("binary")
    errors = F.array().cast(RESOLVER_ERRORS)
    names: list[str] = []
    at = 0
    while at < len(resolvers):
        column, resolver = resolvers[at]
        fetchers = [r for _, r in takewhile(lambda pair: isinstance(pair[1], Fetcher), resolvers[at:])]
        names.append(column)
        if fetchers:
            # neighbouring fetchers share one pass
            asked = F.when(found.isNull(), F.struct(*descriptor))
            documents = documents.withColumn(column, _fetched(fetchers, asked))
            errors = F.concat(errors, F.coalesce(F.col(column)["errors"], F.array().cast(RESOLVER_ERRORS)))
            value = F.col(column)["content"]
        else:
            documents = resolver(documents) if resolver else documents
            value = F.col(column)
        found = F.coalesce(found, F.when(F.length(value) > 0, value))
        at += max(1, len(fetchers))
    documents = documents.withColumns({"_found": found, "resolver_errors": errors}).drop(*[n for n in names if n != output])
    return documents.withColumn(output, F.col("_found")).drop("_found")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
