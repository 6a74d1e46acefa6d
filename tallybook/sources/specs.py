"""Declared data sources."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallybook.sources.reports import FORMATS

class SourceType(NamedTuple):
    """What a type of source must be told, and where that places it."""

    needed: tuple[str, ...]
    location: str
    defaults: Mapping[str, Any] = {}


# --- fixed values: source types, their needed parameters, locations and defaults ----
SOURCE_TYPES = {
    "s3": SourceType(("bucket_name",), "s3://{bucket_name}/{prefix}", {"prefix": ""}),
    "api": SourceType(("base_url",), "{base_url}"),
    "database": SourceType(("host", "database"), "{host}:{port}/{database}", {"port": 5432}),
    "sqs": SourceType(("queue_url",), "{queue_url}"),
}


@dataclass(frozen=True)
class SourceSpec:
    name: str
    type: str
    params: Mapping[str, Any] = field(default_factory=dict)
    polling_interval: int | None = None
    output_format: str = "parquet"

    def __post_init__(self):
        if problems := list(self._problems()):
            raise ValueError(f"source {self.name!r}: " + "; ".join(problems))

    def _problems(self) -> Iterator[str]:
        """Everything that is wrong with the declaration."""
        if self.name == "" or len(self.name) > 100:
            yield "the name must have 1 to 100 characters"
        if self.polling_interval is not None and self.polling_interval <= 0:
            yield "polling_interval must be positive"
        if self.output_format not in FORMATS:
            yield f"output_format must be one of {FORMATS}"
        if self.type not in SOURCE_TYPES:
            yield f"type {self.type!r} is none of {sorted(SOURCE_TYPES)}"
        elif missing := set(SOURCE_TYPES[self.type].needed) - set(self.params):
            yield f"type {self.type} also needs {', '.join(sorted(missing))}"

    @property
    def uri(self) -> str:
        kind = SOURCE_TYPES[self.type]
        return kind.location.format_map({**kind.defaults, **self.params})

    def read(self, spark: SparkSession) -> DataFrame:
        """The source as a DataFrame.

        A file source reads `format` (default parquet) below its bucket; `root`
        replaces the s3 scheme and bucket for other storage. A database source reads
        `table` through `driver_url`; `partition` options split it over tasks.
        """
        p = self.params
        if self.type == "s3":
            root = p.get("root", f"s3a://{p['bucket_name']}")
            reader = spark.read.format(p.get("format", "parquet"))
            return reader.options(**p.get("options", {})).load(f"{root}/{p.get('prefix', '')}")
        if self.type == "database":
            scheme = p.get("driver_url", "jdbc:postgresql")
            reader = spark.read.format("jdbc").option("url", f"{scheme}://{self.uri}")
            reader = reader.option("dbtable", p["table"]).options(**p.get("options", {}))
            return reader.options(**p.get("partition", {})).load()
        raise NotImplementedError(f"{self.type} sources are not tables; land them as files first")


def updated_since(df: DataFrame, column: str, last: datetime | None) -> DataFrame:
    """Rows changed after the last export; the filter is pushed to the source."""
    if last is None:
        return df
    return df.filter(F.col(column) > F.lit(str(last)).cast(df.schema[column].dataType))
