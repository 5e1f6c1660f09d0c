"""Where a table's cleaned and enriched copies live, derived from its raw path."""

from __future__ import annotations

import posixpath
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.sql import Column, functions as F

# Endings of the derived tables.
SILVER_SUFFIX = "_cleaned.parquet"
GOLD_SUFFIX = "_enriched.parquet"
#: Records that can't be read, beside the cleaned table.
REJECTED_SUFFIX = "_rejected.parquet"


def object_path(path: str, bucket: str, suffix: str) -> str:
    """Same folder in another bucket, file ending replaced. Only ``s3://bucket/key`` is valid."""
    url = urlparse(path)
    folder, name = posixpath.split(url.path.lstrip("/"))
    if url.scheme != "s3" or not name:
        raise ValueError(f"not an s3 object path: {path!r}")
    return f"s3://{bucket}/" + posixpath.join(folder, posixpath.splitext(name)[0] + suffix)


def object_path_column(path: Column, bucket: str, suffix: str) -> Column:
    """``object_path`` for a whole column of paths; null where the path is not valid."""
    key = F.ltrim(F.regexp_extract(path, r"^s3://[^/]*(/.*)$", 1), F.lit("/"))
    folder = F.regexp_extract(key, r"^(.*/)[^/]*$", 1)
    name = F.regexp_extract(key, r"([^/]*)$", 1)
    base = F.regexp_replace(name, r"^(\.*[^.].*)\.[^.]*$", "$1")
    return F.when(name != "", F.concat(F.lit(f"s3://{bucket}/"), folder, base, F.lit(suffix)))


@dataclass(frozen=True)
class Zones:
    """Base folders of the three quality levels, on any file system Spark can reach."""

    bronze: str
    silver: str
    gold: str

    def _target(self, path: str, root: str, suffix: str) -> str:
        source = self.bronze.rstrip("/") + "/"
        relative = path[len(source):] if path.startswith(source) else ""
        folder, name = posixpath.split(relative.lstrip("/"))
        if not name:
            raise ValueError(f"{path!r} is not a file below {source!r}")
        return posixpath.join(root, folder, posixpath.splitext(name)[0] + suffix)

    def silver_path(self, path: str) -> str:
        return self._target(path, self.silver, SILVER_SUFFIX)

    def rejected_path(self, path: str) -> str:
        return self._target(path, self.silver, REJECTED_SUFFIX)

    def gold_path(self, path: str) -> str:
        return self._target(path, self.gold, GOLD_SUFFIX)


def event_path(event: dict, zones: Zones | None = None) -> str:
    """Input path of a new-file event (first record) or of an explicit-path event. Events name bucket and key only; the
    scheme is that of the bronze zone if the bucket is its bucket."""
    records = event.get("Records")
    if records and "s3" in records[0]:
        entry = records[0]["s3"]
        bucket = entry["bucket"]["name"]
        bronze = urlparse(zones.bronze) if zones else None
        scheme = bronze.scheme if bronze and bronze.netloc == bucket else "s3"
        return f"{scheme}://{bucket}/{entry['object']['key']}"
    if "input_path" in event:
        return event["input_path"]
    raise ValueError("the event names no input file")


def event_path_column(event: Column, scheme: str = "s3") -> Column:
    """``event_path`` for a column of JSON events; null where an event names no file."""
    def at(path):
        return F.get_json_object(event, path)

    record = F.concat(F.lit(f"{scheme}://"), at("$.Records[0].s3.bucket.name"), F.lit("/"), at("$.Records[0].s3.object.key"))
    return F.coalesce(record, at("$.input_path"))
