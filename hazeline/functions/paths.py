"""Object paths of raw documents, and what can be read off them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeline.functions.clock import ingest_text
from hazeline.specs import dataset as find_dataset


def object_path(ingested_at: Column, dataset: str, file_prefix: str | None = None) -> Column:
    """``raw/<dataset>/ingest_date=<day>/<prefix>_<ingest text>.json`` of a zone-less UTC time."""
    return path_of(ingested_at.cast("date"), ingest_text(ingested_at), dataset, file_prefix)


def path_of(day: Column, token: Column, dataset: str, file_prefix: str | None = None) -> Column:
    """Object path of an ingest date and an ingest text."""
    feed = find_dataset(dataset)  # an unknown feed is an error, with a prefix too
    prefix = file_prefix or feed.file_prefix
    return F.concat(
        F.lit(f"raw/{dataset}/ingest_date="),
        day.cast("string"),
        F.lit(f"/{prefix}_"),
        token,
        F.lit(".json"),
    )


def ingest_token(path: Column) -> Column:
    """Ingest text of an object path: what follows ``_raw_`` in the file name.

    Only the last path segment is looked at, so a folder with ``_raw_`` in its name is harmless.
    """
    name = F.substring_index(path, "/", -1)
    return F.split_part(F.replace(name, F.lit(".json"), F.lit("")), F.lit("_raw_"), F.lit(2))


def record_key(*parts: Column) -> Column:
    """md5 of the parts as text, joined by a bar; null if any part is null."""
    pieces = [parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit("|"), part.cast("string")]
    return F.md5(F.concat(*pieces))
