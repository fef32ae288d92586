"""Folders of tables that are replaced as a whole.

Every save writes its tables below a new folder, ``versions/<id>``, and then, as the last step, a
manifest that names it. Readers follow the newest manifest, so a save that is cut off half-way
changes nothing, and whoever has opened an earlier version can go on reading it.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tallyrec.session import create_file, delete, exists, list_names

MANIFESTS = "manifests"


class Version(NamedTuple):
    """What one save wrote."""

    number: int
    folder: str
    tables: dict[str, DataFrame]
    params: dict


def save_version(
    spark: SparkSession, root: str, tables: dict[str, DataFrame], params: dict | None = None
) -> str:
    """Write ``tables`` as the newest version below ``root``; returns the folder of the version.

    Of two saves at the same time the one whose manifest comes second takes the next number.
    """
    root = root.rstrip("/")
    name = uuid.uuid4().hex
    folder = f"{root}/versions/{name}"
    for table, df in tables.items():
        df.write.parquet(f"{folder}/{table}")
    content = {"version": name, "tables": list(tables), "params": params or {}}
    number = max(_numbers(spark, root), default=0) + 1
    while not create_file(spark, _manifest(root, number), json.dumps(content)):
        number += 1
    return folder


def load_version(spark: SparkSession, root: str) -> Version | None:
    """The newest version below ``root``, or None where nothing was saved."""
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    if not numbers:
        return None
    number = max(numbers)
    content = _read(spark, root, number)
    folder = f"{root}/versions/{content['version']}"
    tables = {name: spark.read.parquet(f"{folder}/{name}") for name in content["tables"]}
    return Version(number, folder, tables, content["params"])


def drop_old_versions(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete all but the newest ``keep`` versions, and what cut-off saves left behind; returns how
    many folders went. Not while somebody saves or reads an old version."""
    root = root.rstrip("/")
    numbers = sorted(_numbers(spark, root))
    kept = {_read(spark, root, number)["version"] for number in numbers[-max(keep, 1) :]}
    for number in numbers[: -max(keep, 1)]:
        delete(spark, _manifest(root, number))
    old = [name for name in list_names(spark, f"{root}/versions") if name not in kept]
    for name in old:
        delete(spark, f"{root}/versions/{name}")
    return len(old)


def _manifest(root: str, number: int) -> str:
    return f"{root}/{MANIFESTS}/{number:012d}.json"


def _read(spark: SparkSession, root: str, number: int) -> dict:
    return json.loads(spark.read.text(_manifest(root, number), wholetext=True).first()["value"])


def _numbers(spark: SparkSession, root: str) -> list[int]:
    folder = f"{root}/{MANIFESTS}"
    names = list_names(spark, folder) if exists(spark, folder) else []
    return [int(name.removesuffix(".json")) for name in names if name.endswith(".json")]
