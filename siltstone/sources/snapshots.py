"""Several overwritten tables that change as one.

A group is a folder. Each publication adds a manifest to it, which names the version of
every table of the group, and then an empty marker that names the manifest. Creating the
marker is the one step that changes all tables: a failure before it leaves all of them on
the version before, a failure behind it on the new one. A table that belongs to a group
has a small file that names the group, so that it can still be read by its own path.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession

from siltstone.sources.paths import (
    child_names,
    create_empty,
    delete_folder,
    qualified,
    read_small,
    write_small,
)

# An empty file whose name numbers what counts: a table's folder, or a group's manifest.
CURRENT = "_current."

# In a table's folder: the group that it belongs to, and its name there.
MEMBER = "_member"


class SnapshotError(ValueError):
    """A table or group is not published the way it is asked for."""


def versions(names: Collection[str]) -> list[tuple[int, str]]:
    """(number, name) of what markers among some file names have published, oldest first."""
    found = [n.removeprefix(CURRENT).split(".", 1) for n in names if n.startswith(CURRENT)]
    return sorted((int(number), name) for number, name in found)


def next_marker(spark: SparkSession, path: str, name: str) -> None:
    """Publish a name in a folder: from now on it is the one that counts."""
    known = versions(child_names(spark, path))
    number = known[-1][0] + 1 if known else 1
    create_empty(spark, f"{path}/{CURRENT}{number:08d}.{name}")


def group_of(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """(group, name of the table in it) of the table at ``path``, if it is in one."""
    if MEMBER not in child_names(spark, path):
        return None
    text = read_small(spark, f"{path}/{MEMBER}")
    if not text.endswith("}"):  # its writer was stopped, and so published nothing
        return None
    entry = json.loads(text)
    return entry["group"], entry["table"]


def _manifest(spark: SparkSession, group: str, name: str) -> dict[str, dict[str, str]]:
    return json.loads(read_small(spark, f"{group}/{name}"))


def current_manifest(spark: SparkSession, group: str) -> dict[str, dict[str, str]]:
    """Path and folder of each table of the last publication; none if there is none."""
    known = versions(child_names(spark, group))
    return _manifest(spark, group, known[-1][1]) if known else {}


def current_folder(spark: SparkSession, path: str) -> str:
    """Where the rows of the table at ``path`` are: its last version, or itself.

    The group decides once it has published the table; before, the table's own markers.
    """
    names = child_names(spark, path)
    member = group_of(spark, path) if MEMBER in names else None
    if member:
        entry = current_manifest(spark, member[0]).get(member[1])
        if entry:
            return f"{path}/{entry['folder']}"
    known = versions(names)
    return f"{path}/{known[-1][1]}" if known else path


def _join(spark: SparkSession, group: str, table: str, path: str) -> None:
    member = group_of(spark, path)
    if member is None:
        entry = {"group": qualified(spark, group), "table": table}
        delete_folder(spark, f"{path}/{MEMBER}")
        write_small(spark, f"{path}/{MEMBER}", json.dumps(entry))
    elif member != (qualified(spark, group), table):
        raise SnapshotError(f"{path} belongs to {member[0]} as {member[1]!r}")


def publish_together(
    spark: SparkSession, group: str, written: Mapping[str, tuple[str, str]]
) -> None:
    """Make the written versions of some tables count, all at once.

    ``written`` has the path and the new folder of each table by its name in the group.
    Tables of the group that are not among them keep their version. What a running
    reader may still need, the publication before, is deleted by the next one; so are
    versions and manifests that were never published.
    """
    before = versions(child_names(spark, group))
    old = _manifest(spark, group, before[-1][1]) if before else {}
    for table, (path, _) in written.items():
        _join(spark, group, table, path)
    new = old | {
        table: {"path": qualified(spark, path), "folder": folder}
        for table, (path, folder) in written.items()
    }
    manifest = f"m-{uuid.uuid4().hex}"
    write_small(spark, f"{group}/{manifest}", json.dumps(new, indent=1))
    next_marker(spark, group, manifest)
    _clean_up(spark, group, {manifest, *(name for _, name in before[-1:])}, [old, new])


def _clean_up(
    spark: SparkSession, group: str, manifests: set[str], kept: list[dict]
) -> None:
    """Delete what neither the publication before nor the new one refers to."""
    for name in child_names(spark, group):
        target = name.split(".", 2)[-1] if name.startswith(CURRENT) else name
        if target not in manifests:
            delete_folder(spark, f"{group}/{name}")
    folders: dict[str, set[str]] = {}
    for manifest in kept:
        for entry in manifest.values():
            folders.setdefault(entry["path"], set()).add(entry["folder"])
    for path, named in folders.items():
        own = versions(child_names(spark, path))
        # A table that had versions of its own keeps the last for one publication more.
        named |= {folder for _, folder in own[-1:] if len(named) < 2}
        for name in child_names(spark, path):
            target = name.split(".", 2)[-1] if name.startswith(CURRENT) else name
            if target not in named and name != MEMBER:
                delete_folder(spark, f"{path}/{name}")


def read_snapshot(
    spark: SparkSession,
    group: str,
    fmt: str = "parquet",
    tables: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """The tables of a group as they were published together, by name.

    One look at the group tells all versions, so that the frames belong to one run even
    if the next is published meanwhile. They can be read until the one after it.
    """
    manifest = current_manifest(spark, group)
    missing = sorted(set(tables or ()) - set(manifest))
    if missing or not manifest:
        raise SnapshotError(f"{group} has not published {missing or 'anything'}")
    return {
        table: spark.read.format(fmt).load(f"{entry['path']}/{entry['folder']}")
        for table, entry in manifest.items()
        if tables is None or table in tables
    }

