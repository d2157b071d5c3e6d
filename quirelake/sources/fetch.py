"""Fetching selected files from a service, verified by their digests; what was fetched before and verifies is left alone."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterable, Iterator, Mapping
from datetime import datetime, timezone
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.sources.files import safe_member
from quirelake.sources.listing import retried

#: Downloads at once that a service stands, and bytes read at once.
AT_ONCE, BLOCK = 6, 1 << 20
SCHEMA = "item_id string, local_path string, status string, sha1 string, sha256 string, size_bytes long, fetched_at string"


def credentials(have: Mapping[str, str]) -> tuple[str, dict[str, str]] | None:
    """How to sign in: a developer's token before client credentials, None where neither is whole. For use on the driver."""
    if have.get("token"):
        return "token", {"token": have["token"]}
    names = ("client_id", "client_secret", "enterprise_id")
    return ("client", {n: have[n] for n in names}) if all(have.get(n) for n in names) else None


def preflight(steps: Iterable[tuple[str, Callable[[dict], object]]]) -> list[tuple[str, bool, str]]:
    """(step, passed, said) of checks before a run, in order; each gets what those before it gave by name, and the first
    that raises or gives nothing ends it."""
    known: dict[str, object] = {}
    out: list[tuple[str, bool, str]] = []
    for name, check in steps:
        try:
            known[name] = check(known)
            passed, said = bool(known[name]), "" if known[name] else "nothing found"
        except Exception as error:
            passed, said = False, f"{type(error).__name__}: {error}"
        out.append((name, passed, said))
        if not passed:
            break
    return out


def wanted(files: DataFrame, column: str = "selected", limit: int | None = None, order: str = "item_id") -> DataFrame:
    """The rows that were selected, or all where nothing was selected yet (no such column); ``limit`` takes the first ones."""
    rows = files.filter(F.col(column)) if column in files.columns else files
    return rows if limit is None else rows.orderBy(order).limit(limit)


def digests(path: Path) -> tuple[str, str, int]:
    """SHA-1, SHA-256 and size of a file, read in blocks."""
    one, two, size = hashlib.sha1(), hashlib.sha256(), 0
    with path.open("rb") as source:
        while block := source.read(BLOCK):
            one.update(block)
            two.update(block)
            size += len(block)
    return one.hexdigest(), two.hexdigest(), size


def fetch_one(download: Callable[[str], Iterable[bytes]], item: str, name: str, sha1: str | None, folder: str, target: str) -> tuple:
    """One file into ``target``: (item_id, local_path, status, sha1, sha256, size, fetched_at).

    status: already_present, ok, sha1_mismatch, path_traversal_blocked or download_error:<kind>. Bytes go to a name of
    their own beside the file and take its name when whole, so an interrupted download never looks like a file.
    """
    relative = f"{folder}/{name}".strip("/")
    if not safe_member(relative):
        return item, None, "path_traversal_blocked", None, None, None, None
    out = Path(target) / relative
    try:
        out.parent.mkdir(parents=True, exist_ok=True)
        if sha1 and out.exists():
            one, two, size = digests(out)
            if one == sha1:
                return item, str(out), "already_present", one, two, size, None
        part = out.with_name(f".{out.name}.{os.getpid()}.part")
        with part.open("wb") as sink:
            for block in retried(download, item):
                sink.write(block)
        one, two, size = digests(part)
        part.replace(out)
    except Exception as error:
        return item, None, f"download_error:{type(error).__name__}", None, None, None, None
    if sha1 and one != sha1:
        return item, str(out), "sha1_mismatch", one, None, size, None
    return item, str(out), "ok", one, two, size, datetime.now(timezone.utc).isoformat()


def fetch(files: DataFrame, download: Callable[[str], Iterable[bytes]], target: str, at_once: int = AT_ONCE) -> DataFrame:
    """The files of (item_id, name, sha1, folder) fetched into ``target``, a folder that all executors share.

    As many tasks as the service stands downloads. A task that is run again finds what it fetched and verifies it.
    """

    def run(parts: Iterator[pd.DataFrame]):
        for part in parts:
            rows = [fetch_one(download, i, n, s, f or "", target) for i, n, s, f in zip(part["item_id"], part["name"], part["sha1"], part["folder"], strict=True)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")]).astype({"size_bytes": "Int64"})

    return files.select("item_id", "name", "sha1", "folder").repartition(at_once, "item_id").mapInPandas(run, SCHEMA)


def with_members(fetched: DataFrame, members: DataFrame) -> DataFrame:
    """Fetched files and, below them, the members of those that were archives; columns that one side lacks are null."""
    return fetched.unionByName(members.withColumnRenamed("parent_archive", "local_path"), allowMissingColumns=True)


def write_fetched(fetched: DataFrame, manifest: str) -> bool:
    """``fetched.parquet`` beside the manifest; nothing is written, nor anything there replaced, where there are no rows."""
    from quirelake.sources.tables import write_unless_empty

    return write_unless_empty(fetched, manifest.rstrip("/").rpartition("/")[0] + "/fetched.parquet")
