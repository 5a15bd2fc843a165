"""Journal of a table's partition changes, so that a driver that dies leaves nothing half done.

It lies in ``_journal`` inside the table, which readers skip. A change first has its rows
in a staging folder, then an entry that names the partitions to move; from then on the
change counts as made, and whoever finds the entry makes the moves that are still open. The
moves are renames of whole folders and can be repeated. A rollback entry names a backup of
a partition that some work may spoil; whoever finds it puts the backup back.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

#: Hidden folders of a table: entries, rows to be published, partitions that were replaced, backups.
ENTRIES, STAGED, OLD, BACKUPS = "_journal", "_staged", "_replaced", "_backup"


class Journal:
    """The journal of the table at a path; the driver sees folder names, no rows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, path.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path(self.root).getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def _exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def _delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def _names(self, folder: str) -> list[str]:
        """Names in a folder; none if it is absent."""
        if not self._exists(folder):
            return []
        return sorted(status.getPath().getName() for status in self.fs.listStatus(self._path(folder)))

    def names(self, folder: str) -> list[str]:
        """Names in a folder of the table."""
        return self._names(f"{self.root}/{folder}")

    def _move(self, source: str, target: str) -> None:
        to = self._path(target)
        self.fs.mkdirs(to.getParent())
        if not self.fs.rename(self._path(source), to):
            raise OSError(f"cannot move {source} to {target}")

    def _write(self, name: str, entry: dict) -> None:
        """An entry is there as a whole or not at all: it is written under another name and renamed."""
        hidden = f"{self.root}/{ENTRIES}/.{name}-{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(hidden), True)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        self._move(hidden, f"{self.root}/{ENTRIES}/{name}")

    def _read(self, name: str) -> dict:
        stream = self.fs.open(self._path(f"{self.root}/{ENTRIES}/{name}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _entries(self, kind: str) -> list[str]:
        return [name for name in self._names(f"{self.root}/{ENTRIES}") if name.startswith(kind)]

    # --- changes of partitions ---

    def begin(self) -> str:
        """Folder in which a change writes its rows."""
        return f"{self.root}/{STAGED}/{uuid.uuid4().hex}"

    def folders(self, staged: str, depth: int) -> list[str]:
        """Partition folders below a staging folder, as relative paths."""
        found = [""]
        for _ in range(depth):
            found = [f"{at}/{name}".lstrip("/") for at in found for name in self._names(f"{staged}/{at}".rstrip("/")) if "=" in name]
        return found

    def publish(self, staged: str | None, folders: list[str], removed: list[str]) -> None:
        """Replace the named partitions by the staged ones and drop the removed ones."""
        if folders or removed:
            self._write(name := f"change-{uuid.uuid4().hex}", {"staged": staged, "folders": folders, "removed": [r for r in removed if r not in folders]})
            self._finish(name)
        elif staged:
            self._delete(staged)
        # a table without rows is a table too
        self.fs.mkdirs(self._path(self.root))
        self.spark.catalog.refreshByPath(self.root)

    def _finish(self, name: str) -> None:
        """Make the moves of an entry that are still open, then forget it."""
        entry = self._read(name)
        old = f"{self.root}/{OLD}/{name}"
        for folder in entry["folders"]:
            source, target = f"{entry['staged']}/{folder}", f"{self.root}/{folder}"
            if self._exists(source):  # else it has been moved already
                if self._exists(target):
                    self._move(target, f"{old}/{folder}")
                self._move(source, target)
        for folder in entry["removed"]:
            if self._exists(f"{self.root}/{folder}"):
                self._move(f"{self.root}/{folder}", f"{old}/{folder}")
        self._delete(f"{self.root}/{ENTRIES}/{name}")
        self._delete(old)
        if entry["staged"]:
            self._delete(entry["staged"])

    def recover(self) -> list[str]:
        """Finish the changes that have an entry and delete staged rows that have none."""
        changes = self._entries("change-")
        for name in changes:
            self._finish(name)
        for folder in self._names(f"{self.root}/{STAGED}"):
            self._delete(f"{self.root}/{STAGED}/{folder}")
        return [f"finished {name}" for name in changes]

    # --- backups ---

    def backup_path(self) -> str:
        return f"{self.root}/{BACKUPS}/{uuid.uuid4().hex}"

    def open_rollback(self, entry: dict, backup: str) -> dict:
        """Note a backup that counts until the entry is closed."""
        entry = entry | {"backup": backup, "name": f"rollback-{uuid.uuid4().hex}"}
        self._write(entry["name"], entry)
        return entry

    def open_rollbacks(self) -> list[dict]:
        return [self._read(name) for name in self._entries("rollback-")]

    def close_rollback(self, entry: dict) -> None:
        """The partition is as it should be; the backup may go."""
        self._delete(f"{self.root}/{ENTRIES}/{entry['name']}")
        self._delete(entry["backup"])
