"""Staged writes that become visible together, with a log of what changed.

A job writes its files to a staging folder first. Publishing lists the moves (files to add, partition folders or whole
tables to replace) in a plan file; once the plan stands, the publication goes through: the moves are renames that can be
repeated, and ``recover`` finishes a plan that a lost driver left behind. Without a plan nothing of the staging folder is
ever visible, and the next attempt under the same key starts it over. So a failure leaves the old tables or the new ones.

Every publication under a key happens once: a second one under that key (a replayed micro-batch) changes nothing. Each
leaves a log entry naming the partitions that it touched; a reader of the log keeps the name of the last entry it has seen.
One writer at a time per home folder is assumed, as with any table of plain files. Readers of a folder that is being replaced can
fail and must be run again; they never see half of a pair of partitions once the job that wrote it has returned.

All folders begin with an underscore, which table readers pass over.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession


class Files:
    """The few file system calls that publishing needs, through Spark's own file systems."""

    def __init__(self, spark: SparkSession, at: str) -> None:
        jvm = spark._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.utils = jvm.org.apache.commons.io.IOUtils
        self.fs = self.path(at).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, at: str) -> bool:
        return self.fs.exists(self.path(at))

    def delete(self, at: str) -> None:
        self.fs.delete(self.path(at), True)

    def move(self, source: str, target: str) -> None:
        """Rename; the target must be free and its parent is made."""
        to = self.path(target)
        self.fs.mkdirs(to.getParent())
        if not self.fs.rename(self.path(source), to):
            raise OSError(f"{source} could not be moved to {target}")

    def names(self, at: str) -> list[str]:
        """Names in a folder, sorted; none if it is absent."""
        if not self.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(at)))

    def files(self, at: str) -> list[tuple[str, int]]:
        """(place below ``at``, bytes) of all data files below a folder, hidden ones left out."""
        if not self.exists(at):
            return []
        base = self.fs.makeQualified(self.path(at)).toString().rstrip("/")
        found, out = self.fs.listFiles(self.path(at), True), []
        while found.hasNext():
            status = found.next()
            place = status.getPath().toString()[len(base) + 1:]
            if not any(part.startswith(("_", ".")) for part in place.split("/")):
                out.append((place, status.getLen()))
        return sorted(out)

    def read(self, at: str) -> str:
        stream = self.fs.open(self.path(at))
        try:
            return self.utils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, at: str, text: str) -> None:
        """Write a small file so that it is there whole or not at all."""
        part = f"{at}.{uuid.uuid4().hex[:8]}.part"
        stream = self.fs.create(self.path(part), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.exists(at):
            self.delete(at)
        self.move(part, at)


class Publisher:
    """Publications of the tables that lie beside (or under) one home folder."""

    KEEP_LOG = 1000  # entries that stay when a log is trimmed
    KEEP_DONE = 50  # keys remembered as done; only a stream's last batch is ever replayed

    def __init__(self, spark: SparkSession, home: str) -> None:
        self.home = f"{home.rstrip('/')}/_publish"
        self.files = Files(spark, home)

    def stage(self, key: str) -> str | None:
        """An empty staging folder for ``key``; None if the key is published already (a planned one is finished first)."""
        folder = f"{self.home}/staged/{key}"
        if self.files.exists(f"{folder}/plan.json"):
            self._finish(key)
        if self.files.exists(f"{self.home}/done/{key}"):
            return None
        self.files.delete(folder)
        return folder

    def publish(self, key: str, *, add: dict[str, str] | None = None, replace_parts: dict[str, str] | None = None,
                replace: dict[str, str] | None = None, once: bool = False, state: dict | None = None,
                touched: list[str] | None = None) -> None:
        """Make staged tables visible, all of them or (until the plan stands) none.

        Each dict maps a staged table to its place: ``add`` moves its files there, ``replace_parts`` puts its partition folders in
        the place of those of the same name, ``replace`` the whole table. ``once`` remembers the key; ``state`` is kept as the
        home's new state. The log gets ``touched``, or else the partition folders that were added or replaced.
        """
        moves, folders = [], []
        for source, target in (add or {}).items():
            parts: dict[str, list[str]] = {}
            for place, _ in self.files.files(source):
                folder, _, name = place.rpartition("/")
                parts.setdefault(folder, []).append(name)
            for folder, names in parts.items():
                if self.files.exists(f"{target}/{folder}"):
                    moves += [[f"{source}/{folder}/{n}", f"{target}/{folder}/{key}-{n}"] for n in names]
                else:
                    moves.append([f"{source}/{folder}", f"{target}/{folder}"])
                folders.append(folder)
        for source, target in (replace_parts or {}).items():
            for folder in sorted({place.rpartition("/")[0] for place, _ in self.files.files(source)}):
                moves.append([f"{source}/{folder}", f"{target}/{folder}"])
                folders.append(folder)
        moves += [[source, target] for source, target in (replace or {}).items()]
        entry = f"{int(time.time() * 1000):013d}-{key}"
        plan = {"moves": moves, "entry": entry, "touched": folders if touched is None else touched, "once": once, "state": state}
        self.files.write(f"{self.home}/staged/{key}/plan.json", json.dumps(plan))
        self._finish(key)

    def _finish(self, key: str) -> None:
        folder = f"{self.home}/staged/{key}"
        plan = json.loads(self.files.read(f"{folder}/plan.json"))
        for source, target in plan["moves"]:
            if self.files.exists(source):  # else an earlier attempt has moved it
                if self.files.exists(target):
                    self.files.delete(target)
                self.files.move(source, target)
        if plan["state"] is not None:
            self.files.write(f"{self.home}/state.json", json.dumps(plan["state"]))
        if plan["touched"]:
            self.files.write(f"{self.home}/log/{plan['entry']}", json.dumps(plan["touched"]))
        if plan["once"]:
            self.files.write(f"{self.home}/done/{key}", plan["entry"])
            self._forget(key)
        self.files.delete(folder)

    def _forget(self, key: str) -> None:
        """Drop the oldest done keys of the same stream; keys end in a number that grows."""
        stream = key.rpartition("-")[0]
        own = [n for n in self.files.names(f"{self.home}/done") if n.rpartition("-")[0] == stream]
        for name in own[:-self.KEEP_DONE]:
            self.files.delete(f"{self.home}/done/{name}")

    def recover(self) -> int:
        """Finish what a lost driver had planned; how many publications that were."""
        planned = [k for k in self.files.names(f"{self.home}/staged") if self.files.exists(f"{self.home}/staged/{k}/plan.json")]
        for key in planned:
            self._finish(key)
        return len(planned)

    def log(self, after: str | None) -> list[tuple[str, list[str]]] | None:
        """(entry, partitions it touched) of the entries after a given one.

        None where the log cannot tell: nothing was ever logged, the reader has seen none yet, or entries after its last were trimmed.
        """
        trimmed = f"{self.home}/trimmed"
        if after is None or not self.files.exists(f"{self.home}/log") or (self.files.exists(trimmed) and after < self.files.read(trimmed)):
            return None
        return [(n, json.loads(self.files.read(f"{self.home}/log/{n}"))) for n in self.files.names(f"{self.home}/log") if n > after]

    def newest(self) -> str:
        """The newest log entry, empty if there is none."""
        return (self.files.names(f"{self.home}/log") or [""])[-1]

    def trim(self, upto: str, keep: int = KEEP_LOG) -> None:
        """Drop all but the newest ``keep`` of the entries up to ``upto``; readers that are further behind read everything again."""
        old = [n for n in self.files.names(f"{self.home}/log") if n <= upto][:-keep]
        if old:
            self.files.write(f"{self.home}/trimmed", old[-1])
        for name in old:
            self.files.delete(f"{self.home}/log/{name}")

    def state(self) -> dict:
        at = f"{self.home}/state.json"
        return json.loads(self.files.read(at)) if self.files.exists(at) else {}
