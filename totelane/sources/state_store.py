"""Stored routes as numbered snapshots of parts by tote.

A run reads the newest committed snapshot and writes the parts that it changes beside it; the
next snapshot takes all other parts from the one before. The commit file comes last, so a run
that dies leaves the newest committed snapshot in force. It has the name of its version and is
put in place by a rename that fails where the name is taken: of two writers that started from
one snapshot, only one can commit.

Who sends something out before it commits reserves the version first, and with it the ids that
it sends. Nobody else can commit a reserved version, and ids of a reservation are not given out
again, whatever becomes of it. A writer that died is started again under its id, or its
reservation is released by hand.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from totelane import schemas
from totelane.sources.parts import Files, TakenError, parts_of
from totelane.sources.warehouse import canonical_state, empty_state

#: Parts of a new store. A part should hold some 100 MB; a store keeps the number it began with.
PARTS = 16
RUN, ANSWERS = "run", "answers"
_LOGGED = "version long, run_id string, kind string, content string"


@dataclass(frozen=True)
class Snapshot:
    """``last_id`` is the highest id ever given out, also to rows removed since and in runs
    that never committed. ``folders`` has the folder of each of the ``parts`` that has rows."""

    version: int
    state: DataFrame
    last_id: int
    parts: int = PARTS
    folders: dict[int, str] = field(default_factory=dict)


class StaleSnapshotError(RuntimeError):
    """Somebody else committed, or is about to commit, after the snapshot a commit is based on."""


def _name(version: int) -> str:
    return f"v{version:08d}"


class StateStore:
    def __init__(self, spark: SparkSession, root: str, parts: int = PARTS):
        self.spark, self.files, self._parts = spark, Files(spark, root), parts

    @property
    def root(self) -> str:
        return self.files.root

    def _newest(self) -> dict | None:
        names = self.files.names("commits")
        return self.files.read(f"commits/{names[-1]}") if names else None

    def latest(self) -> Snapshot:
        newest = self._newest()
        if newest is None:
            return Snapshot(0, empty_state(self.spark), self._reserved_ids(0), self._parts)
        folders = {int(n): folder for n, folder in newest["folders"].items()}
        return self._snapshot(newest, folders)

    def _snapshot(self, commit: dict, folders: dict[int, str]) -> Snapshot:
        state = canonical_state(self.files.read_parts(folders, schemas.TOTE_ROUTER))
        last_id = max(commit["last_id"], self._reserved_ids(commit["version"]))
        return Snapshot(commit["version"], state, last_id, commit["parts"], folders)

    def state_of(self, snapshot: Snapshot, parts: list[int]) -> DataFrame:
        """The rows of some parts; the files of the others are not read."""
        return canonical_state(self.files.read_parts(snapshot.folders, schemas.TOTE_ROUTER, parts))

    def _logged(self, run_id: str, kind: str) -> DataFrame | None:
        if not self.files.names("commits"):
            return None
        commits = self.spark.read.schema(_LOGGED).json(f"{self.root}/commits")
        return commits.filter((F.col("run_id") == run_id) & (F.col("kind") == kind))

    def has_run(self, run_id: str, kind: str = RUN, content: str | None = None) -> bool:
        """Whether a writer of that kind and id has committed. ``content`` says what it would
        write: another content under the same id is an error, as it would be lost."""
        found = self._logged(run_id, kind)
        row = None if found is None else found.first()
        if row is not None and content is not None and row["content"] != content:
            raise ValueError(f"{kind} {run_id!r} was committed with other content")
        return row is not None

    def _reservations(self, version: int) -> list[str]:
        return [x for x in self.files.names("reserved") if x.startswith(_name(version))]

    def _holder(self, version: int) -> str | None:
        """The writer that holds a version, if any."""
        names = self._reservations(version)
        return self.files.read(f"reserved/{names[-1]}")["run_id"] if names else None

    def _reserved_ids(self, version: int) -> int:
        """The highest id in reservations of the version after ``version``; a commit has those
        of all before."""
        rows = (self.files.read(f"reserved/{name}") for name in self._reservations(version + 1))
        return max((row["last_id"] for row in rows), default=0)

    def _reserve(self, version: int, run_id: str | None, last_id: int) -> None:
        place = len(self._reservations(version)) + 1
        try:
            self.files.put_once(
                f"reserved/{_name(version)}-{place:04d}.json", {"run_id": run_id, "last_id": last_id}
            )
        except TakenError as taken:
            raise StaleSnapshotError(str(taken)) from taken

    def reserve(self, based_on: Snapshot, run_id: str, last_id: int) -> None:
        """Keep the version after ``based_on``, and ids up to ``last_id``, for ``run_id``."""
        self._check(based_on, run_id)
        self._reserve(based_on.version + 1, run_id, last_id)

    def release(self, run_id: str) -> bool:
        """Give up the reservation of a writer that will not come back; its ids stay used."""
        newest = self._newest()
        version = newest["version"] if newest else 0
        if self._holder(version + 1) != run_id:
            return False
        self._reserve(version + 1, None, self._reserved_ids(version))
        return True

    def _check(self, based_on: Snapshot, run_id: str) -> None:
        newest = self._newest()
        if (newest["version"] if newest else 0) != based_on.version:
            raise StaleSnapshotError(f"version {based_on.version} is not the newest")
        holder = self._holder(based_on.version + 1)
        if holder not in (None, run_id):
            raise StaleSnapshotError(f"version {based_on.version + 1} is reserved by {holder!r}")

    def commit(
        self,
        based_on: Snapshot,
        state: DataFrame,
        run_id: str,
        last_id: int,
        changed: Iterable[int] | None = None,
        kind: str = RUN,
        content: str | None = None,
    ) -> Snapshot:
        """Write the snapshot after ``based_on``, which must be the newest. ``state`` is the
        whole of it or, with ``changed``, the rows of these parts; the others stay."""
        version = based_on.version + 1
        self._check(based_on, run_id)
        folders: dict[int, str] = {}
        if changed is not None:
            changed = set(changed)
            folders = {n: x for n, x in based_on.folders.items() if n not in changed}
        if changed is None or changed:
            folder = f"state/{_name(version)}-{uuid.uuid4().hex[:8]}"
            rows = state.select(*schemas.TOTE_ROUTER.fieldNames(), "tote_key")
            folders |= self.files.write_parts(rows, "tote_key", based_on.parts, folder)
        row = {
            "version": version,
            "run_id": run_id,
            "kind": kind,
            "content": content,
            "last_id": last_id,
            "parts": based_on.parts,
            "folders": folders,
        }
        try:
            self.files.put_once(f"commits/{_name(version)}.json", row)
        except TakenError as taken:
            raise StaleSnapshotError(str(taken)) from taken
        return self._snapshot(row, folders)

    def changed_parts(self, snapshot: Snapshot, totes: DataFrame) -> list[int]:
        return parts_of(totes, "tote_key", snapshot.parts)

    def expire(self, keep: int) -> int:
        """Remove the parts that none of the ``keep`` newest snapshots has, those of writers
        that lost a race as well; commits stay, so that runs are still known. The number of
        parts removed. Not while readers use old snapshots."""
        if keep < 1:
            raise ValueError("the newest snapshot must stay")
        names = self.files.names("commits")
        if not names:
            return 0
        used = {
            folder
            for name in names[-keep:]
            for folder in self.files.read(f"commits/{name}")["folders"].values()
        }
        newest, removed = int(re.sub(r"\D", "", names[-1])), 0
        for folder in self.files.names("state"):
            if int(folder[1:9]) > newest:  # of a writer that is at work
                continue
            parts = [f"state/{folder}/{x}" for x in self.files.names(f"state/{folder}") if "=" in x]
            unused = [x for x in parts if x not in used]
            removed += sum(self.files.remove(x) for x in unused)
            if len(unused) == len(parts):
                self.files.remove(f"state/{folder}")
        return removed
