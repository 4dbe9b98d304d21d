"""Replacing written folders so that a crash at any moment leaves whole data to read.

A new version of a folder is written beside it, in a hidden folder. One small file, the pointer, then
publishes it, together with the new versions of other folders that belong to it; from that moment
readers that follow pointers see all of them. After that the folders are moved into place and the
pointer goes, so that readers that know nothing of pointers find plain folders. Each step can be
done again: what a crash has left half done is finished by the next publication.

    <parent>/.publish/_<name>-<version>/     a version that is being written, or waits to be moved
    <parent>/.publish/_<version>.json        the pointer: which folders it replaces, and by what
    <parent>/<name>/_layer.json              the version that a folder holds, and how it was written

One writer at a time may replace a folder. Without handles of the JVM folders are overwritten in place.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from saleslane.jvm import Files

HIDDEN = ".publish"
NOTE = "_layer.json"


@dataclass(frozen=True)
class Layer:
    """Where the current version of a folder lies, and what was noted about it."""

    path: str
    note: Mapping[str, object]

    @property
    def version(self) -> str | None:
        return self.note.get("version")


def split_path(path: str) -> tuple[str, str]:
    """(parent, name) of a folder."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent or ("/" if path.startswith("/") else "."), name


def _pointers(files: Files, parent: str) -> list[str]:
    """Pointers that are not settled, newest first; their names begin with the time."""
    hidden = f"{parent}/{HIDDEN}"
    return [f"{hidden}/{n}" for n in reversed(files.names(hidden)) if n.endswith(".json")]


def current(spark: SparkSession, path: str) -> Layer:
    """The published version of a folder."""
    files = Files.of(spark, path)
    if files is None:
        return Layer(path, {})
    parent, name = split_path(path)
    found = path
    for pointer in _pointers(files, parent):
        folder = json.loads(files.read(pointer) or "{}").get(name)
        if folder is not None:
            # once it has been moved into place it is where it belongs
            waiting = f"{parent}/{HIDDEN}/{folder}"
            found = waiting if files.exists(waiting) else path
            break
    return Layer(found, json.loads(files.read(f"{found}/{NOTE}") or "{}"))


class Publication:
    """New versions of folders with one parent, published together when the block ends well.

        with Publication(spark, parent) as out:
            df.write.parquet(out.stage("table"))

    If the block fails its versions go, and nothing has changed.
    """

    def __init__(self, spark: SparkSession, parent: str):
        self.parent, self.files = parent.rstrip("/") or "/", Files.of(spark, parent)
        self.hidden = f"{self.parent}/{HIDDEN}"
        # in order of time, for the names of the pointers
        self.version = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
        self._staged: dict[str, str] = {}
        self._notes: dict[str, dict[str, object]] = {}

    def __enter__(self) -> Publication:
        return self

    def stage(self, name: str, **note: object) -> str:
        """Where the new version of the folder ``name`` is to be written, with a note about it.

        What a writer that was killed has left of this folder is moved into place if it was published,
        and else removed.
        """
        if self.files is None:
            return f"{self.parent}/{name}"
        settle(self.files, self.parent, name)
        left = re.compile(rf"_{re.escape(name)}-[0-9]{{15}}-[0-9a-f]{{8}}(-old|-work|-new)?")
        for folder in filter(left.fullmatch, self.files.names(self.hidden)):
            if self.version not in folder:
                self.files.remove(f"{self.hidden}/{folder}")
        self._staged[name] = f"_{name}-{self.version}"
        self._notes[name] = note
        return f"{self.hidden}/{self._staged[name]}"

    def layer(self, name: str) -> Layer:
        """A staged version, to be read before it is published."""
        if self.files is None:
            return Layer(f"{self.parent}/{name}", {})
        return Layer(f"{self.hidden}/{self._staged[name]}", self._notes[name])

    def adopt(self, name: str, folder: str, **note: object) -> None:
        """Let what has been written to ``folder``, if anything, be the new version of ``name``."""
        path = self.stage(name, **note)
        if self.files.exists(folder):
            self.files.move(folder, path)
        else:
            self.files.write(f"{path}/_SUCCESS", "")

    def work(self, name: str) -> str:
        """A folder for what is written on the way to ``name``; it goes when the block ends."""
        beside = self.hidden if self.files else self.parent
        return f"{beside}/_{name}-{self.version}-work"

    def __exit__(self, kind, error, trace) -> None:
        if self.files is None:
            return
        if kind is None and self._staged:
            self.publish()  # what it leaves if it fails is needed by readers
        for name in self.files.names(self.hidden):
            if self.version in name:
                self.files.remove(f"{self.hidden}/{name}")
        self.files.remove_empty(self.hidden)

    def publish(self) -> None:
        """Note the version in every folder, write the pointer, and move the folders into place."""
        for name, folder in self._staged.items():
            note = {"version": self.version, **self._notes[name]}
            self.files.write(f"{self.hidden}/{folder}/{NOTE}", json.dumps(note))
        beside = f"{self.hidden}/{next(iter(self._staged.values()))}-new"
        self.files.write(f"{self.hidden}/_{self.version}.json", json.dumps(self._staged), beside)
        for name in self._staged:
            settle(self.files, self.parent, name)


def settle(files: Files, parent: str, name: str) -> None:
    """Move what is published for ``name``, and with it, into place; what is done is not done again."""
    hidden = f"{parent}/{HIDDEN}"
    for pointer in reversed(_pointers(files, parent)):
        published = json.loads(files.read(pointer) or "{}")
        if name not in published:
            continue
        for target, folder in published.items():
            if not files.exists(f"{hidden}/{folder}"):
                continue  # it is in place
            old = f"{hidden}/{folder}-old"
            if files.exists(f"{parent}/{target}"):
                files.remove(old)
                files.move(f"{parent}/{target}", old)
            files.move(f"{hidden}/{folder}", f"{parent}/{target}")
            files.remove(old)
        files.remove(pointer)
