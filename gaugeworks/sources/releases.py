"""Results that are there whole or not at all.

A run's tables and files are staged in a folder of their own.  A manifest lists every
file with its size and every table and document with its digest; it is written last, and
one numbered pointer, made by a rename that fails where the name is taken, turns the run
into the current release.  Whatever dies before leaves the earlier release as it was;
what it has staged is cleared by a later run.

All of it lies below one folder that the engine owns, ``gaugeworks-output``, so that
nothing else in the target folder is touched.  Everything goes through Hadoop's file
systems; tables are written by the executors.
"""

from __future__ import annotations

import hashlib
import io
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.errors import GaugeError

from .sinks import sha256_json, table_digest, workbook_writer, write_table

OWN, RUNS, POINTERS, MANIFEST = "gaugeworks-output", "runs", "pointers", "manifest.json"
#: seconds that an unfinished run of some other writer is left alone
GRACE = 24 * 3600.0


class ReleaseError(GaugeError):
    reason_code = "release_error"


class _Files:
    """Hadoop's view of one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        path = self.jvm.org.apache.hadoop.fs.Path(root)
        self.fs = path.getFileSystem(self.conf)
        self.root = self.fs.makeQualified(path).toString().rstrip("/")

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def sizes(self, folder: str) -> dict[str, int]:
        """Every file below a folder, by its path from there."""
        out, found = {}, self.fs.listFiles(self.path(folder), True)
        top = self.path(folder).toUri().getPath() + "/"
        while found.hasNext():
            s = found.next()
            out[s.getPath().toUri().getPath().removeprefix(top)] = s.getLen()
        return out

    def age(self, name: str) -> float:
        return time.time() - self.fs.getFileStatus(self.path(name)).getModificationTime() / 1000

    def read(self, name: str) -> bytes:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def create(self, name: str, data: bytes) -> None:
        """A new file, whole; an error where the name is taken."""
        part = self.path(f"{name}.{uuid.uuid4().hex}.part")
        out = self.fs.create(part, True)
        for at in range(0, len(data), 1 << 20):
            out.write(data[at:at + (1 << 20)])
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri(), self.conf)
        context.rename(part, self.path(name), self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0))

    def writer(self, name: str, hashed) -> BinaryIO:
        """A file of a run that isn't released yet, written piece by piece."""
        out = self.fs.create(self.path(name), True)

        class Piecewise(io.RawIOBase):
            def writable(self):
                return True

            def write(self, data):
                hashed.update(data)
                out.write(bytes(data))
                return len(data)

            def close(self):
                if not self.closed:
                    out.close()
                super().close()

        return io.BufferedWriter(Piecewise(), 1 << 20)

    def digest(self, name: str) -> str:
        """SHA-256 of a file, read piece by piece."""
        stream, hashed = self.fs.open(self.path(name)), hashlib.sha256()
        try:
            while piece := bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(self.jvm.org.apache.commons.io.input.BoundedInputStream(stream, 1 << 20))):
                hashed.update(piece)
        finally:
            stream.close()
        return hashed.hexdigest()

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


@dataclass(frozen=True)
class Release:
    """A finished run: its number, folder and manifest."""

    number: int
    path: str
    manifest: dict

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        entry = self.manifest["tables"][name]
        reader = spark.read.format(entry["format"])
        return (reader.option("header", True) if entry["format"] == "csv" else reader).load(f"{self.path}/{name}")


@dataclass
class Draft:
    """A run that is being staged; nothing of it counts until :meth:`commit`."""

    owner: Releases
    run: str
    tables: dict[str, dict] = field(default_factory=dict)
    files: dict[str, str] = field(default_factory=dict)

    @property
    def path(self) -> str:
        return f"{self.owner.files.root}/{RUNS}/{self.run}"

    def put_table(self, name: str, df: DataFrame, fmt: str = "parquet") -> None:
        """Written by the executors; its digest is that of what can be read back."""
        spark = self.owner.spark
        write_table(df, f"{self.path}/{name}", fmt)
        back = spark.read.format(fmt)
        self.tables[name] = {"format": fmt, "digest": table_digest((back.option("header", True) if fmt == "csv" else back).load(f"{self.path}/{name}"))}

    def put_file(self, name: str, write: Callable[[BinaryIO], None]) -> None:
        """A file of the driver's, one that fits in its memory."""
        f = io.BytesIO()
        write(f)
        self.files[name] = hashlib.sha256(f.getvalue()).hexdigest()
        self.owner.files.create(f"{RUNS}/{self.run}/{name}", f.getvalue())

    def table(self, name: str) -> DataFrame:
        """A staged table, as it was written."""
        return Release(0, self.path, {"tables": self.tables}).table(self.owner.spark, name)

    def put_workbook(self, name: str, df: DataFrame, title: str) -> None:
        """A sheet; its rows stream to the run's folder and aren't held."""
        write, _ = workbook_writer(df, title)
        hashed = hashlib.sha256()
        sink = self.owner.files.writer(f"{RUNS}/{self.run}/{name}", hashed)
        write(sink)
        sink.close()
        self.files[name] = hashed.hexdigest()

    def put_json(self, name: str, payload: object) -> None:
        self.put_file(name, lambda f: f.write(json.dumps(payload, ensure_ascii=False, indent=2, default=str).encode()))

    def commit(self) -> Release:
        return self.owner._commit(self)


class Releases:
    """The runs below a folder; the current one is that of the highest pointer whose manifest holds."""

    def __init__(self, spark: SparkSession, folder: str, keep: int = 1, grace: float = GRACE):
        self.spark, self.keep, self.grace = spark, keep, grace
        self.files = _Files(spark, f"{folder.rstrip('/')}/{OWN}")

    def begin(self) -> Draft:
        draft = Draft(self, f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:12]}")
        self.files.fs.mkdirs(self.files.path(f"{RUNS}/{draft.run}"))
        return draft

    def _numbers(self) -> list[int]:
        return sorted(int(n[:10]) for n in self.files.names(POINTERS) if n.endswith(".json") and n[:10].isdigit())

    def _release(self, number: int) -> Release | None:
        try:
            pointer = json.loads(self.files.read(f"{POINTERS}/{number:010d}.json"))
            manifest = json.loads(self.files.read(f"{RUNS}/{pointer['run']}/{MANIFEST}"))
        except Exception:  # gone, or cut short by a file system that doesn't write files whole
            return None
        return Release(number, f"{self.files.root}/{RUNS}/{pointer['run']}", manifest) if sha256_json(manifest) == pointer["manifest"] else None

    def current(self) -> Release | None:
        return next((r for n in reversed(self._numbers()) if (r := self._release(n))), None)

    def _commit(self, draft: Draft) -> Release:
        numbers = self._numbers()
        manifest = {"run": draft.run, "tables": draft.tables, "files": draft.files, "sizes": self.files.sizes(f"{RUNS}/{draft.run}")}
        self.files.create(f"{RUNS}/{draft.run}/{MANIFEST}", json.dumps(manifest, ensure_ascii=False).encode())
        number = (numbers[-1] if numbers else 0) + 1
        pointer = json.dumps({"run": draft.run, "manifest": sha256_json(manifest)}).encode()
        try:
            self.files.create(f"{POINTERS}/{number:010d}.json", pointer)
        except Exception as e:
            raise ReleaseError("Another run was released meanwhile", number=number) from e
        self.recover()
        return Release(number, draft.path, manifest)

    def recover(self) -> list[str]:
        """Clear runs that no kept pointer names: older releases, and what dead runs have left; the runs that were cleared."""
        numbers = self._numbers()
        valid = [r for n in reversed(numbers) if (r := self._release(n))][: self.keep]
        kept = {r.manifest["run"] for r in valid}
        pointed = set()
        for n in numbers:
            if valid and n < valid[-1].number:
                try:
                    pointed.add(json.loads(self.files.read(f"{POINTERS}/{n:010d}.json"))["run"])
                except Exception:
                    pass  # cut short; nothing is known of its run but its age
                self.files.delete(f"{POINTERS}/{n:010d}.json")
        gone = []
        for run in self.files.names(RUNS):
            if run not in kept and (run in pointed or self.files.age(f"{RUNS}/{run}") >= self.grace):
                self.files.delete(f"{RUNS}/{run}")
                gone.append(run)
        return gone

    def verify(self, release: Release) -> list[str]:
        """What a release's files and tables have lost or changed since its manifest was written."""
        run = release.manifest["run"]
        now = {k: v for k, v in self.files.sizes(f"{RUNS}/{run}").items() if k != MANIFEST}
        bad = [n for n in sorted(now.keys() | release.manifest["sizes"].keys()) if now.get(n) != release.manifest["sizes"].get(n)]
        bad += [n for n, d in release.manifest["files"].items() if n in now and self._unlike(lambda n=n: self.files.digest(f"{RUNS}/{run}/{n}"), d)]
        whole = [n for n in release.manifest["tables"] if not any(b.startswith(f"{n}/") for b in bad)]
        bad += [n for n in whole if self._unlike(lambda n=n: table_digest(release.table(self.spark, n)), release.manifest["tables"][n]["digest"])]
        return sorted(set(bad))

    @staticmethod
    def _unlike(digest: Callable[[], object], expected: object) -> bool:
        try:
            return digest() != expected
        except Exception:  # what can't be read isn't what was written
            return True
