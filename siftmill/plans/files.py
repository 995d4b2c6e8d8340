"""Small files of any file system, as manifests and plans need them."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path
from typing import Protocol

from pyspark.sql import SparkSession


class Files(Protocol):
    """What manifests ask of a file system. Paths are those of the file system, listed ones relative to their root."""

    def is_file(self, path: str) -> bool: ...
    def read(self, path: str) -> bytes: ...
    def write(self, path: str, content: bytes) -> None: ...
    def status(self, path: str) -> tuple[int, int]: ...
    def digest(self, path: str) -> str: ...
    def listed(self, root: str, pattern: str) -> Iterator[str]: ...


class LocalFiles:
    """The driver's own disk."""

    def is_file(self, path: str) -> bool:
        return Path(path).is_file()

    def read(self, path: str) -> bytes:
        return Path(path).read_bytes()

    def write(self, path: str, content: bytes) -> None:
        """Writes a file beside the path and puts it in its place, so that readers never see half of it."""
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        handle, draft = tempfile.mkstemp(dir=Path(path).parent, prefix=Path(path).name)
        with os.fdopen(handle, "wb") as f:
            f.write(content)
        os.replace(draft, path)

    def status(self, path: str) -> tuple[int, int]:
        """Bytes, and nanoseconds of the last change."""
        found = os.stat(path)
        return found.st_size, found.st_mtime_ns

    def digest(self, path: str) -> str:
        with open(path, "rb") as f:
            return hashlib.file_digest(f, "sha256").hexdigest()

    def listed(self, root: str, pattern: str) -> Iterator[str]:
        yield from (str(p.relative_to(root)) for p in Path(root).glob(pattern) if p.is_file())


class HadoopFiles:
    """Any file system that Spark reads, reached through the driver's JVM."""

    #: Bytes of a file that are held at once.
    BLOCK = 1 << 20

    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(str(path))
        return target.getFileSystem(self._conf), target

    def is_file(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.exists(target) and fs.getFileStatus(target).isFile()

    def _blocks(self, path: str) -> Iterator[bytes]:
        fs, target = self._at(path)
        left, stream = fs.getFileStatus(target).getLen(), fs.open(target)
        try:
            while left > 0:
                block = bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, min(left, self.BLOCK)))
                left -= len(block)
                yield block
        finally:
            stream.close()

    def read(self, path: str) -> bytes:
        return b"".join(self._blocks(path))

    def write(self, path: str, content: bytes) -> None:
        """Writes a draft, then takes the old file away and gives the draft its name, which is not one step on all systems."""
        fs, target = self._at(path)
        _, draft = self._at(f"{target.getParent()}/.{target.getName()}.{uuid.uuid4().hex}")
        stream = fs.create(draft, True)
        try:
            stream.write(content)
        finally:
            stream.close()
        fs.delete(target, False)
        if not fs.rename(draft, target):
            raise OSError(f"{path} could not be written")

    def status(self, path: str) -> tuple[int, int]:
        fs, target = self._at(path)
        found = fs.getFileStatus(target)
        return found.getLen(), found.getModificationTime() * 1_000_000

    def digest(self, path: str) -> str:
        made = hashlib.sha256()
        for block in self._blocks(path):
            made.update(block)
        return made.hexdigest()

    def listed(self, root: str, pattern: str) -> Iterator[str]:
        fs, base = self._at(root)
        if not fs.exists(base):
            return
        base = fs.getFileStatus(base).getPath().toUri().getPath().rstrip("/")
        for status in fs.globStatus(self._at(f"{root.rstrip('/')}/{pattern}")[1]) or []:
            if status.isFile():
                yield status.getPath().toUri().getPath()[len(base) + 1 :]


LOCAL = LocalFiles()
