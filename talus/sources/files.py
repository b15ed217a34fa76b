"""Files and folders of any file system that Spark knows.

A place without a scheme, or with ``file:``, is a :class:`pathlib.Path`; any
other is a :class:`Uri`. Both have names, parents and ``/``; what touches the
file system goes through the functions here, which use the session's Hadoop
file systems for a ``Uri``.
"""

from __future__ import annotations

import fnmatch
import os
import posixpath
import re
import shutil
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession

#: Folders, separated by commas, that every machine of a cluster has mounted at the same place.
MOUNTS = "spark.talus.mounts"
#: What a folder holds once all of it is there.
DONE = "_SUCCESS"

_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]+:/")


@dataclass(frozen=True, order=True)
class Uri:
    """A place on a file system that is named by a scheme."""

    text: str

    def __str__(self) -> str:
        return self.text

    def __truediv__(self, name: object) -> Uri:
        return Uri(f"{self.text.rstrip('/')}/{name}")

    @property
    def name(self) -> str:
        return posixpath.basename(self.text.rstrip("/"))

    @property
    def suffix(self) -> str:
        return posixpath.splitext(self.name)[1]

    @property
    def stem(self) -> str:
        return posixpath.splitext(self.name)[0]

    @property
    def parent(self) -> Uri:
        return Uri(posixpath.dirname(self.text.rstrip("/")))

    def with_name(self, name: str) -> Uri:
        return self.parent / name


Place = Path | Uri


def place(text: object) -> Place:
    """The place that a path or URI names, ``$VARIABLES`` and ``~`` filled in."""
    if isinstance(text, (Path, Uri)):
        return text
    text = os.path.expandvars(str(text))
    if text.startswith("file:"):
        return Path(re.sub(r"^file:/+", "/", text))
    return Uri(text) if _SCHEME.match(text) else Path(text).expanduser()


def spark_path(at: Place) -> str:
    """The place as Spark's readers and writers take it."""
    return str(at) if isinstance(at, Uri) else f"file://{at.absolute()}"


def _session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def _hadoop(at: Uri):
    """The file system of a place, and the place as it names it."""
    spark = _session()
    path = spark._jvm.org.apache.hadoop.fs.Path(str(at))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(at: Place) -> bool:
    if isinstance(at, Path):
        return at.exists()
    fs, path = _hadoop(at)
    return fs.exists(path)


def is_folder(at: Place) -> bool:
    if isinstance(at, Path):
        return at.is_dir()
    fs, path = _hadoop(at)
    return fs.exists(path) and fs.getFileStatus(path).isDirectory()


def is_complete(at: Place) -> bool:
    """Whether an output is there in whole: a folder says so itself."""
    return exists(at) and (not is_folder(at) or exists(at / DONE))


def make_folder(at: Place) -> None:
    if isinstance(at, Path):
        at.mkdir(parents=True, exist_ok=True)
    else:
        fs, path = _hadoop(at)
        fs.mkdirs(path)


def listed(folder: Place, *patterns: str) -> list[Place]:
    """What fits the patterns, one for each level below ``folder``, by name; nothing where there is no folder."""
    if isinstance(folder, Path):
        return sorted(folder.glob("/".join(patterns)))
    found = [folder]
    for pattern in patterns:
        below = []
        for at in found:
            fs, path = _hadoop(at)
            if is_folder(at):
                names = (status.getPath().getName() for status in fs.listStatus(path))
                below += [at / name for name in names if fnmatch.fnmatchcase(name, pattern)]
        found = below
    return sorted(found)


def size(at: Place) -> int:
    if isinstance(at, Path):
        return at.stat().st_size
    fs, path = _hadoop(at)
    return fs.getFileStatus(path).getLen()


def delete(at: Place) -> None:
    """Remove a file or a whole folder, if it is there."""
    if isinstance(at, Uri):
        fs, path = _hadoop(at)
        fs.delete(path, True)
    elif at.is_dir():
        shutil.rmtree(at, ignore_errors=True)
    else:
        at.unlink(missing_ok=True)


def beside(at: Place, ending: str = "") -> Place:
    """A hidden place next to ``at`` that nothing else uses."""
    return at.with_name(f".{at.name}.{uuid.uuid4().hex}{ending}")


def publish(made: Place, at: Place) -> None:
    """Put what was made in place of whatever is at ``at``; until then readers see the old, or nothing.

    A file is renamed over the old one in one step where the file system can,
    and so is a folder where there is none yet. A store without renames gets
    copies: a file is seen once it is closed, a folder is complete
    (:func:`is_complete`) once its last file, ``_SUCCESS``, is copied.
    """
    if isinstance(at, Path):
        if at.is_dir():
            shutil.rmtree(at)
        made.replace(at)
        return
    fs, path = _hadoop(at)
    _, source = _hadoop(made)
    folder = is_folder(made)
    if not folder and not is_folder(at) and _renamed_over(made, at):
        return
    delete(at)
    if _renamed(fs, source, path):
        return
    if folder:
        fs.mkdirs(path)
        names = [status.getPath().getName() for status in fs.listStatus(source)]
        for name in sorted(names, key=lambda n: (n == DONE, n)):
            _copy(made / name, at / name)
    else:
        _copy(made, at)
    delete(made)


def _renamed(fs, source, path) -> bool:
    return fs.rename(source, path)


def _renamed_over(made: Uri, at: Uri) -> bool:
    """Rename a file over another in one step; False where the file system can't."""
    from py4j.protocol import Py4JJavaError

    spark = _session()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    fs = jvm.org.apache.hadoop.fs
    how = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    try:
        source, path = fs.Path(str(made)), fs.Path(str(at))
        fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration()).rename(source, path, how)
        return True
    except Py4JJavaError:
        return False


def _copy(source: Uri, to: Uri) -> None:
    spark = _session()
    (source_fs, source_path), (fs, path) = _hadoop(source), _hadoop(to)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(source_fs, source_path, fs, path, False, True, spark._jsc.hadoopConfiguration())


def put(local: Path, at: Place) -> None:
    """Copy a file of this machine to a place, as a whole."""
    if isinstance(at, Path):
        made = beside(at)
        shutil.copyfile(local, made)
        made.replace(at)
        return
    fs, path = _hadoop(at)
    fs.copyFromLocalFile(False, True, _session()._jvm.org.apache.hadoop.fs.Path(f"file://{local.absolute()}"), path)


def joined(parts: Sequence[Place], to: Place, head: str, tail: str, less: int = 0) -> None:
    """Write ``head``, the files ``parts`` one after another but for the last ``less`` bytes, and ``tail``.

    Bytes go from stream to stream; nothing is decoded and no file is held.
    """
    sizes = [size(p) for p in parts]
    parts = [p for p, n in zip(parts, sizes) if n]
    sizes = [n for n in sizes if n]
    if sizes:
        sizes[-1] -= less
    if isinstance(to, Path):
        with to.open("wb") as out:
            out.write(head.encode())
            for part, n in zip(parts, sizes):
                with part.open("rb") as source:
                    shutil.copyfileobj(source, out, 1 << 20)
                out.seek(n - part.stat().st_size, os.SEEK_CUR)
            out.truncate()
            out.write(tail.encode())
        return
    copy = _session()._jvm.org.apache.hadoop.io.IOUtils.copyBytes
    fs, path = _hadoop(to)
    out = fs.create(path, True)
    try:
        out.write(bytearray(head.encode()))
        for part, n in zip(parts, sizes):
            source_fs, source = _hadoop(part)
            stream = source_fs.open(source)
            try:
                copy(stream, out, n, False)
            finally:
                stream.close()
        out.write(bytearray(tail.encode()))
    finally:
        out.close()


def check_writable(at: Place) -> None:
    """Raise where tasks would write to their own machines' disks: a ``file:`` place that not all of them share.

    A session on one machine shares everything; a cluster what lies within
    ``spark.checkpoint.dir`` or one of the folders that ``spark.talus.mounts`` names.
    """
    spark = _session()
    if isinstance(at, Uri) or re.match(r"local(\[.*\])?$", spark.sparkContext.master):
        return
    named = [spark.conf.get("spark.checkpoint.dir", None) or "", *spark.conf.get(MOUNTS, "").split(",")]
    shared = [place(n.strip()) for n in named if n.strip()]
    if not any(isinstance(s, Path) and at.absolute().is_relative_to(s.absolute()) for s in shared):
        raise RuntimeError(f"{at} is on each machine's own disk; name a shared file system, or the mounted folder in {MOUNTS}")
