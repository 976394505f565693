"""Data sources that Spark plans and executors read or write: XML units, documents, rule files, index files, listings.

``register(spark)`` makes them known by name, and lets filters be pushed to them. Each declares its schema, plans its
partitions from sizes of files alone, and takes the filters that it can answer before or while it reads. Files are reached
through pyarrow, by path or URI (local, shared mounts, object stores, HDFS).

=====================  =========================================================================================
``lexmill_xml``        units of XML files (read)
``lexmill_documents``  whole documents (read, write)
``lexmill_rules``      search and replace rules of StartRule blocks (read); long files are read in parts
``lexmill_index``      numbers, one a line (read); long files are read in parts
``lexmill_listing``    paths, sizes and times of files (read); contents are not
=====================  =========================================================================================
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringEndsWith, StringStartsWith, WriterCommitMessage

from ..functions.xmltext import units

#: Bytes that one partition reads, about; an option ``partBytes`` sets another number.
PART_BYTES = 32 << 20
#: Parts beyond which parts grow, up to PART_BYTES: each costs a task that starts and ends.
MANY_PARTS = 64
#: Characters of documents that a task hands on, or takes, at once, about.
BATCH_BYTES = 4 << 20
#: Names of files that writers keep beside documents.
STAGING, MANIFESTS = "_staging", "_manifests"


def reached(path: str):
    """(file system, path in it)."""
    from pyarrow import fs

    if re.match(r"file:/(?!//)", path):
        path = "file:///" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _hidden(path: str) -> bool:
    return any(p.startswith(("_", ".")) for p in path.split("/"))


def _files(root: str, suffix: str = "") -> list[tuple[str, str, int, object]]:
    """(path below the root, path, size, time) of the files at or below a path, in order; hidden ones are left out."""
    from pyarrow import fs

    system, at = reached(root)
    at = at.rstrip("/")
    info = system.get_file_info(at)
    if info.type == fs.FileType.File:
        return [(at.rsplit("/", 1)[-1], at, info.size, info.mtime)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(root)
    found = [(f.path[len(at) + 1 :], f.path, f.size, f.mtime) for f in system.get_file_info(fs.FileSelector(at, recursive=True)) if f.type == fs.FileType.File]
    return sorted(f for f in found if f[0].endswith(suffix) and not _hidden(f[0]))


@dataclass
class Part(InputPartition):
    """Pieces of files: (path below the root, path, begin, end); end 0 is a whole file."""

    pieces: list[tuple[str, str, int, int]] = field(default_factory=list)


class _Reader(DataSourceReader):
    """Plans parts of about ``partBytes`` and keeps those filters that tell which files, or which rows, are wanted."""

    #: Columns whose value is known from the file alone: name -> value of the path below the root.
    by_file = {"file": lambda name: name}
    splits = False

    def __init__(self, options):
        self.root, self.suffix = options["path"], options.get("suffix", "")
        self.part = int(options.get("partBytes", PART_BYTES))
        self.tests: list[tuple[str, str, object]] = []
        self.row_columns: tuple[str, ...] = ()

    def pushFilters(self, filters: list[Filter]):
        kinds = {EqualTo: "eq", In: "in", StringStartsWith: "starts", StringEndsWith: "ends", LessThan: "lt", LessThanOrEqual: "le", GreaterThan: "gt", GreaterThanOrEqual: "ge"}
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if type(f) in kinds and (name in self.by_file or name in self.row_columns):
                self.tests.append((name, kinds[type(f)], f.value))
            else:
                yield f

    @staticmethod
    def _holds(kind: str, want, value) -> bool:
        if value is None:
            return False
        return {"eq": lambda: value == want, "in": lambda: value in want, "starts": lambda: value.startswith(want), "ends": lambda: value.endswith(want), "lt": lambda: value < want, "le": lambda: value <= want, "gt": lambda: value > want, "ge": lambda: value >= want}[kind]()

    def wanted(self, **values) -> bool:
        return all(self._holds(kind, want, values[name]) for name, kind, want in self.tests if name in values)

    def partitions(self):
        pieces, sizes = [], {}
        for name, path, size, _ in _files(self.root, self.suffix):
            sizes[path] = size
            if not self.wanted(**{c: f(name) for c, f in self.by_file.items()}):
                continue
            if self.splits and size > self.part:
                pieces += [(name, path, a, min(size, a + self.part)) for a in range(0, size, self.part)]
            else:
                pieces.append((name, path, 0, size if self.splits else 0))
        # Of many small pieces several are one part, and those that follow each other in a file one piece.
        lengths = [p[3] - p[2] or sizes[p[1]] for p in pieces]
        most = max(self.part, min(PART_BYTES, sum(lengths) // MANY_PARTS))
        parts, held, room = [], [], 0
        for p, n in zip(pieces, lengths, strict=True):
            if held and room + n > most:
                parts.append(Part(held))
                held, room = [], 0
            if held and held[-1][1] == p[1] and held[-1][3] == p[2]:
                p = (*held.pop()[:3], p[3])
            held.append(p)
            room += n
        return [*parts, Part(held)] if held else parts or [Part([])]

    def read(self, partition: Part):
        system, _ = reached(self.root)
        for name, path, begin, end in partition.pieces:
            with system.open_input_file(path) as f:
                yield from self.rows(name, f, begin, end)

    def rows(self, name: str, f, begin: int, end: int):
        raise NotImplementedError


def _text(raw: bytes) -> str:
    return raw.decode("utf-8-sig" if raw.startswith(b"\xef\xbb\xbf") else "utf-8", "replace")


def _records(f, begin: int, end: int, mark: bytes):
    """What lies between marks: the records that begin in a piece of a file, read on past its end. The first record of a
    file begins it; any other begins behind a mark."""
    base = max(0, begin - len(mark))  # a mark may end just where the piece begins
    f.seek(base)
    held, at, ours = b"", 0, begin == 0
    while True:
        block = f.read(1 << 20)
        held = held[at:] + block
        base, at = base + at, 0
        while (i := held.find(mark, at)) >= 0:
            if ours:
                yield held[at:i]
            at, ours = i + len(mark), True
            if base + at >= end:
                return
        if not block:
            if ours:
                yield held[at:]
            return


class _XmlReader(_Reader):
    by_file = {"file": lambda name: name}

    def __init__(self, options):
        super().__init__(options)
        self.plugin = options.get("plugin")
        self.row_columns = ("rec", "edid")

    def rows(self, name, f, begin, end):
        plugin = self.plugin or name.rsplit("/", 1)[-1]
        for i, v, attributes in units(_text(f.read())):
            if self.wanted(rec=v.get("REC"), edid=v.get("EDID")):
                yield name, i, f"{name}#{i}", plugin, v.get("REC"), v.get("EDID"), v.get("Source"), v.get("Dest"), attributes


class XmlUnits(DataSource):
    @classmethod
    def name(cls):
        return "lexmill_xml"

    def schema(self):
        return "file string, xml_index bigint, unit_id string, plugin string, rec string, edid string, source string, dest string, attributes map<string,string>"

    def reader(self, schema):
        return _XmlReader(self.options)


class _RuleReader(_Reader):
    splits = True
    by_file = {"file": lambda name: name}

    def __init__(self, options):
        super().__init__(options)
        self.row_columns = ("search",)

    def rows(self, name, f, begin, end):
        for block in _records(f, begin, end, b"StartRule"):
            found = dict(re.findall(r"(?m)^[ \t]*(Search|Replace)[ \t]*=[ \t]*(.*?)[ \t\r]*$", _text(block)))
            if found.get("Search") and self.wanted(search=found["Search"]):
                yield name, found["Search"], found.get("Replace", "")


class TermRules(DataSource):
    @classmethod
    def name(cls):
        return "lexmill_rules"

    def schema(self):
        return "file string, search string, replace string"

    def reader(self, schema):
        return _RuleReader(self.options)


class _IndexReader(_Reader):
    splits = True
    by_file = {"file": lambda name: name}

    def __init__(self, options):
        super().__init__(options)
        self.row_columns = ("xml_index",)

    def rows(self, name, f, begin, end):
        for line in _records(f, begin, end, b"\n"):
            if re.fullmatch(rb"\s*\d{1,18}\s*", line) and self.wanted(xml_index=int(line)):
                yield name, int(line)


class IndexFile(DataSource):
    @classmethod
    def name(cls):
        return "lexmill_index"

    def schema(self):
        return "file string, xml_index bigint"

    def reader(self, schema):
        return _IndexReader(self.options)


class _ListingReader(_Reader):
    by_file = {"path": lambda name: name}

    def partitions(self):
        """One part for the files of the folder, and one for each folder in it."""
        from pyarrow import fs

        system, at = reached(self.root)
        at = at.rstrip("/")
        inside = system.get_file_info(fs.FileSelector(at))
        folders = [f.path for f in inside if f.type == fs.FileType.Directory and not _hidden(f.base_name)]
        return [Part([("", at, 0, 0)]), *(Part([(f[len(at) + 1 :], f, 1, 0)]) for f in sorted(folders))]

    def read(self, partition):
        from pyarrow import fs

        system, at = reached(self.root)
        for name, path, deep, _ in partition.pieces:
            for f in system.get_file_info(fs.FileSelector(path, recursive=bool(deep))):
                below = f"{name}/{f.path[len(path) + 1 :]}" if deep else f.base_name
                if f.type == fs.FileType.File and not _hidden(below) and below.endswith(self.suffix) and self.wanted(path=below):
                    yield below, f.size, f.mtime


class Listing(DataSource):
    @classmethod
    def name(cls):
        return "lexmill_listing"

    def schema(self):
        return "path string, length bigint, modified timestamp"

    def reader(self, schema):
        return _ListingReader(self.options)


@dataclass
class Written(WriterCommitMessage):
    """What one task has written: (file, path below the root, draft, sha256, bytes); no draft where it was there before."""

    files: list[tuple[str, str, str, str, int]]


class _DocumentWriter(DataSourceWriter):
    """Tasks write drafts; the job's commit gives them their names, and says in a manifest what it wrote.

    A task that runs again writes other drafts, and those of the attempt that was lost go with the staging folder. A file
    that is there already is never replaced: the same content counts as written, so a job that was cut off while it
    committed can run again; other content is an error, found by the task, before anything has a name.
    """

    def __init__(self, root: str, job: str):
        self.root, self.job = root.rstrip("/"), job

    def _folder(self, at: str) -> str:
        return f"{at}/{STAGING}/{self.job}"

    def write(self, iterator):
        system, at = reached(self.root)
        folder = f"{self._folder(at)}/{uuid.uuid4().hex}"
        system.create_dir(folder, recursive=True)
        files = []
        for n, row in enumerate(iterator):
            file, name, content = row[0], row[1], row[2].encode("utf-8")
            if not name or _hidden(name) or name.startswith("/"):
                raise ValueError(f"not a name for a document: {name!r}")
            sha, draft = hashlib.sha256(content).hexdigest(), f"{folder}/{n}"
            if _sha(system, f"{at}/{name}") is None:
                with system.open_output_stream(draft) as out:
                    out.write(content)
            elif _sha(system, f"{at}/{name}") != sha:
                raise FileExistsError(f"{name} is there already, with other content")
            else:
                draft = ""
            files.append((file, name, draft, sha, len(content)))
        return Written(files)

    def commit(self, messages):
        system, at = reached(self.root)
        files = [f for m in messages if m for f in m.files]
        names = [f[1] for f in files]
        if len(set(names)) < len(names):
            raise ValueError(f"two documents are named {next(n for n in names if names.count(n) > 1)}")
        for folder in {f"{at}/{n}".rsplit("/", 1)[0] for n in names}:
            system.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda f: system.move(f[2], f"{at}/{f[1]}") if f[2] else None, files))
        system.create_dir(f"{at}/{MANIFESTS}", recursive=True)
        with system.open_output_stream(f"{at}/{MANIFESTS}/{self.job}.json") as out:
            for file, name, _, sha, n in sorted(files, key=lambda f: f[1]):
                out.write((json.dumps({"file": file, "path": name, "sha256": sha, "bytes": n}) + "\n").encode())
        self._clear(system, at)

    def abort(self, messages):
        """Tasks that are told to stop may still write for a while: it is cleared until nothing comes any more."""
        system, at = reached(self.root)
        quiet = 0
        for _ in range(40):
            try:
                quiet = 0 if self._clear(system, at) else quiet + 1
            except OSError:  # a draft came while the folder was deleted
                quiet = 0
            if quiet == 3:
                return
            time.sleep(0.25)
        self._clear(system, at)

    def _clear(self, system, at) -> bool:
        """Whether there was anything."""
        from pyarrow import fs

        there = system.get_file_info(self._folder(at)).type == fs.FileType.Directory
        if there:
            system.delete_dir(self._folder(at))
        return there


def _sha(system, path: str) -> str | None:
    """Digest of a file by blocks; None where there is none."""
    from pyarrow import fs

    if system.get_file_info(path).type != fs.FileType.File:
        return None
    sha = hashlib.sha256()
    with system.open_input_stream(path) as f:
        while block := f.read(1 << 20):
            sha.update(block)
    return sha.hexdigest()


class _DocumentReader(_Reader):
    by_file = {"path": lambda name: name}

    def read(self, partition):
        """Batches of a few MB: one of as many rows as Spark takes at once could hold a whole part several times."""
        import pyarrow as pa

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], names=["path", "content", "sha256"])

        held, size = [], 0
        for row in super().read(partition):
            held.append(row)
            size += len(row[1])
            if size > BATCH_BYTES:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()

    def rows(self, name, f, begin, end):
        raw = f.read()
        yield name, raw.decode("utf-8", "replace"), hashlib.sha256(raw).hexdigest()


class Documents(DataSource):
    @classmethod
    def name(cls):
        return "lexmill_documents"

    def schema(self):
        return "path string, content string, sha256 string"

    def reader(self, schema):
        return _DocumentReader(self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("documents are never replaced: append to a new folder")
        return _DocumentWriter(self.options["path"], self.options.get("job") or uuid.uuid4().hex)


SOURCES = (XmlUnits, TermRules, IndexFile, Listing, Documents)


def register(spark: SparkSession) -> None:
    """Makes the sources known to a session, lets filters reach them, and bounds what Python takes at once."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    for s in SOURCES:
        spark.dataSource.register(s)


def open_(spark: SparkSession, name: str, path: str, **options):
    register(spark)
    return spark.read.format(f"lexmill_{name}").options(**options).load(path)
