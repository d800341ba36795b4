"""A paged endpoint as a data source (A7): numbered pages, the window ends at the first empty one.

Answers of an endpoint are landed as ``<path>/page=N/<file>``, one JSON document a line, pages counted from 0. Reading starts at
page 0, or where a stream stopped, and goes on to the first empty page, as a client's loop does; a page missing before it
is an error, not an end. A Spark partition is a range of pages, so pages are read in parallel. As a stream the
offset is the number of the next page: pages are read once whatever run reads them, and an empty last page is asked for
again by the next run.

Use: ``spark.dataSource.register(LandedPages)``, then ``spark.read.format("landed_pages").option("path", ...)`` or ``readStream``. Option
``pages_per_partition`` (default 64). Columns: ``page int, item string``.

``df.write.format("landed_pages").mode("append")`` lands pages so: the rows of a page must lie together in one partition (``repartition("page")``,
``sortWithinPartitions("page")``); a task writes one file a page, named by the page, so one that runs again writes the same
files, and the empty page that ends the window comes last.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow.fs as pafs
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition,
                                    WriterCommitMessage)

SCHEMA = "page int, item string"
PAGE = re.compile(r"/page=(\d+)/(?![._])[^/]+$")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return (pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:")))


def window(path: str, first: int = 0) -> list[list[str]]:
    """Files of the pages from ``first`` to the first empty page (exclusive), or to the last one landed."""
    fs, root = _open(path)
    pages: dict[int, list[pafs.FileInfo]] = {}
    for info in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
        m = PAGE.search(info.path)
        if m and int(m[1]) >= first:
            pages.setdefault(int(m[1]), []).append(info)
    out: list[list[str]] = []
    for n in range(first, max(pages, default=first - 1) + 1):
        if n not in pages:
            raise ValueError(f"page {n} of {path} has not landed, but a later one has")
        if not sum(f.size for f in pages[n]):
            break
        out.append(sorted(f.path for f in pages[n]))
    return out


class PageRange(InputPartition):
    def __init__(self, first: int, files: list[list[str]]):
        self.first, self.files = first, files


def _ranges(path: str, first: int, last: int | None, size: int) -> list[PageRange]:
    files = window(path, first)
    files = files if last is None else files[:last - first]
    return [PageRange(first + a, files[a:a + size]) for a in range(0, len(files), size)]


def _rows(path: str, part: PageRange) -> Iterator[tuple[int, str]]:
    fs, _ = _open(path)
    for k, files in enumerate(part.files if part else []):       # no range: no pages
        for name in files:
            with fs.open_input_stream(name) as f:
                for line in f.read().decode("utf-8").split("\n"):
                    if line:
                        yield part.first + k, line


class _Options:
    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("pages_per_partition", 64))


class PageReader(_Options, DataSourceReader):
    def partitions(self) -> list[PageRange]:
        return _ranges(self.path, 0, None, self.size)

    def read(self, partition: PageRange) -> Iterator[tuple[int, str]]:
        return _rows(self.path, partition)


class PageStream(_Options, DataSourceStreamReader):
    def __init__(self, options: dict):
        super().__init__(options)
        self.seen = 0

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        self.seen += len(window(self.path, self.seen))
        return {"page": self.seen}

    def partitions(self, start: dict, end: dict) -> list[PageRange]:
        return _ranges(self.path, start["page"], end["page"], self.size)

    def commit(self, end: dict) -> None:
        self.seen = max(self.seen, end["page"])

    def read(self, partition: PageRange) -> Iterator[tuple[int, str]]:
        return _rows(self.path, partition)


@dataclass
class Landed(WriterCommitMessage):
    last: int       # highest page of a task; -1: none


class PageWriter(_Options, DataSourceWriter):
    def write(self, iterator: Iterator) -> Landed:
        fs, root = _open(self.path)
        last = -1
        for page, rows in groupby(iterator, lambda r: r[0]):
            fs.create_dir(f"{root}/page={page}", recursive=True)
            with fs.open_output_stream(f"{root}/page={page}/part-0.txt") as f:
                f.write("".join(f"{r[1]}\n" for r in rows).encode("utf-8"))
            last = max(last, page)
        return Landed(last)

    def commit(self, messages: list) -> None:
        fs, root = _open(self.path)
        empty = f"{root}/page={max((m.last for m in messages if m is not None), default=-1) + 1}"
        fs.create_dir(empty, recursive=True)
        fs.open_output_stream(f"{empty}/part-empty").close()


class LandedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)

    def streamReader(self, schema) -> PageStream:
        return PageStream(self.options)

    def writer(self, schema, overwrite: bool) -> PageWriter:
        return PageWriter(self.options)
