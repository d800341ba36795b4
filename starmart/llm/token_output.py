"""Token ids in binary segments with Elias-Fano document boundaries.

Documents in ascending id order are dealt over range partitions; each partition is one
segment of two files below the output folder (any store that pyarrow opens by URI):

``seg-N.ids``  the ids of its documents, end id included, one after the other, little
               endian, 2 bytes each if the vocabulary allows, else 4
``seg-N.idx``  header, Elias-Fano code of the boundaries (start of every document and the
               end), Elias-Fano code of the document ids

Elias-Fano keeps n sorted values below u in about 2 + log2(u / n) bits each: low
bits packed, high bits in unary. ``select(i)`` finds the i-th value through a directory of one
32-bit position per 256 values; there is no table of 64-bit offsets, neither in the file nor in a
reader, which decodes the boundaries of the documents it is about to return from where select puts the first.

A segment is written under an attempt's own name and then renamed, so a task that runs
again leaves the same file. The manifest (one row per segment, Parquet) is
what readers start from; starts of segments are its prefix sums.

Defined cases: null text is empty and has the end id alone; null ids come first; rows
equal in id follow each other in order of their text's hash; an empty table gives an empty manifest;
columns other than ``doc_id`` and ``text`` are not written.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import materialise

from . import common
from .lexicon import Codec

MAGIC = b"SMTOK1\0\0"
SAMPLE = 256
CACHE = 600_000           # word pieces a Python worker remembers
READ_BYTES = 8 << 20      # ids that a reader holds at once
READ_DOCS = 4096          # and documents
MANIFEST = "segment int, n_docs long, n_nulls long, n_ids long, width int"


class EliasFano:
    """Sorted non-negative integers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, n_upper: int, low: np.ndarray, upper: np.ndarray, marks: np.ndarray):
        self.n, self.low_bits, self.n_upper, self.low, self.upper, self.marks = n, low_bits, n_upper, low, upper, marks

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, "<u4"))
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        n_upper = int(at[-1]) + 1
        bits = np.zeros(n_upper, np.uint8)
        bits[at] = 1
        places = np.arange(low_bits, dtype=np.uint64)
        low = ((values[:, None] >> places) & np.uint64(1)).astype(np.uint8).ravel()
        return cls(n, low_bits, n_upper, np.packbits(low, bitorder="little"), np.packbits(bits, bitorder="little"),
                   at[::SAMPLE].astype("<u4"))

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(last - first, np.uint64)
        a, b = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(self.low[a // 8:(b + 7) // 8], bitorder="little")[a % 8:a % 8 + b - a]
        return bits.reshape(-1, self.low_bits).astype(np.uint64) @ (np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))

    def select(self, i: int) -> int:
        """The i-th value."""
        return ((self._place(i) - i) << self.low_bits) | int(self._low(i, i + 1)[0])

    def _place(self, i: int) -> int:
        """Place of the i-th one: jump to the sampled position before it, count ones from there."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        bit, left = int(self.marks[i // SAMPLE]), i % SAMPLE
        at, ones = bit // 8, 0
        skip = bit % 8
        while True:
            bits = np.unpackbits(self.upper[at:at + 64], bitorder="little")
            bits[:skip] = 0
            here = np.flatnonzero(bits)
            if ones + len(here) > left:
                return at * 8 + int(here[left - ones])
            ones, at, skip = ones + len(here), at + 64, 0

    def values(self, first: int, last: int) -> np.ndarray:
        """Values first to last (exclusive): ones are read on from the place that select finds for the first."""
        if first >= last:
            return np.zeros(0, np.uint64)
        bit = self._place(first)
        at, skip, found, have = bit // 8, bit % 8, [], 0
        while have < last - first:
            step = max(64, (last - first - have) // 2)
            bits = np.unpackbits(self.upper[at:at + step], bitorder="little")
            bits[:skip] = 0
            here = np.flatnonzero(bits) + at * 8
            found.append(here)
            have, at, skip = have + len(here), at + step, 0
        place = np.concatenate(found)[:last - first]
        high = (place - np.arange(first, last)).astype(np.uint64) << np.uint64(self.low_bits)
        return high | self._low(first, last)

    def to_bytes(self) -> bytes:
        parts = [x.tobytes() for x in (self.low, self.upper, self.marks)]
        return struct.pack("<6Q", self.n, self.low_bits, self.n_upper, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        n, low_bits, n_upper, *sizes = struct.unpack_from("<6Q", data, at)
        at += 48
        parts = []
        for size, kind in zip(sizes, (np.uint8, np.uint8, "<u4"), strict=True):
            parts.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
            at += size
        return cls(n, low_bits, n_upper, *parts), at


_WORKER: dict[str, Encoder] = {}
_ODD = re.compile(r" (?!\S)")
_INNER = re.compile(r" (?=\S)")
_LONE = re.compile(r"(?<=\S) (?=\S)")
_WORD = re.compile(r" [^ ]*\S")       # a space and a word without blanks at its ends


class Encoder:
    """Ids of whole texts by the tokenizers library, with a memory of word pieces.

    The pre-tokenizer starts a new piece at a single space between two non-blanks, so a
    text's ids are those of the parts cut there, one after the other. Parts seen before are
    looked up; new ones are cut further at other sure piece ends (a single line end, a
    comma or full stop after a letter) and encoded by the library. The memory is bounded;
    parts beyond it are encoded again for each batch. A tokenizer that may not be taken apart so
    (``Codec.by_part``) gets whole texts.
    """

    def __init__(self, path: str, end_id: int):
        self.codec = Codec.of(path)
        self.type = "<u2" if max(self.codec.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        self.end = np.array([end_id], self.type).tobytes()
        self.plain: dict[str, bytes] = {}       # part -> ids
        self.spaced: dict[str, bytes] = {}      # part -> ids of a space and the part

    @classmethod
    def of(cls, path: str, end_id: int) -> Encoder:
        key = f"{path}:{end_id}"
        if key not in _WORKER:
            _WORKER[key] = cls(path, end_id)
        return _WORKER[key]

    def cut(self, text: str) -> list[str]:
        """Parts of the text; all but the first follow a space that belongs to them: one whose next character is no
        blank and, in a text that holds an added token, whose last is none either."""
        if any(token in text for token in self.codec.special):
            return _LONE.split(text)
        return _INNER.split(text) if _ODD.search(text) else text.split(" ")

    @classmethod
    def atoms(cls, part: str) -> list[str]:
        """A part, its leading space included, cut at sure piece ends inside it."""
        if "\n" in part:
            lines = part[1:].split("\n") if part[0] == " " else part.split("\n")
            if not all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                return [part]
            if part[0] == " ":
                lines[0] = " " + lines[0]
            return [y for k, x in enumerate(lines) for y in (["\n"] if k else []) + cls.atoms(x)]
        if len(part) > 2 and part[-1] in ".," and part[-2].isalpha() and part[:-1].lstrip(" ").isalpha():
            return [part[:-1], part[-1]]
        return [part]

    def _library(self, parts: set[str]) -> dict[str, bytes]:
        cut = {p: self.atoms(p) for p in parts if "\n" in p or p[-1:] in (".", ",")}
        new = parts.difference(cut).union(*cut.values())
        words = [a for a in new if _WORD.fullmatch(a)]
        flat, edges = self.codec.merge_joined(words)
        data, edges = flat.astype(self.type).tobytes(), (edges * np.dtype(self.type).itemsize).tolist()
        ids = {w: data[a:b] for w, a, b in zip(words, edges[:-1], edges[1:], strict=True)}
        rest = list(new.difference(words))
        ids.update(zip(rest, [x.astype(self.type).tobytes() for x in self.codec.merge(rest)], strict=True))
        ids.update([(p, b"".join([ids[a] for a in atoms])) for p, atoms in cut.items()])
        return ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text with the end id, as bytes."""
        if not self.codec.by_part:
            return [x.astype(self.type).tobytes() + self.end for x in self.codec.merge([t or "" for t in texts])]
        cut = [self.cut(t) if t else [] for t in texts]
        plain, spaced = self.plain, self.spaced
        new_plain = {p[0] for p in cut if p} - plain.keys()
        new_spaced = {p for parts in cut for p in parts[1:]} - spaced.keys()
        if new_plain or new_spaced:
            ids = self._library(new_plain | {" " + p for p in new_spaced})
            if len(plain) + len(spaced) > CACHE:
                plain, spaced = dict(plain), dict(spaced)
            plain.update((p, ids[p]) for p in new_plain)
            spaced.update((p, ids[" " + p]) for p in new_spaced)
        return [b"".join([plain[parts[0]], *map(spaced.__getitem__, parts[1:]), self.end]) if parts else self.end
                for parts in cut]


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in folder:
        folder = folder.removeprefix("file:")
        return pafs.LocalFileSystem(), folder
    return pafs.FileSystem.from_uri(folder)


def _runs(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts have about ``most`` bytes."""
    size = np.cumsum(np.nan_to_num(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)))
    at = 0
    while at < batch.num_rows:
        base = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, base + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Writes ``docs`` as segments below ``folder`` and returns the manifest, a written table."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder.of(tokenizer, end_id)
        width = np.dtype(enc.type).itemsize
        task = TaskContext.get()
        segment, attempt = task.partitionId(), task.taskAttemptId()
        fs, root = _open(folder)
        lengths: list[int] = []
        ids: list[np.ndarray] = []
        nulls, out = 0, None
        name = f"{root}/seg-{segment:06d}"
        for batch in batches:
            for part in _runs(batch, 4 << 20):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{name}.ids.{attempt}")
                got = enc.encode(part.column("text").to_pylist())
                out.write(b"".join(got))
                lengths += [len(x) // width for x in got]
                column = part.column("doc_id")
                nulls += column.null_count
                ids.append(column.drop_null().to_numpy(zero_copy_only=False))
        if out is None:
            return
        out.close()
        bounds = np.concatenate(([0], np.cumsum(np.array(lengths, np.int64))))
        known = np.concatenate(ids).astype(np.int64)
        least = int(known[0]) if len(known) else 0
        with fs.open_output_stream(f"{name}.idx.{attempt}") as idx:
            idx.write(MAGIC + struct.pack("<QQqQ", len(lengths), nulls, least, width))
            idx.write(EliasFano.encode(bounds).to_bytes())
            idx.write(EliasFano.encode((known - least).view(np.uint64)).to_bytes())
        for kind in ("ids", "idx"):
            fs.move(f"{name}.{kind}.{attempt}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pydict({
            "segment": pa.array([segment], pa.int32()), "n_docs": [len(lengths)], "n_nulls": [nulls],
            "n_ids": [int(bounds[-1])], "width": pa.array([width], pa.int32())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.md5("text").alias("_h"))
    dealt = rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h").select("doc_id", "text")
    return materialise(dealt.mapInArrow(write, MANIFEST), "token-manifest")


class Segment:
    """One segment opened for reading; ``doc(i)`` reads a single document through select."""

    def __init__(self, folder: str, segment: int):
        self.fs, root = _open(folder)
        self.name = f"{root}/seg-{segment:06d}"
        with self.fs.open_input_file(f"{self.name}.idx") as f:
            data = f.read()
        if data[:8] != MAGIC:
            raise ValueError(f"{self.name}.idx is no token index")
        self.n, self.nulls, self.least, self.width = struct.unpack_from("<QQqQ", data, 8)
        self.bounds, at = EliasFano.from_bytes(data, 40)
        self.ids, _ = EliasFano.from_bytes(data, at)

    def names(self, first: int, last: int) -> pd.Series:
        """Ids of documents first to last; null ones come first."""
        known = self.ids.values(max(first - self.nulls, 0), max(last - self.nulls, 0)).view(np.int64) + self.least
        return pd.array([None] * (last - first - len(known)) + known.tolist(), dtype="Int64")

    def read(self, first: int, last: int) -> np.ndarray:
        with self.fs.open_input_file(f"{self.name}.ids") as f:
            f.seek(first * self.width)
            return np.frombuffer(f.read((last - first) * self.width), f"<u{self.width}")

    def doc(self, i: int) -> np.ndarray:
        return self.read(self.bounds.select(i), self.bounds.select(i + 1))


def read_tokens(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it), n_tokens, ids (uint32 little endian)."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for number, start in zip(rows["segment"], rows["start"], strict=True):
                seg = Segment(folder, int(number))
                at = 0
                while at < seg.n:
                    bounds = seg.bounds.values(at, min(at + READ_DOCS, seg.n) + 1).astype(np.int64)
                    many = int(np.searchsorted(bounds, bounds[0] + READ_BYTES // seg.width, "right")) - 1
                    many = min(max(many, 1), len(bounds) - 1)
                    base = int(bounds[0])
                    ids = seg.read(base, int(bounds[many])).astype("<u4")
                    yield pd.DataFrame({
                        "doc_id": seg.names(at, at + many), "start": bounds[:many] + int(start), "n_tokens": np.diff(bounds[:many + 1]),
                        "ids": [ids[a - base:b - base].tobytes() for a, b in
                                zip(bounds[:many].tolist(), bounds[1:many + 1].tolist(), strict=True)]})
                    at += many

    starts = manifest.withColumn("_b", F.floor(F.col("segment") / common.BUCKETS_PER_GROUP))
    starts = common.with_prefix(starts, [], "_b", [F.col("segment")], F.col("n_ids"), "start")
    n = max(1, manifest.count())
    return (starts.select("segment", "start").repartition(n, "segment")
            .mapInPandas(read, "doc_id long, start long, n_tokens long, ids binary"))
