"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

1. Count: the corpus is cut at single spaces on the JVM and the words are counted over all documents
   (partial aggregates). The ``LEXICON_WORDS`` most frequent ones of at most ``WORD_BYTES`` bytes
   are the lexicon. Its size is a parameter and changes speed only, never an id.
2. Compile: one task gives these words their ids and builds the minimal acyclic transducer from them in
   byte order (Mihov and Maurel): equal suffixes share their states, ids stand on the transitions as
   early as all words below agree on them. It is written as one file in the shared folder.
3. Encode: every task maps that file into memory (shared by the workers of a machine; where the
   folder is no local mount its bytes are read instead). The distinct words of a run of texts walk through the transducer
   together, one byte a step. Words it does not accept are merged exactly by the tokenizer's own BPE model.
4. Decode: the byte strings of the ids are joined and read as UTF-8, broken sequences replaced.

Why words may be taken apart: the byte-level pre-tokenizer starts a new piece at a space whose next character is no
white space, so the ids of a text are those of the parts cut there, one after the other. Parts never cross
an added token. A tokenizer that is not of this kind (another pre-tokenizer, a normalizer, a post-processor, added tokens
that strip or need word borders) gets whole texts, and its own decoder. A full stop or comma after a letter is cut off too.

Defined cases: null text is empty; an empty text has no ids and decodes to an empty text; rows are
encoded one by one, so ties and repeated rows keep their number; a null or other id is only carried; a
text of one long word is one part; an empty table gives an empty result (its lexicon is empty);
input columns named like an output column are replaced, the others stay.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from starmart.session import materialise, scratch_path

from . import common

LEXICON_WORDS = 100_000
WORD_BYTES = 24
RUN_BYTES = 4 << 20       # text encoded together
TOGETHER = 200            # unseen words merged as one text
TAILS = ".,"
LAST_LETTER = "\u0250"    # letters before it are letters in every version of Unicode
MAGIC = b"SMFST1\0\0"
_INNER = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?!\S)")


class Transducer:
    """A minimal acyclic transducer: byte strings to sequences of ids."""

    ARRAYS = (("keys", "<i8"), ("target", "<u4"), ("out_at", "<u4"), ("out_n", "<u4"),
              ("final_at", "<i8"), ("final_n", "<u4"), ("pool", "<u4"))

    def __init__(self, **arrays: np.ndarray):
        for name, kind in self.ARRAYS:
            setattr(self, name, np.asarray(arrays[name]).astype(kind, copy=False))

    @classmethod
    def build(cls, words: list[tuple[bytes, tuple[int, ...]]]) -> Transducer:
        """From distinct words in byte order. A state under work is [transitions, final ids or None];
        a transition is [target, ids]. State 0 of the result is the start."""
        known: dict[tuple, int] = {}
        frozen: list[tuple] = []

        def freeze(state: list) -> int:
            key = (state[1], tuple((c, t[0], t[1]) for c, t in state[0].items()))
            if key not in known:
                known[key] = len(frozen)
                frozen.append(key)
            return known[key]

        path: list[list] = [[{}, None]]       # states on the way of the last word
        last = b""
        for word, ids in words:
            n = 0
            for a, b in zip(last, word):  # noqa: B905
                if a != b:
                    break
                n += 1
            for i in range(len(last), n, -1):
                path[i - 1][0][last[i - 1]][0] = freeze(path.pop())
            for i in range(n):
                step = path[i][0][word[i]]
                same = 0
                for a, b in zip(step[1], ids):  # noqa: B905
                    if a != b:
                        break
                    same += 1
                rest = step[1][same:]
                if rest:        # ids not shared by this word move one state on
                    step[1] = step[1][:same]
                    below = path[i + 1]
                    for t in below[0].values():
                        t[1] = rest + t[1]
                    if below[1] is not None:
                        below[1] = rest + below[1]
                ids = ids[same:]
            for i in range(n, len(word)):
                path[i][0][word[i]] = [-1, ()]
                path.append([{}, None])
            if n < len(word):
                path[n][0][word[n]][1] = ids
                path[-1][1] = ()
            else:
                path[-1][1] = ids
            last = word
        for i in range(len(last), 0, -1):
            path[i - 1][0][last[i - 1]][0] = freeze(path.pop())
        start = freeze(path[0])
        return cls._flat(frozen, start)

    @classmethod
    def _flat(cls, frozen: list[tuple], start: int) -> Transducer:
        name = list(range(len(frozen)))
        name[start], name[0] = 0, start       # the start takes number 0
        pool: list[int] = []
        places: dict[tuple, int] = {(): 0}

        def put(ids: tuple) -> int:
            if ids not in places:
                places[ids] = len(pool)
                pool.extend(ids)
            return places[ids]

        rows, final_at, final_n = [], [-1] * len(frozen), [0] * len(frozen)
        for s, (final, steps) in enumerate(frozen):
            if final is not None:
                final_at[name[s]], final_n[name[s]] = put(final), len(final)
            rows += [(name[s] * 256 + c, name[t], put(ids), len(ids)) for c, t, ids in steps]
        rows.sort()
        cols = np.array(rows, np.int64).reshape(-1, 4).T
        return cls(keys=cols[0], target=cols[1], out_at=cols[2], out_n=cols[3], final_at=np.array(final_at, np.int64),
                   final_n=np.array(final_n), pool=np.array(pool, np.int64))

    def to_bytes(self) -> bytes:
        parts = [getattr(self, name).tobytes() for name, _ in self.ARRAYS]
        head = MAGIC + struct.pack(f"<{len(parts)}Q", *map(len, parts))
        return head + b"".join(p + b"\0" * (-len(p) % 8) for p in parts)

    @classmethod
    def from_buffer(cls, data) -> Transducer:
        if bytes(data[:8]) != MAGIC:
            raise ValueError("no transducer file")
        sizes = struct.unpack_from(f"<{len(cls.ARRAYS)}Q", data, 8)
        at, arrays = 8 + 8 * len(sizes), {}
        for (name, kind), size in zip(cls.ARRAYS, sizes, strict=True):
            arrays[name] = np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at)
            at += size + -size % 8
        return cls(**arrays)

    def lookup(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(accepted, ids, bounds): the ids of word i are ids[bounds[i]:bounds[i + 1]]; none where it is not accepted."""
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        first = np.cumsum(size) - size
        data = np.frombuffer(b"".join(words), np.uint8)
        state = np.zeros(n, np.int64)
        live = np.arange(n)
        pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []     # (word, place in the pool, ids) of each step
        accepted = np.zeros(n, bool)
        for step in range(int(size.max(initial=0)) + 1):
            ends = live[size[live] == step]
            ends = ends[self.final_at[state[ends]] >= 0]
            accepted[ends] = True
            pieces.append((ends, self.final_at[state[ends]], self.final_n[state[ends]].astype(np.int64)))
            live = live[size[live] > step]
            if not len(live) or not len(self.keys):
                break
            key = state[live] * 256 + data[first[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            here = self.keys[at] == key
            live, at = live[here], at[here]
            state[live] = self.target[at]
            pieces.append((live, self.out_at[at].astype(np.int64), self.out_n[at].astype(np.int64)))
        word = np.concatenate([p[0] for p in pieces])
        place, count = np.concatenate([p[1] for p in pieces]), np.concatenate([p[2] for p in pieces])
        use = accepted[word] & (count > 0)
        order = np.argsort(word[use], kind="stable")         # steps of a word stay in order
        word, place, count = word[use][order], place[use][order], count[use][order]
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        ids = self.pool[np.repeat(place, count) + inside] if len(count) else np.zeros(0, "<u4")
        bounds = np.concatenate(([0], np.cumsum(np.bincount(word, weights=count, minlength=n).astype(np.int64))))
        return accepted, ids, bounds


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path:
        return pafs.LocalFileSystem(), path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path)


_WORKER: dict[tuple, object] = {}


def load(path: str) -> Transducer:
    """The transducer of a file, mapped into memory; once a worker."""
    if ("lexicon", path) not in _WORKER:
        fs, name = _open(path)
        if isinstance(fs, pafs.LocalFileSystem):
            data = pa.memory_map(name).read_buffer()
        else:
            with fs.open_input_file(name) as f:
                data = f.read_buffer()
        _WORKER["lexicon", path] = Transducer.from_buffer(data)
    return _WORKER["lexicon", path]


def _byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes
    stand for themselves, the others for the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Decoder:
    """The byte strings of the ids of a tokenizer file; the library's own decoder where they are not byte-level."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        self.by_byte = (said["decoder"] or {}).get("type") == "ByteLevel"
        self.path = path
        byte_of = _byte_of()
        vocab = dict(said["model"]["vocab"]) | {t["content"]: t["id"] for t in said["added_tokens"]}
        table = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            known = all(c in byte_of for c in token)
            table[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.size = np.fromiter(map(len, table), np.int64, len(table))
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(table), np.uint8)

    @classmethod
    def of(cls, path: str) -> Decoder:
        if ("decoder", path) not in _WORKER:
            _WORKER["decoder", path] = cls(path)
        return _WORKER["decoder", path]

    def decode(self, ids: bytes) -> str:
        """The text of ids, special ones kept; broken UTF-8 is replaced."""
        x = np.frombuffer(ids, "<u4")
        if not self.by_byte:
            return Codec.of(self.path).tokenizer.decode(x.tolist(), skip_special_tokens=False)
        count = self.size[x]
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return self.bytes[np.repeat(self.at[x], count) + inside].tobytes().decode("utf-8", "replace")


class Codec:
    """The tokenizer of a file; ``by_part`` tells whether texts may be cut into parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        said = json.loads(self.tokenizer.to_str())
        pre, added = said["pre_tokenizer"] or {}, said["added_tokens"]
        self.special = [t["content"] for t in added]
        self.by_part = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                        and not said["normalizer"] and not said["post_processor"] and said["model"]["type"] == "BPE"
                        and len(added) < 2 and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added))
        del said
        if self.by_part:
            space = next(c for c, b in _byte_of().items() if b == ord(" "))
            vocab = self.tokenizer.get_vocab(with_added_tokens=True)
            self.opens = np.zeros(max(vocab.values(), default=-1) + 1, bool)      # ids that begin with a space
            self.opens[[i for token, i in vocab.items() if token[:1] == space]] = True
            self.tail = {c: x.tobytes() for c, x in zip(TAILS, self.merge(list(TAILS)), strict=True)}

    @classmethod
    def of(cls, path: str) -> Codec:
        if ("codec", path) not in _WORKER:
            _WORKER["codec", path] = cls(path)
        return _WORKER["codec", path]

    def merge(self, parts: list[str]) -> list[np.ndarray]:
        """Ids by the library: the exact merges of each part."""
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def cut(self, text: str) -> list[list[str]]:
        """The text between added tokens, each as parts; all parts but the first of a piece follow a space that is theirs."""
        pieces = text.split(self.special[0]) if self.special else [text]
        return [_INNER.split(p) if _ODD.search(p) else p.split(" ") for p in pieces]

    def encode(self, texts: list[str | None], lexicon: Transducer | None) -> list[bytes]:
        """Ids of each text, little endian, 4 bytes each."""
        if not self.by_part:
            return [x.tobytes() for x in self.merge([t or "" for t in texts])]
        cut = [self.cut(t) if t else [] for t in texts]
        spaced = list({p for pieces in cut for parts in pieces for p in parts[1:]})
        first = list({parts[0] for pieces in cut for parts in pieces})
        # a full stop or comma after a letter is a piece of its own
        ended = {p: p[:-1] for p in spaced if p[-1] in TAILS and p[-2:-1].isalpha() and p[-2] < LAST_LETTER}
        words = list({ended.get(p, p) for p in spaced})
        of = dict(zip(words, self._words([b" " + p.encode() for p in words], lexicon), strict=True))
        of.update([(p, of[stem] + self.tail[p[-1]]) for p, stem in ended.items()])
        plain = {p: x.tobytes() for p, x in zip(first, self.merge(first), strict=True)}
        mark = np.array([self.tokenizer.token_to_id(self.special[0])], "<u4").tobytes() if self.special else b""

        def ids(pieces: list[list[str]]) -> bytes:
            return mark.join([b"".join([plain[parts[0]], *map(of.__getitem__, parts[1:])]) for parts in pieces])
        return [ids(pieces) if pieces else b"" for pieces in cut]

    def merge_joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, edges) of words that follow a space, hold no other and end in no white space: ``TOGETHER`` at a time are merged as
        one text, taken apart where an id begins with a space."""
        texts = ["".join(words[a:a + TOGETHER]) for a in range(0, len(words), TOGETHER)]
        ids = np.concatenate([np.zeros(0, "<u4"), *self.merge(texts)])
        return ids, np.append(np.flatnonzero(self.opens[ids]), len(ids))

    def merge_words(self, words: list[str]) -> list[bytes]:
        """Ids of words that follow a space, the space included."""
        out: list[bytes | None] = [None] * len(words)
        plain = [k for k, w in enumerate(words) if " " not in w[1:] and not w[-1].isspace()]
        ids, edges = self.merge_joined([words[k] for k in plain])
        data, edges = ids.tobytes(), (edges * 4).tolist()
        for k, a, b in zip(plain, edges[:-1], edges[1:], strict=True):
            out[k] = data[a:b]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, x in zip(rest, self.merge([words[k] for k in rest]), strict=True):
            out[k] = x.tobytes()
        return out

    def _words(self, words: list[bytes], lexicon: Transducer | None) -> list[bytes]:
        out: list[bytes | None] = [None] * len(words)
        if lexicon is not None and words:
            short = [k for k, w in enumerate(words) if len(w) <= WORD_BYTES]
            accepted, ids, bounds = lexicon.lookup([words[k] for k in short])
            data, edges = ids.astype("<u4").tobytes(), (bounds * 4).tolist()
            for k, ok, a, b in zip(short, accepted.tolist(), edges, edges[1:], strict=False):
                if ok:
                    out[k] = data[a:b]
        unseen = [k for k, x in enumerate(out) if x is None]
        for k, x in zip(unseen, self.merge_words([words[k].decode() for k in unseen]), strict=True):
            out[k] = x
        return out


def frequent_words(docs: DataFrame, most: int = LEXICON_WORDS) -> DataFrame:
    """The ``most`` most frequent words of all texts that follow a space and occur twice or more."""
    words = docs.select(F.explode(F.split(F.translate("text", "\n", " "), " ")).alias("word"))
    words = words.select(F.expr(f"trim(TRAILING '{TAILS}' FROM word)").alias("word"))
    words = words.where((F.col("word") != "") & (F.octet_length("word") < WORD_BYTES))
    return words.groupBy("word").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "word").limit(most)


def compile_lexicon(docs: DataFrame, tokenizer: str, most: int = LEXICON_WORDS) -> str:
    """Builds the lexicon of ``docs`` in one task of at most ``most`` words; the path of its file."""
    path = scratch_path(docs.sparkSession, "lexicon") + ".fst"

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = [w for b in batches for w in b["word"] if not w[0].isspace()]
        codec = Codec.of(tokenizer)
        known = []
        if codec.by_part:
            words = sorted({b" " + w.encode() for w in words if not any(s in w for s in codec.special)})
            ids = codec.merge([w.decode() for w in words])
            known = [(w, tuple(x.tolist())) for w, x in zip(words, ids, strict=True)]
        made = Transducer.build(known)
        fs, name = _open(path)
        attempt = f"{name}.{TaskContext.get().taskAttemptId()}"
        fs.create_dir(name.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(attempt) as f:
            f.write(made.to_bytes())
        fs.move(attempt, name)
        yield pd.DataFrame({"words": [len(known)], "states": [len(made.final_n)], "steps": [len(made.keys)]})

    words = materialise(frequent_words(docs, most), "lexicon-words")
    one = words.unionByName(words.limit(0)).repartition(1)
    materialise(one.mapInPandas(build, "words long, states long, steps long"), "lexicon-figures").count()
    fs, name = _open(path)
    if fs.get_file_info(name).type == pafs.FileType.NotFound:     # an empty corpus has no task
        fs.create_dir(name.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(name) as f:
            f.write(Transducer.build([]).to_bytes())
    return path


def _runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield at, to
        at = to


def _with(df: DataFrame, read: str, new: dict[str, tuple], make) -> DataFrame:
    """``df`` with the columns ``new`` (name: its Arrow and Spark type), made by ``make()(values of column read)`` a run of rows at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = make()
        for batch in batches:
            sizes = np.nan_to_num(pc.binary_length(batch.column(read)).to_numpy(zero_copy_only=False))
            for a, b in _runs(sizes, RUN_BYTES):
                part = batch.slice(a, b - a)
                made = [pa.array(x, kind) for x, (kind, _) in zip(values(part.column(read).to_pylist()), new.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *made], [*keep, *new])

    keep = common.replace_columns(df, list(new))
    rows = df.select(*[F.col(f"`{c}`") for c in keep])
    return rows.mapInArrow(run, StructType([*rows.schema.fields, *[StructField(c, kind) for c, (_, kind) in new.items()]]))


_IDS = {"ids": (pa.binary(), BinaryType()), "n_tokens": (pa.int64(), LongType())}
_TEXT = (pa.string(), StringType())


def encode(docs: DataFrame, tokenizer: str, lexicon: str | None = None, decoded: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (binary: little endian, 4 bytes each) and ``n_tokens``;
    ``lexicon`` is a file of :func:`compile_lexicon`, compiled from ``docs`` where it is not given. With ``decoded`` a
    column of that name holds what :func:`decode` makes of the ids, in the same task."""
    lexicon = lexicon or compile_lexicon(docs, tokenizer)

    def make():
        codec, fst = Codec.of(tokenizer), load(lexicon)
        decoder = Decoder.of(tokenizer)

        def values(texts: list[str | None]) -> list[list]:
            ids = codec.encode(texts, fst)
            return [ids, [len(x) // 4 for x in ids], *([[decoder.decode(x) for x in ids]] if decoded else [])]
        return values
    return _with(docs, "text", _IDS | ({decoded: _TEXT} if decoded else {}), make)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text of the ids of each row; a row without ids has no text."""
    def make():
        decoder = Decoder.of(tokenizer)
        return lambda rows: [[None if x is None else decoder.decode(x) for x in rows]]
    return _with(df, ids, {out: _TEXT}, make)
