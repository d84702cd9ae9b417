"""Packing by bounded-space online packing (operator 7).

Each partition keeps ``open_windows`` windows of ``size`` tokens.  A document
goes whole into the open window that it fills best.  When it fits none, the
fullest window takes as much of its head as it has room for and is emitted, a
new window opens, and the rest of the document goes on in the same way; so
every emitted window is full.  What is left open at the end of a partition is
merged in a tree: the leftovers of up to ``fan_in`` tasks are packed by the same
rule, level by level, until one task remains, and only its last windows are
padded.  Sequences are padded to ``size``; one of a power of two is left as it is.

Tokenisation splits a text at ASCII white space, which the tokenizer's
normaliser drops, and encodes every distinct word once per worker; the ids of
the whole text are those of its words in turn.  Where the tokenizer's rules are the
known ones (``SPLIT``), words are cut further, between ASCII letters, digits and
marks, and ASCII capitals made small, as the tokenizer itself would do: far fewer
distinct pieces are left to encode.  The pieces of a block are told apart by their
hashes and bytes, and only distinct ones are looked up.

Defined results: a null or empty text is one piece with the end id alone; very long
texts are encoded block by block; repeated rows and ties are packed like others, in
the order in which they come; null ids travel; no rows give no rows; extra columns are
ignored.  Sequence numbers are unique, not gapless; offsets in a sequence are gapless.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import ragged

CACHE_WORDS = 1_000_000
BLOCK_BYTES = 2 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
SEQUENCE_BITS = 32

# The rules of a tokenizer under which words can be cut.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTER, _DIGIT, _MARK = 1, 2, 3
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[0x21:0x7F] = _MARK
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
_CLASS[ord("A"):ord("Z") + 1] = _CLASS[ord("a"):ord("z") + 1] = _LETTER
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[ord("A"):ord("Z") + 1] += 32


def cuts_words(path: str) -> bool:
    """Whether the tokenizer lowers its text and splits it by ``SPLIT``, each part
    encoded alone: then a border between ASCII letters, digits and marks (apostrophes
    apart) is always one between parts."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    steps = (rules.get("normalizer") or {}).get("normalizers", [])
    parts = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
    kinds = [x["type"] for x in steps]
    first = parts[0] if parts else {}
    return (kinds == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"}
            and first.get("type") == "Split" and first.get("pattern") == {"Regex": SPLIT}
            and first.get("invert") is True and first.get("behavior") == "Removed"
            and [x["type"] for x in parts[1:]] == ["ByteLevel"]
            and not parts[1]["use_regex"] and not parts[1]["add_prefix_space"])


def word_pieces(buf: np.ndarray, off: np.ndarray, cut: bool
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends) of the pieces that are encoded alone: words, cut further
    and in small letters if ``cut``.  Words with an apostrophe stay whole, those that
    may hold a special string (``<``) as they are."""
    s, e = ragged.words(buf, off)
    if not cut or not len(s):
        return buf, s, e
    kind = _CLASS[buf]
    border = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)) + 1

    def words_with(*chars: str) -> np.ndarray:
        at = np.flatnonzero(np.isin(buf, [ord(c) for c in chars]))
        hit = np.zeros(len(s), dtype=bool)
        hit[np.searchsorted(s, at, side="right") - 1] = True
        return hit
    whole = words_with("'", "<")
    border = border[~whole[np.searchsorted(s, border, side="right") - 1]]
    # A border of two classes lies inside a word, so it ends one piece and starts one.
    small = _SMALL[buf]
    for w in np.flatnonzero(words_with("<")).tolist():
        small[s[w]:e[w]] = buf[s[w]:e[w]]
    return small, np.sort(np.append(s, border)), np.sort(np.append(e, border))


class _Numbered(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class WordEncoder:
    """Ids of texts, with a bounded cache of the distinct words' ids.

    New words are encoded together, a special token between them: what lies
    between two special tokens is encoded as if it were alone."""

    def __init__(self, path: str):
        # One task, one thread: Spark deals out the cores.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        plain = [(i, t.content) for i, t in sorted(self.tok.get_added_tokens_decoder().items())
                 if not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.between = plain[0] if plain else None
        self.cut = cuts_words(path)
        self.model = self.tok.model
        self.clear()

    def clear(self) -> None:
        self.cache = _Numbered()
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.start = np.zeros(1 << 14, dtype=np.int64)
        self.used = self.known = 0

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids, one after another, and how many each has."""
        if self.cut and all(w.isascii() and w.isalpha() for w in words):
            # Small ASCII letters alone: normaliser and splitter leave them as they are.
            lists = [[t.id for t in self.model.tokenize(w)] for w in words]
            return (np.fromiter(chain.from_iterable(lists), dtype=np.uint32),
                    np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)))
        if self.between is None or any("<" in w for w in words):
            lists = [e.ids for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]
            return (np.array([i for x in lists for i in x], dtype=np.uint32),
                    np.array([len(x) for x in lists], dtype=np.int64))
        mark, text = self.between
        joined = self.tok.encode_batch_fast([text.join(words)], add_special_tokens=False)[0]
        ids = np.array(joined.ids, dtype=np.uint32)
        cut = np.flatnonzero(ids == mark)
        ends = np.append(cut, len(ids))
        return np.delete(ids, cut), np.diff(np.append(-1, ends)) - 1

    def _learn(self) -> None:
        new, self.cache.new = self.cache.new, []
        words = [w.decode() for w in new]
        # Letters alone go to the model; words that may hold a special string are encoded
        # one by one, all others joined.
        kind = np.array([0 if w.isascii() and w.isalpha() else 2 if "<" in w else 1
                         for w in words])
        groups = []
        for k in range(3):
            some = np.flatnonzero(kind == k)
            groups += [some[i:i + 4096] for i in range(0, len(some), 4096)]
        while self.known + len(new) > len(self.start) // 2:
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        for g in groups:
            ids, n = self._ids_of([words[k] for k in g])
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used:self.used + len(ids)] = ids
            at = 2 * (self.known + g)
            self.start[at] = self.used + np.cumsum(n) - n
            self.start[at + 1] = n
            self.used += len(ids)
        self.known += len(new)

    def encode_block(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts, one after another, and where each text's end."""
        if len(self.cache) > CACHE_WORDS:
            self.clear()
        text, s, e = word_pieces(buf, off, self.cut)
        first, code = ragged.factorize(text, s, e)
        raw = text.tobytes()
        known = np.fromiter((self.cache[raw[a:b]] for a, b in
                             zip(s[first].tolist(), e[first].tolist())),
                            dtype=np.int64, count=len(first))
        if self.cache.new:
            self._learn()
        n = self.start[2 * known + 1][code]
        ids = ragged.gather(self.ids, self.start[2 * known][code], n)
        return ids, np.append(0, np.cumsum(n))[np.searchsorted(s, off[1:])]

    def encode(self, text: bytes) -> np.ndarray:
        """The whole text's ids, block by block: cuts are at ASCII white space."""
        out, at = [], 0
        while at < len(text):
            cut = _SPACE.search(text, at + BLOCK_BYTES) if len(text) - at > BLOCK_BYTES else None
            end = cut.start() if cut else len(text)
            buf = np.frombuffer(text, dtype=np.uint8, count=end - at, offset=at)
            out.append(self.encode_block(buf, np.array([0, end - at]))[0])
            at = end
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def encode_batch(self, buf: np.ndarray, off: np.ndarray, end_id: int):
        """The ids of each text of a batch with the end id, worked on in pieces."""
        last = np.uint32(end_id)
        for i, j in ragged.pieces(off, BLOCK_BYTES):
            own = buf[off[i]:off[j]]
            if j == i + 1:
                yield np.append(self.encode(own.tobytes()), last)
                continue
            ids, ends = self.encode_block(own, off[i:j + 1] - off[i])
            ids = np.insert(ids, ends, last)
            ends = (ends + np.arange(1, len(ends) + 1)).tolist()
            for a, b in zip([0] + ends, ends):
                yield ids[a:b]


_encoders: dict[str, WordEncoder] = {}


def encoder_for(path: str) -> WordEncoder:
    """The worker's encoder: its cache outlives a task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class OpenWindows:
    """The packing rule.  Pieces are (row, start, ids, total); emitted windows
    are lists of pieces."""

    def __init__(self, size: int, keep: int):
        self.size, self.keep = size, keep
        self.windows: list[list] = []
        self.room: list[int] = []
        self.full: list[list] = []

    def _put(self, k: int, row, start: int, ids: np.ndarray, total: int) -> None:
        self.windows[k].append((row, start, ids, total))
        self.room[k] -= len(ids)
        if not self.room[k]:
            self.full.append(self.windows.pop(k))
            self.room.pop(k)

    def add(self, row, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids):
            n = len(ids)
            fits = [r for r in self.room if r >= n]
            if fits:
                return self._put(self.room.index(min(fits)), row, start, ids, total)
            if len(self.windows) < self.keep:
                self.windows.append([])
                self.room.append(self.size)
                if n <= self.size:
                    return self._put(len(self.room) - 1, row, start, ids, total)
            # Nothing fits: the fullest window is completed and emitted.
            k = self.room.index(min(self.room))
            head = self.room[k]
            self._put(k, row, start, ids[:head], total)
            start, ids = start + head, ids[head:]

    def take_full(self) -> list[list]:
        out, self.full = self.full, []
        return out


def _piece_fields(id_type: T.DataType) -> list[T.StructField]:
    return [T.StructField("id", id_type), T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
            T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()), T.StructField("ids", T.BinaryType()),
            T.StructField("task", T.LongType())]


def _rows(windows: list[list], first_id: int, task: int | None, keep_ids: bool, schema: pa.Schema
          ) -> pa.RecordBatch:
    """The pieces of some windows as rows; ids travel only where they are
    needed later."""
    cols: list[list] = [[] for _ in range(9)]
    for w, window in enumerate(windows):
        at = 0
        for row, start, ids, total in window:
            raw = ids.astype("<u4").tobytes()
            for c, v in zip(cols, (row, start, len(ids), zlib.crc32(raw), total, first_id + w, at,
                                   raw if keep_ids or task is not None else None, task)):
                c.append(v)
            at += len(ids)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)],
                                      schema=schema)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         size: int = 2048, open_windows: int = 8, end_id: int = 1, fan_in: int = 64,
         keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and with ``keep_ids`` the ids (little-endian unsigned 32 bits)."""
    spark = docs.sparkSession
    sent = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"),
                       F.spark_partition_id().cast("long").alias("task"))
    schema = T.StructType(_piece_fields(sent.schema["id"].dataType))
    arrow = _arrow_schema(schema)

    def first_pass(batches):
        encoder = encoder_for(tokenizer_path)
        windows, task, made = OpenWindows(size, open_windows), 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            task = b.column(2)[0].as_py()
            buf, off = ragged.text_buffer(b.column(1))
            ids = b.column(0).to_pylist()
            for row, own in zip(ids, encoder.encode_batch(buf, off, end_id)):
                windows.add(row, 0, own, len(own))
                if len(windows.full) >= 64:
                    full = windows.take_full()
                    yield _rows(full, (task << SEQUENCE_BITS) + made, None, keep_ids, arrow)
                    made += len(full)
        full = windows.take_full()
        if full:
            yield _rows(full, (task << SEQUENCE_BITS) + made, None, keep_ids, arrow)
            made += len(full)
        if windows.windows:
            yield _rows(windows.windows, (task << SEQUENCE_BITS) + made, task, keep_ids, arrow)

    done = materialize(ragged.map_batches(sent, first_pass, schema), "packed")
    parts = [done.filter("task IS NULL")]
    left = done.filter("task IS NOT NULL")
    n_tasks = (left.agg(F.max("task")).first()[0] or 0) + 1
    level = 1
    # A tree over the tasks: every merge sees fan_in * open_windows windows.
    while True:
        merged = materialize(_merge(left, schema, size, open_windows, fan_in, level,
                                    last=n_tasks <= fan_in, keep_ids=keep_ids), "packed")
        parts.append(merged.filter("task IS NULL"))
        if n_tasks <= fan_in:
            break
        left, n_tasks, level = merged.filter("task IS NOT NULL"), -(-n_tasks // fan_in), level + 1
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
                      "sequence_id", "offset", *(["ids"] if keep_ids else []))


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _merge(left: DataFrame, schema: T.StructType, size: int, open_windows: int, fan_in: int,
           level: int, last: bool, keep_ids: bool) -> DataFrame:
    arrow = _arrow_schema(schema)

    def merge(key, table):
        group = key[0].as_py()
        windows = OpenWindows(size, open_windows)
        table = table.sort_by([("length", "descending"), ("sequence_id", "ascending"),
                               ("offset", "ascending")])
        get = {c: table.column(c).to_pylist() for c in ("id", "start", "ids", "doc_tokens")}
        for row, start, raw, total in zip(*[get[c] for c in ("id", "start", "ids",
                                                             "doc_tokens")]):
            windows.add(row, start, np.frombuffer(raw, dtype="<u4"), total)
        base = (level << 56) + (group << SEQUENCE_BITS)
        full = windows.take_full()
        batches = [_rows(full, base, None, keep_ids, arrow)]
        rest = windows.windows
        if last:
            # Few windows remain: fill one after another.
            tight = OpenWindows(size, 1)
            for w in rest:
                for row, start, ids, total in w:
                    tight.add(row, start, ids, total)
            rest = tight.take_full() + tight.windows
        batches.append(_rows(rest, base + len(full), None if last else group, keep_ids, arrow))
        return pa.Table.from_batches(batches, arrow)

    grouped = left.withColumn("group", F.floor(F.col("task") / fan_in)).groupBy("group")
    return ragged.map_groups(grouped, left.sparkSession, merge, schema)


def op7_window_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
