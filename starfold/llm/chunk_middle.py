"""Fill-in-middle with memoised content-defined chunks (operator 13).

A text is a sequence of tokens (leading white space and a word, or a last run of
white space).  Two hashes of the id name the token counts at which prefix and
middle end; the pieces are written in prefix-suffix-middle or suffix-prefix-middle
order.

Cuts are found without tokenising every text.  A rolling hash over the last 32 bytes
cuts texts into chunks whose borders depend on the content alone, so that passages
shared by documents give equal chunks.  A worker keeps the boundary summary of the
chunks it has seen: code points, whether the first byte is white space and the last
one is not, and the places where a word ends inside.  A summary is used again only
for equal bytes; the hash proposes, the content decides.  Summaries add up: a word
also ends at the border of two chunks if the left one ends in a word and the right
one starts with white space.  The number of word ends before each chunk names the
chunk that holds a cut, and its stored places the byte.  A non-empty text has one
token more than it has inner word ends.

The memo of a worker holds at most ``MEMO_BYTES`` of content and starts anew beyond;
it changes the work, never the result.

Defined results: null counts as empty text, empty texts and texts that hold a
marker stay plain; a null id hashes as the empty string; equal rows give equal
outputs; an empty table gives no rows; texts of any length are cut in the same way,
hashed and summed up in blocks of 1 MB; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ragged

MARKS = ("<P>", "<S>", "<M>")                 # fixed values: prefix, suffix, middle
WINDOW, LEAST, MOST = 32, 64, 8192            # bytes: rolling hash, chunk lengths
MASK = np.uint64((1 << 9) - 1)                # chunks of about 512 bytes
MEMO_BYTES = 32 << 20

_GEAR = np.random.default_rng(20250613).integers(1, 1 << 63, 256, dtype=np.uint64)


def rolling(buf: np.ndarray) -> np.ndarray:
    """A hash of the last ``WINDOW`` bytes at every place, by doubling: the sum
    over 2k bytes is that over k bytes plus the shifted one k places before."""
    h = _GEAR[buf]
    span = 1
    while span < WINDOW:
        h[span:] += h[:-span].copy() << np.uint64(span)
        span *= 2
    return ragged.mix(h)


def cut_chunks(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the chunks of all texts, first chunk of each text + total).  A
    chunk ends where the hash has its low bits zero and had them nowhere in the
    ``LEAST`` bytes before; one longer than ``MOST`` is cut every ``MOST`` bytes."""
    n = len(buf)
    texts = np.unique(offsets[:-1][np.diff(offsets) > 0])
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    # Block by block, each with the window before it: a long text costs no more.
    hit = []
    for lo in range(0, n, ragged.PIECE_BYTES):
        back = min(lo, WINDOW - 1)
        h = rolling(buf[lo - back:lo + ragged.PIECE_BYTES])[back:]
        hit.append(np.flatnonzero((h & MASK) == 0) + lo)
    hit = np.concatenate(hit)
    # The window lies inside the text, and the hit before is not near.
    owner = texts[np.searchsorted(texts, hit, side="right") - 1]
    hit = hit[hit - owner >= WINDOW - 1]
    if len(hit):
        hit = hit[np.append(True, np.diff(hit) >= LEAST)]
    starts = np.union1d(texts, hit + 1)
    starts = starts[starts < n]
    length = np.diff(np.append(starts, n))
    more = (length - 1) // MOST
    if more.any():
        again = np.repeat(starts, more)
        step = np.arange(len(again)) - np.repeat(np.cumsum(more) - more, more) + 1
        starts = np.union1d(starts, again + step * MOST)
    return starts, np.searchsorted(starts, offsets)


class Memo:
    """Boundary summaries of chunks by their content."""

    def __init__(self, limit: int = MEMO_BYTES):
        self.limit, self.held = limit, 0
        self.places: dict[bytes, np.ndarray] = {}
        self.hits = 0

    def summaries(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Word ends inside and code points per chunk, and the places of the ends
        per distinct chunk with the number of it per chunk; block by block."""
        inner, chars, places, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], []
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + ragged.PIECE_BYTES,
                                               side="right")))
            lo = starts[i]
            a, b, held, code = self._block(buf[lo:ends[j - 1]], starts[i:j] - lo, ends[i:j] - lo)
            inner.append(a), chars.append(b)
            codes.append(code + len(places))
            places += held
            i = j
        return (np.concatenate(inner), np.concatenate(chars), places,
                np.concatenate(codes) if codes else np.zeros(0, np.int64))

    def _block(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        first, code = ragged.factorize(buf, starts, ends)
        raw = buf.tobytes()
        spelled = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
        found = [self.places.get(b) for b in spelled]
        new = [i for i, f in enumerate(found) if f is None]
        self.hits += len(code) - len(new)
        if new:
            rows = first[new]
            length = ends[rows] - starts[rows]
            some = ragged.gather(buf, starts[rows], length)
            at = np.append(0, np.cumsum(length))
            solid = ~ragged._WS[some]
            close = np.zeros(len(some), dtype=bool)
            close[1:] = ~solid[1:] & solid[:-1]
            close[at[:-1]] = False
            places = np.flatnonzero(close)
            split = np.searchsorted(places, at)
            lead = np.add.reduceat(((some & 0xC0) != 0x80).astype(np.int64), at[:-1])
            for k, i in enumerate(new):
                held = places[split[k]:split[k + 1]] - at[k]
                found[i] = (held, int(lead[k]))
                if self.held + len(spelled[i]) > self.limit:
                    self.places, self.held = {}, 0
                self.places[spelled[i]] = found[i]
                self.held += len(spelled[i])
        inner = np.array([len(f[0]) for f in found], dtype=np.int64)[code]
        chars = np.array([f[1] for f in found], dtype=np.int64)[code]
        return inner, chars, [f[0] for f in found], code


def count_and_cut(buf: np.ndarray, offsets: np.ndarray, low: np.ndarray, high: np.ndarray,
                  memo: Memo) -> dict[str, np.ndarray]:
    """Tokens per text, and byte and code point places of the cuts after the
    smaller and the larger of ``low % (n + 1)`` and ``high % (n + 1)`` tokens."""
    docs = len(offsets) - 1
    starts, first = cut_chunks(buf, offsets)
    ends = np.append(starts[1:], len(buf))
    inner, chars, places, code = memo.summaries(buf, starts, ends)
    joint = np.zeros(len(starts), dtype=bool)
    if len(starts) > 1:
        joint[1:] = ragged._WS[buf[starts[1:]]] & ~ragged._WS[buf[starts[1:] - 1]]
        joint[first[:-1][first[:-1] < len(starts)]] = False
    closed = np.append(0, np.cumsum(inner + joint))      # word ends before each chunk
    lead = np.append(0, np.cumsum(chars))                # code points, likewise
    filled = np.diff(offsets) > 0
    n = np.where(filled, closed[first[1:]] - closed[first[:-1]] + 1, 0)
    a, b = low % (n + 1), high % (n + 1)
    out = {"n": n}
    for name, k in (("first", np.minimum(a, b)), ("second", np.maximum(a, b))):
        byte, char = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
        whole = k >= n
        byte[whole] = np.diff(offsets)[whole]
        char[whole] = (lead[first[1:]] - lead[first[:-1]])[whole]
        for d in np.flatnonzero(~whole & (k > 0)).tolist():
            want = closed[first[d]] + k[d]
            c = int(np.searchsorted(closed, want)) - 1   # the chunk that holds this word end
            rank = int(want - closed[c]) - int(joint[c])
            inside = int(places[code[c]][rank - 1]) if rank else 0
            part = buf[starts[c]:starts[c] + inside]
            byte[d] = starts[c] + inside - offsets[d]
            char[d] = lead[c] - lead[first[d]] + np.count_nonzero((part & 0xC0) != 0x80)
        out[name], out[name + "_chars"] = byte, char
    return out


_FIELDS = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
           T.StructField("output", T.StringType())]


def _utf8(values: list) -> pa.Array:
    """Texts from bytes as they are (a text with broken UTF-8 is kept)."""
    held = pa.array(values, pa.binary())
    return pa.Array.from_buffers(pa.string(), len(held), held.buffers())


def _arranged(texts: bytes, offsets, got, forms) -> tuple[list, list, list]:
    p, s, m = (x.encode() for x in MARKS)
    out, prefix, middle = [], [], []
    for d, form in enumerate(forms):
        text = texts[offsets[d]:offsets[d + 1]]
        if form == "plain":
            out.append(text), prefix.append(None), middle.append(None)
            continue
        i, j = int(got["first"][d]), int(got["second"][d])
        out.append(p + text[:i] + s + text[j:] + m + text[i:j] if form == "psm"
                   else s + text[j:] + p + text[:i] + m + text[i:j])
        prefix.append(int(got["first_chars"][d]))
        middle.append(int(got["second_chars"][d] - got["first_chars"][d]))
    return out, prefix, middle


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: its id, ``n`` tokens, ``form`` (plain, psm,
    spm), ``prefix_chars`` and ``middle_chars`` (null if plain), and ``output``."""
    hexes = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"),
                                                          F.lit(""))), 256)
    h = [F.conv(F.substring(hexes, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = F.contains(text, F.lit(MARKS[0])) | F.contains(text, F.lit(MARKS[1])) \
        | F.contains(text, F.lit(MARKS[2]))
    form = (F.when((text == "") | marked | (h[2] % 100 >= percent), "plain")
            .when(h[3] % 100 < spm_percent, "spm").otherwise("psm"))
    sent = docs.select(F.col(id_col).alias("_id"), h[0].alias("_a"), h[1].alias("_b"),
                       form.alias("_form"), text.alias("_body"))
    schema = T.StructType([T.StructField("_id", docs.schema[id_col].dataType)] + _FIELDS)

    def run(batches):
        memo = Memo()
        for b in batches:
            if not b.num_rows:
                continue
            buf, off = ragged.text_buffer(b.column("_body"))
            a = b.column("_a").to_numpy(zero_copy_only=False)
            z = b.column("_b").to_numpy(zero_copy_only=False)
            forms = b.column("_form").to_pylist()
            for i, j in ragged.pieces(off):
                own, at = buf[off[i]:off[j]], off[i:j + 1] - off[i]
                got = count_and_cut(own, at, a[i:j], z[i:j], memo)
                out, prefix, middle = _arranged(own.tobytes(), at, got, forms[i:j])
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id").slice(i, j - i), pa.array(got["n"]),
                     pa.array(forms[i:j], pa.string()), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), _utf8(out)],
                    ["_id"] + [f.name for f in _FIELDS])
    out = ragged.map_batches(sent, run, schema)
    taken = [f.name for f in _FIELDS]
    if id_col in taken:
        raise ValueError(f"the id column may not be named {id_col!r}: the result has {taken}")
    return out.withColumnRenamed("_id", id_col)


def restored(output, form):
    """The text again, from an output and its form (Column expressions)."""
    p, s, m = MARKS
    part = lambda x, mark, i: F.split_part(x, F.lit(mark), F.lit(i))
    psm_rest, spm_rest = part(output, s, 2), part(output, p, 2)
    psm = F.concat(F.substring(part(output, s, 1), len(p) + 1, (1 << 31) - 1),
                   part(psm_rest, m, 2), part(psm_rest, m, 1))
    spm = F.concat(part(spm_rest, m, 1), part(spm_rest, m, 2),
                   F.substring(part(output, p, 1), len(s) + 1, (1 << 31) - 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op13_chunk_middle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = fill_in_middle(docs)
    return got.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256)
                      .alias("restored_sha256"))


OP13_SQL = r"""WITH hashed AS (SELECT doc_id, coalesce(text, '') AS text,
    sha256('42:' || CAST(doc_id AS VARCHAR)) AS h,
    regexp_extract_all(coalesce(text, ''),
      '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t FROM documents),
numbered AS (SELECT *, CAST(len(t) AS BIGINT) AS n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM hashed),
placed AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1))
    AS j, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
      OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM numbered),
cut AS (SELECT *, array_to_string(t[1:i], '') AS a, array_to_string(t[i + 1:j], '') AS b,
    array_to_string(t[j + 1:n], '') AS c FROM placed)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(b) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
    ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
  sha256(a || b || c) AS restored_sha256
FROM cut"""
