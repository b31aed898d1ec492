"""Fill-in-the-middle documents from texts that are stored as seekable compressed frames."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import Scratch

#: Sentinels of the parts of an output: prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SENTINEL = re.compile("|".join((PREFIX, SUFFIX, MIDDLE)))
#: Order of the parts in each form's output, and in the text.
_ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
_TEXT_ORDER = (PREFIX, MIDDLE, SUFFIX)
#: Code points of one frame: what is decompressed for one cut, and all that a digest holds at a time.
FRAME_CHARS = 1 << 16

FRAME = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())])
_FRAME_SQL = "struct<units:bigint,chars:bigint,data:binary>"


class Frames:
    """A text as independent zstandard frames; ``units[i]`` and ``chars[i]`` count what ends in the first i frames."""

    def __init__(self, frames: Sequence[tuple[int, int, bytes]]):
        self.data = [f[2] for f in frames]
        self.units = [0, *accumulate(f[0] for f in frames)]
        self.chars = [0, *accumulate(f[1] for f in frames)]

    @staticmethod
    def encode(text: str, size: int) -> list[tuple[int, int, bytes]]:
        """(line ends, code points, compressed UTF-8) of each stretch of ``size`` code points."""
        parts = (text[i : i + size] for i in range(0, len(text), size))
        return [(p.count("\n"), len(p), _compressed(p)) for p in parts]

    def text(self, i: int) -> str:
        return zstandard.ZstdDecompressor().decompress(self.data[i]).decode()

    def end_of_unit(self, k: int) -> int:
        """Code points up to the end of the k-th line: only the frame that its line end lies in is decompressed."""
        if k == 0:
            return 0
        if k > self.units[-1]:  # the last line, which has no line end
            return self.chars[-1]
        i = bisect.bisect_left(self.units, k) - 1
        text, at = self.text(i), -1
        for _ in range(k - self.units[i]):
            at = text.index("\n", at + 1)
        return self.chars[i] + at + 1

    def pieces(self, start: int, end: int) -> Iterator[tuple[int | None, str]]:
        """The text from ``start`` to ``end`` in order, a frame at a time; with the frame's number where all of it is meant."""
        for i in range(max(bisect.bisect_right(self.chars, start) - 1, 0), len(self.data)):
            lo, hi = self.chars[i], self.chars[i + 1]
            if lo >= end:
                return
            if hi > start:
                whole = start <= lo and hi <= end
                yield (i if whole else None), self.text(i)[max(start - lo, 0) : end - lo]

    def digest(self, ranges: Sequence[tuple[int, int]]) -> str:
        """SHA-256 of the UTF-8 of some ranges of the text, one after the other."""
        h = hashlib.sha256()
        for start, end in ranges:
            for _, piece in self.pieces(start, end):
                h.update(piece.encode())
        return h.hexdigest()


def _compressed(text: str) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(text.encode())


def rearranged(frames: Frames, form: str, cuts: tuple[int, int]) -> list[tuple[int, int, bytes]]:
    """The frames of the output.  Those that lie within one part are taken over as they are; only cut ones are compressed anew."""
    ranges = dict(zip(_TEXT_ORDER, ((0, cuts[0]), cuts, (cuts[1], frames.chars[-1])), strict=True))
    out = []
    for part in _ORDER[form]:
        out.append((0, len(part), _compressed(part)))
        for whole, piece in frames.pieces(*ranges[part]):
            data = frames.data[whole] if whole is not None else _compressed(piece)
            out.append((piece.count("\n"), len(piece), data))
    return out


def parts_of_output(output: Frames) -> dict[str, tuple[int, int]]:
    """Where each part stands in an output that is not plain, found by its sentinels alone."""
    found, tail, last = [], "", len(PREFIX) - 1
    for i in range(len(output.data)):
        text = tail + output.text(i)
        found += [(m.start() + output.chars[i] - len(tail), m.group()) for m in _SENTINEL.finditer(text)]
        # A sentinel may lie across frames; none of its first characters are another's.
        tail = text[-last:]
    ends = [at for at, _ in found[1:]] + [output.chars[-1]]
    return {name: (at + len(name), end) for (at, name), end in zip(found, ends, strict=True)}


def restored_ranges(output: Frames, form: str) -> list[tuple[int, int]]:
    """The ranges of the output that give the text when read in turn."""
    if form == "plain":
        return [(0, output.chars[-1])]
    parts = parts_of_output(output)
    return [parts[p] for p in _TEXT_ORDER]


def store_frames(docs: DataFrame, *, frame_chars: int = FRAME_CHARS, scratch: Scratch | None = None) -> DataFrame:
    """The texts of ``docs`` (doc_id, text) as a written table: doc_id, ``frames`` (array of line ends, code points and data of each frame),
    ``n`` lines and ``marked`` (a sentinel is in the text).  One row per document, so that a document's frames stay together and in order
    without a shuffle.  Draws of later epochs start from this table and decompress only what they cut.

    A null text is empty; an empty one has no frame.
    """
    scratch = scratch or Scratch(docs.sparkSession, "fim")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("frames", pa.list_(FRAME)), ("n", pa.int64()), ("marked", pa.bool_())])
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = []
                for i, text in zip(part.column(0), part.column(1), strict=True):
                    t = (text.as_py() or b"").decode("utf-8", "replace")
                    frames = Frames.encode(t, frame_chars)
                    rows.append((i.as_py(), frames, t.count("\n") + bool(t and t[-1] != "\n"), bool(_SENTINEL.search(t))))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([[dict(zip(("units", "chars", "data"), f, strict=True)) for f in r[1]] for r in rows], pa.list_(FRAME)),
                        pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.bool_()),
                    ],
                    schema=schema,
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return scratch.save(texts.mapInArrow(store, f"doc_id long, frames array<{_FRAME_SQL}>, n long, marked boolean"))


def _draw(group: int) -> Column:
    """The eight hex digits of a group of the hash, as an unsigned integer."""
    return F.conv(F.substring("_hash", 8 * group + 1, 8), 16, 10).cast("long")


def with_cuts(stored: DataFrame, *, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """Add ``form``, ``cut1`` and ``cut2`` (in lines), all drawn from SHA-256 of ``seed:doc_id``; a null id draws as an empty one.

    ``rate`` percent of the documents are transformed, ``spm`` percent of those put the suffix first.
    """
    hashed = stored.withColumn("_hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256))
    plain = (F.col("n") == 0) | F.col("marked") | (_draw(2) % 100 >= rate)
    a, b = _draw(0) % (F.col("n") + 1), _draw(1) % (F.col("n") + 1)
    form = F.when(plain, "plain").when(_draw(3) % 100 < spm, "spm").otherwise("psm")
    return hashed.withColumns({"form": form, "cut1": F.least(a, b), "cut2": F.greatest(a, b)}).drop("_hash")


_RESULT = [
    ("doc_id", pa.int64(), "long"), ("n", pa.int64(), "long"), ("form", pa.string(), "string"), ("prefix_chars", pa.int64(), "long"),
    ("middle_chars", pa.int64(), "long"), ("output_sha256", pa.string(), "string"), ("restored_sha256", pa.string(), "string"),
    ("output", pa.binary(), "binary"),
]


def fill_in_middle(
    docs: DataFrame, *, seed: int = 7, rate: int = 100, spm: int = 50, with_output: bool = True, frame_chars: int = FRAME_CHARS,
) -> DataFrame:
    """Documents as prefix-suffix-middle or suffix-prefix-middle, cut at line ends.

    Returns doc_id, n (lines), form (plain, psm or spm), prefix_chars and middle_chars (code points; null if plain), output_sha256,
    restored_sha256 (of the text rebuilt from the output and its form) and, ``with_output``, the output as one zstandard stream of its frames.

    Texts go to a table of frames first (:func:`store_frames`).  A cut is found by the frames' cumulative line counts and decompresses the one
    frame it lies in; the output is the frames in their new order, and both digests are streamed over them, one frame at a time.  No row is
    shuffled.  The result is lazy: the table of frames stays in the shared work folder.

    Null and empty texts, and texts that hold a sentinel, stay plain.  Repeated rows give a row each; a null id is drawn as an empty one.
    A very long text is many frames, whether or not it has line ends.  Bytes that are not UTF-8 become U+FFFD.  Columns beside doc_id and
    text are not read; an empty table gives an empty result.
    """
    drawn = with_cuts(store_frames(docs, frame_chars=frame_chars), seed=seed, rate=rate, spm=spm)
    fields = _RESULT if with_output else _RESULT[:-1]

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                rows = batch.slice(start, 64).to_pylist()
                out = [_transformed(r) for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array([r[f] for r in out], t) for f, t, _ in fields], names=[f for f, _, _ in fields])

    return drawn.select("doc_id", "frames", "n", "form", "cut1", "cut2").mapInArrow(transform, ", ".join(f"{f} {t}" for f, _, t in fields))


def _transformed(row: dict) -> dict:
    text, form = Frames([(f["units"], f["chars"], f["data"]) for f in row["frames"]]), row["form"]
    out = {"doc_id": row["doc_id"], "n": row["n"], "form": form, "prefix_chars": None, "middle_chars": None}
    output = text
    if form != "plain":
        cuts = text.end_of_unit(row["cut1"]), text.end_of_unit(row["cut2"])
        out |= {"prefix_chars": cuts[0], "middle_chars": cuts[1] - cuts[0]}
        output = Frames(rearranged(text, form, cuts))
    return out | {
        "output_sha256": output.digest([(0, output.chars[-1])]), "restored_sha256": output.digest(restored_ranges(output, form)),
        "output": b"".join(output.data),
    }
