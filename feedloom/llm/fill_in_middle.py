"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of at most ``FRAME_BYTES``
bytes, with cumulative counts of bytes, code points and finished units before
each frame (:func:`store`). A unit is a line with its line feed, or what follows
the last one. :func:`transform` finds a cut by the cumulative counts, opens only
the frame that holds it, and puts the parts in their new order: whole frames are
taken over as they are, as frames of one stream may stand one after another, and
only the frames with a cut are written anew. Digests read the frames in order,
one at a time. :func:`restore` finds the markers in the frames of an output and
gives the frames of the text back; :func:`unpacked` gives the text of frames.

Cuts, form and share come from the sha256 of seed and id only, so a row's result
does not depend on other rows. The work is one narrow pass to write the store
and one to read it; no row moves, so a hot id or many equal rows cost no more
than other rows, and a lost executor costs its own tasks.

Defined cases: a null text counts as empty; an empty text, or one that holds a
marker, stays plain; a null id is seeded as the empty string; repeated rows are
separate rows with equal results; a line longer than a frame goes on in the next
one; a text has one row, however long; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.session import stage_table

from . import words as W
from .tables import prepare

#: Text bytes in a frame at most.
FRAME_BYTES = 1 << 16
#: Text bytes of the rows that a task turns into one batch.
CHUNK_BYTES = 4 << 20
MARKERS = ("<P>", "<S>", "<M>")

_FRAMES = "struct<bytes: array<long>, chars: array<long>, units: array<long>, data: array<binary>>"
_LISTS = pa.struct([("bytes", pa.list_(pa.int64())), ("chars", pa.list_(pa.int64())), ("units", pa.list_(pa.int64())), ("data", pa.list_(pa.binary()))])


def code_points(part: bytes) -> int:
    """Code points that begin in ``part`` of a UTF-8 text."""
    if part.isascii():
        return len(part)
    return int(np.count_nonzero((np.frombuffer(part, dtype=np.uint8) & 0xC0) != 0x80))


class Frames:
    """The frames of one text. ``bytes``, ``chars`` and ``units`` hold one entry
    more than there are frames: the count before each frame, and the whole
    count. ``units`` counts line feeds."""

    def __init__(self, counts: dict | None = None):
        counts = counts or {"bytes": [0], "chars": [0], "units": [0], "data": []}
        self.bytes, self.chars, self.units, self.data = counts["bytes"], counts["chars"], counts["units"], counts["data"]

    def counts(self) -> dict:
        return {"bytes": self.bytes, "chars": self.chars, "units": self.units, "data": self.data}

    def add(self, part: bytes, zip_: zstandard.ZstdCompressor) -> None:
        """One more frame for ``part``."""
        self._take(zip_.compress(part), len(part), code_points(part), part.count(b"\n"))

    def _take(self, data: bytes, size: int, chars: int, units: int) -> None:
        self.data.append(data)
        self.bytes.append(self.bytes[-1] + size)
        self.chars.append(self.chars[-1] + chars)
        self.units.append(self.units[-1] + units)

    def part(self, i: int, unzip: zstandard.ZstdDecompressor) -> bytes:
        return unzip.decompress(self.data[i], max_output_size=self.bytes[i + 1] - self.bytes[i])

    def copy(self, start: int, end: int, to: Frames, zip_, unzip) -> None:
        """Add the bytes ``start`` to ``end`` to another frame list."""
        i = max(0, bisect_left(self.bytes, start + 1) - 1)
        while i < len(self.data) and self.bytes[i] < end:
            low, high = self.bytes[i], self.bytes[i + 1]
            if start <= low and high <= end:
                to._take(self.data[i], high - low, self.chars[i + 1] - self.chars[i], self.units[i + 1] - self.units[i])
            else:
                to.add(self.part(i, unzip)[max(0, start - low):end - low], zip_)
            i += 1

    def n_units(self, unzip) -> int:
        """Lines; the last one may have no line feed."""
        return self.units[-1] + (1 if self.data and not self.part(len(self.data) - 1, unzip).endswith(b"\n") else 0)

    def seek(self, unit: int, unzip) -> tuple[int, int]:
        """(bytes, code points) before the end of the first ``unit`` units."""
        if unit == 0:
            return 0, 0
        if unit > self.units[-1]:
            return self.bytes[-1], self.chars[-1]
        i = bisect_left(self.units, unit) - 1
        part, at = self.part(i, unzip), -1
        for _ in range(unit - self.units[i]):
            at = part.index(b"\n", at + 1)
        return self.bytes[i] + at + 1, self.chars[i] + code_points(part[:at + 1])

    def digest(self, unzip) -> str:
        """sha256 of the text, read frame by frame."""
        h = hashlib.sha256()
        for i in range(len(self.data)):
            h.update(self.part(i, unzip))
        return h.hexdigest()

    def find(self, marker: bytes, start: int, unzip) -> int:
        """First byte at or after ``start`` where ``marker`` stands, also over the
        border of frames; -1 if nowhere."""
        i = max(0, bisect_left(self.bytes, start + 1) - 1)
        tail, tail_at = b"", start
        for j in range(i, len(self.data)):
            part = self.part(j, unzip)
            if self.bytes[j] < start:
                part = part[start - self.bytes[j]:]
            text = tail + part
            at = text.find(marker)
            if at >= 0:
                return tail_at + at
            keep = min(len(text), len(marker) - 1)
            tail_at += len(text) - keep
            tail = text[len(text) - keep:]
        return -1


def framed(text: bytes, zip_, size: int = FRAME_BYTES) -> Frames:
    out = Frames()
    for at in range(0, len(text), size):
        out.add(text[at:at + size], zip_)
    return out


def arranged(frames: Frames, form: str, start: int, end: int, markers, zip_, unzip) -> Frames:
    """The output: prefix up to byte ``start``, middle up to ``end``, suffix."""
    if form == "plain":
        return frames
    parts = {"P": (0, start), "M": (start, end), "S": (end, frames.bytes[-1])}
    order = (("P", "P"), ("S", "S"), ("M", "M")) if form == "psm" else (("S", "S"), ("P", "P"), ("M", "M"))
    tags, out = dict(zip("PSM", markers)), Frames()
    for tag, part in order:
        out.add(tags[tag], zip_)
        frames.copy(*parts[part], out, zip_, unzip)
    return out


def rebuilt(output: Frames, form: str, markers, zip_, unzip) -> Frames:
    """The text of an output, from the places of its markers."""
    if form == "plain":
        return output
    p, s, m = markers
    first, second = (p, s) if form == "psm" else (s, p)
    if output.find(first, 0, unzip) != 0:
        raise ValueError("the output does not begin with its first marker")
    two = output.find(second, len(first), unzip)
    three = output.find(m, two + len(second), unzip)
    head, tail, middle = (len(first), two), (two + len(second), three), (three + len(m), output.bytes[-1])
    out = Frames()
    for part in ((head, middle, tail) if form == "psm" else (tail, middle, head)):
        output.copy(*part, out, zip_, unzip)
    return out


# -- operators ----------------------------------------------------------------

def store(docs: DataFrame, markers: tuple[str, str, str] = MARKERS, frame_bytes: int = FRAME_BYTES,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, marked, frames`` for every row, written to the shared folder.
    ``marked``: the text holds a marker."""
    prepare(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    tags = [m.encode() for m in markers]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=1)
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            texts = [t or b"" for t in W.texts_of(chunk, "text")]
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), pa.array([any(t in x for t in tags) for x in texts], pa.bool_()),
                 pa.array([framed(x, zip_, frame_bytes).counts() for x in texts], _LISTS)], ["doc_id", "marked", "frames"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return stage_table(source.mapInArrow(run, f"doc_id {id_type}, marked boolean, frames {_FRAMES}"), "frames")


def _draws(seed: int) -> list[Column]:
    """The first four 8-digit groups of sha256 of ``seed:id``, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def transform(frames: DataFrame, rate: int = 100, spm_rate: int = 50, seed: int = 7, markers: tuple[str, str, str] = MARKERS,
              outputs: bool = True) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256`` and (with ``outputs``) ``output``, the frames of the output,
    for every row of a :func:`store`.

    ``rate`` per cent of the rows are cut, ``spm_rate`` per cent of these with
    the suffix first. ``restored_sha256`` is of the text rebuilt from the output.
    """
    id_type = frames.schema["doc_id"].dataType.simpleString()
    tags = [m.encode() for m in markers]
    fields = f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_, unzip = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                chunk = batch.slice(at, 256)
                rows = []
                for marked, counts, h1, h2, h3, h4 in zip(*(c.to_pylist() for c in chunk.columns[1:])):
                    text = Frames(counts)
                    n = text.n_units(unzip)
                    form = "plain" if not n or marked or h3 % 100 >= rate else "spm" if h4 % 100 < spm_rate else "psm"
                    chars = (None, None)
                    start = end = 0
                    if form != "plain":
                        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                        (start, c1), (end, c2) = text.seek(a, unzip), text.seek(b, unzip)
                        chars = (c1, c2 - c1)
                    out = arranged(text, form, start, end, tags, zip_, unzip)
                    back = rebuilt(out, form, tags, zip_, unzip)
                    rows.append((n, form, *chars, out.digest(unzip), back.digest(unzip), out.counts() if outputs else None))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), _LISTS]
                columns = [pa.array(x, t) for x, t in zip(zip(*rows), kinds)][:7 if outputs else 6]
                names = ["n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", "output"][:len(columns)]
                yield pa.RecordBatch.from_arrays([chunk.column(0), *columns], ["doc_id", *names])

    return frames.select("doc_id", "marked", "frames", *_draws(seed)).mapInArrow(run, fields + (f", output {_FRAMES}" if outputs else ""))


def restore(outputs: DataFrame, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``doc_id, frames`` of the texts behind ``form`` and ``output``."""
    id_type = outputs.schema["doc_id"].dataType.simpleString()
    tags = [m.encode() for m in markers]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_, unzip = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                chunk = batch.slice(at, 256)
                rows = zip(chunk.column(1).to_pylist(), chunk.column(2).to_pylist())
                back = [rebuilt(Frames(counts), form, tags, zip_, unzip).counts() for form, counts in rows]
                yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array(back, _LISTS)], ["doc_id", "frames"])

    return outputs.select("doc_id", "form", "output").mapInArrow(run, f"doc_id {id_type}, frames {_FRAMES}")


def unpacked(frames: DataFrame, column: str = "frames") -> DataFrame:
    """``doc_id, text``: the whole texts of a column of frames."""
    id_type = frames.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                chunk = batch.slice(at, 256)
                lists = [Frames(c) for c in chunk.column(1).to_pylist()]
                texts = [b"".join(f.part(i, unzip) for i in range(len(f.data))) for f in lists]
                yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return frames.select("doc_id", F.col(column).alias("frames")).mapInArrow(run, f"doc_id {id_type}, text string")
