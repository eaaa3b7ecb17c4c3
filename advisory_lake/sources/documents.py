"""Files cut into documents before any of them is parsed, so that a bad one costs nothing else.

A file may hold one document, compact or pretty-printed, an array of documents, or documents one
after another, with or without line breaks or commas between them. A byte-order mark is dropped
and UTF-16 is read as such. What is no document is a rejected piece of its own, with the place in
the file where it begins; cutting goes on at the next line that begins no further in than the bad
piece, or after the next ``}`` that ``{`` follows at once.

A ``}``, a line break and a ``{`` with nothing but blanks between them can stand neither inside
a document nor inside a string. Such a place is a boundary whatever comes before it, so that
large files are cut by several tasks, each from the first boundary of its range of bytes on.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, StructType

from advisory_lake.session import few_tasks, ship_package
from advisory_lake.sources.stores import READ_BYTES, arrow_uri, walk

RANGE_BYTES = 128 << 20  # bytes of a file that one task cuts
CHUNK_BYTES = 8 << 20  # read at a time
FILES_PER_TASK = 5000
LOOK_BACK = 256  # more than a boundary is long

PIECES = ArrayType(StructType().add("place", "long").add("text", "string").add("whole", "boolean"))
DOCUMENTS = "relative_path STRING, place LONG, text STRING, fault STRING"
#: Faults: a piece that is no document; rows of files themselves, which have no place.
INCOMPLETE, UNREADABLE, OPENED = "no document", "unreadable", "opened"

_BOUNDARY = re.compile(r"\}[ \t\r]{0,99}\n[ \t\r\n]{0,99}(?=\{)")
_BOUNDARY_BYTES = re.compile(_BOUNDARY.pattern.encode())
_BOUNDARY_AFTER = re.compile(r"[ \t\r]{0,99}\n[ \t\r\n]{0,99}(?=\{)")  # what follows the } of one
_BETWEEN = re.compile(r"[\s,\ufeff]*")
_JUNK = re.compile(r"[^{\[\n][^{\n]*|\[")
_JUNK_IN_ARRAY = re.compile(r'"(?:[^"\\\n]|\\.)*"|[^{\[\n,\]"]+|.')
_CLOSED_BEFORE = re.compile(r"\}[ \t]*(?=\{)")
_NEXT_ELEMENT = re.compile(r"\}\s*,\s*(?=\{)")
_decode = json.JSONDecoder().raw_decode

Piece = tuple[int, str, bool]  # place in bytes, text, whether it is a document


class Cutter:
    """Cuts a stream of text into pieces. What has been given and not cut yet is held."""

    def __init__(self, place: int = 0):
        self.held, self.place, self.arrays, self.closed = "", place, 0, False
        self.patience = CHUNK_BYTES

    def feed(self, text: str, last: bool = False) -> Iterator[Piece]:
        self.held += text
        if self.closed and _BOUNDARY_AFTER.match(self.held):
            self.arrays = 0
        at = 0
        for boundary in _BOUNDARY.finditer(self.held):
            yield from self._cut(self.held[at : boundary.end()], True)
            at, self.arrays, self.closed = boundary.end(), 0, False
        self.held = self.held[at:]
        if last or len(self.held) > self.patience:
            rest = self.held
            cut = yield from self._cut(rest, last)
            self.held, self.closed = rest[cut:], rest[:cut].endswith("}") or (self.closed and not cut)
            self.patience = max(CHUNK_BYTES, 2 * len(self.held))  # a long document is tried ever less often

    def _cut(self, text: str, last: bool) -> Iterator[Piece]:
        """The pieces of a stretch; gives how far it got, which is the end when it is the last."""
        at = done = counted = 0

        def place_of(position: int) -> int:
            nonlocal counted
            self.place += len(text[counted:position].encode(errors="replace"))
            counted = position
            return self.place

        while True:
            at = _BETWEEN.match(text, done).end()
            if at == len(text):
                break
            sign = text[at]
            if sign == "]" and self.arrays:
                self.arrays -= 1
                done = at + 1
            elif sign == "[" and not self.arrays:
                self.arrays += 1
                done = at + 1
            elif sign == "{":
                try:
                    end, whole = _decode(text, at)[1], True
                except (json.JSONDecodeError, RecursionError) as error:
                    wrong = getattr(error, "pos", at)
                    unfinished = wrong + LOOK_BACK >= len(text) or "Unterminated" in str(error)
                    if unfinished and not last:
                        break  # what follows may complete it
                    end, whole = self._resume(text, at), False
                if not whole and end == len(text) and not last:
                    break
                yield place_of(at), text[at:end].rstrip(), whole
                done = end
            else:
                end = (_JUNK_IN_ARRAY if self.arrays else _JUNK).match(text, at).end()
                open_text = self.arrays and sign == '"' and end == at + 1 and "\n" not in text[at:]
                if (end == len(text) or open_text) and not last:
                    break
                yield place_of(at), text[at:end].rstrip(), False
                done = end
        if last:
            done = len(text)
        place_of(done)
        return done

    def _resume(self, text: str, at: int) -> int:
        """Where a document can begin after one at ``at`` that is none."""
        before = text[text.rfind("\n", 0, at) + 1 : at]
        inset = len(before) if not before.strip() else 0
        found = [re.compile(r"\n[ \t]{0,%d}(?=\{)" % inset).search(text, at), _CLOSED_BEFORE.search(text, at)]
        if self.arrays:
            found.append(_NEXT_ELEMENT.search(text, at))
        return min((match.end() for match in found if match), default=len(text))


def pieces_of(text: str) -> list[Piece]:
    """The pieces of a whole text; none when it holds nothing but blanks."""
    return list(Cutter().feed(text, last=True))


@arrow_udf(PIECES)
def _pieces(texts: pa.Array) -> pa.Array:
    offsets, pieces = [], []
    for text in texts.to_pylist():
        offsets.append(None if text is None else len(pieces))
        if text is not None:
            pieces.extend(pieces_of(text))
    places, cut, whole = zip(*pieces) if pieces else ((), (), ())
    columns = [pa.array(places, pa.int64()), pa.array(cut, pa.string()), pa.array(whole, pa.bool_())]
    rows = pa.StructArray.from_arrays(columns, names=["place", "text", "whole"])
    return pa.ListArray.from_arrays(pa.array([*offsets, len(pieces)], pa.int32()), rows)


def cut_texts(files: DataFrame, text: Column, header: str) -> DataFrame:
    """The files with text, headers and pieces of each, decoded. A text that parses as one record
    is a document as it stands and never leaves the JVM; ``headers`` holds what ``header``, a part
    of the record's schema, finds there. Only the others have ``pieces``."""
    ship_package(files.sparkSession)
    as_array = F.from_json(F.concat(F.lit("["), F.col("text"), F.lit("]")), f"ARRAY<STRUCT<{header}>>")
    parsed = files.withColumn("text", text).withColumn("headers", as_array)
    single = F.coalesce(F.size("headers") == 1, F.lit(False)) & F.ltrim(F.col("text")).startswith("{")
    return parsed.withColumn("pieces", _pieces(F.when(~single, F.coalesce("text", F.lit("")))))


def documents_of(cut: DataFrame, header: str) -> DataFrame:
    """relative_path, place, text, fault and header for every piece of cut texts, and one row with
    nulls for a file without any."""
    whole = F.array(F.struct(F.lit(0).cast("long").alias("place"), F.col("text"), F.lit(True).alias("whole")))
    rows = cut.select(
        "relative_path",
        F.when(F.col("pieces").isNull(), F.get("headers", 0)).alias("header"),
        F.explode_outer(F.coalesce("pieces", whole)).alias("piece"),
    )
    fault = F.when(~F.col("piece.whole"), F.lit(INCOMPLETE))
    known = F.coalesce("header", F.when(F.col("piece.whole"), F.from_json("piece.text", f"STRUCT<{header}>")))
    return rows.select("relative_path", "piece.place", "piece.text", fault.alias("fault"), known.alias("header"))


def cut_tree(
    spark: SparkSession, root: str, listing: DataFrame | None = None, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """relative_path, place, text and fault for every piece of the files below ``root``, or of
    those in ``listing`` (relative_path, length).

    Files are read in chunks and never held whole; those of more than ``range_bytes`` are cut by
    several tasks. A file that has been opened gives one row with the fault ``OPENED``, one that
    has vanished or may not be read a row with ``UNREADABLE``; any other error fails the task,
    which Spark tries again. A file without pieces gives a row of nulls.
    """
    ship_package(spark)
    listed = (walk(spark, root) if listing is None else listing).select("relative_path", "length")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    ranges = listed.select("relative_path", F.explode(starts).alias("start"))
    tasks = max(few_tasks(spark), -(-listed.count() // FILES_PER_TASK))
    return ranges.repartition(tasks, "relative_path", "start").mapInArrow(_cutter_of(arrow_uri(root), range_bytes), DOCUMENTS)


def _cutter_of(uri: str, range_bytes: int):
    def cut(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(uri)
        rows, held = [], 0
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    with store.open_input_file(f"{base}/{name}") as file:
                        if start == 0:
                            rows.append((name, None, None, OPENED))
                        found = False
                        for place, text, whole in _pieces_in(file, start, start + range_bytes):
                            found = True
                            rows.append((name, place, text, None if whole else INCOMPLETE))
                            held += len(text)
                            if held >= READ_BYTES or len(rows) >= 10_000:
                                yield _as_batch(rows)
                                rows, held = [], 0
                        if start == 0 and not found:
                            rows.append((name, None, None, None))
                except (FileNotFoundError, PermissionError):
                    if start == 0:
                        rows.append((name, None, None, UNREADABLE))
        if rows:
            yield _as_batch(rows)

    return cut


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    names, places, texts, faults = zip(*rows)
    # halves of surrogate pairs, which JSON may escape but no text may hold, become question marks
    texts = [None if t is None else t.encode(errors="replace") for t in texts]
    arrays = [pa.array(names, pa.string()), pa.array(places, pa.int64()), pa.array(texts, pa.string()), pa.array(faults, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=["relative_path", "place", "text", "fault"])


def _pieces_in(file, start: int, stop: int) -> Iterator[Piece]:
    """The pieces that begin in a range of an open file's bytes."""
    head = file.read(3)
    wide = {b"\xff\xfe": "utf-16-le", b"\xfe\xff": "utf-16-be"}.get(head[:2])
    if wide:
        if start == 0:  # offsets in bytes mean nothing to the boundaries of such a file
            yield from _cut_all(file, 2, codecs.getincrementaldecoder(wide)(errors="replace"))
        return
    mark = 3 if head == codecs.BOM_UTF8 else 0
    size = file.size()
    first = mark if start == 0 else _boundary_from(file, start, min(stop, size))
    if first is None:
        return
    end = _boundary_from(file, stop, size) if stop < size else None
    yield from _cut_all(file, first, codecs.getincrementaldecoder("utf-8")(errors="replace"), end)


def _boundary_from(file, start: int, stop: int) -> int | None:
    """The first place in the range where a boundary puts the beginning of a document."""
    at = max(0, start - LOOK_BACK)
    held, offset = b"", at
    while offset - LOOK_BACK < stop:
        file.seek(at)
        chunk = file.read(CHUNK_BYTES)
        held = held[-LOOK_BACK:] + chunk
        offset = at + len(chunk)
        for boundary in _BOUNDARY_BYTES.finditer(held):
            place = offset - len(held) + boundary.end()
            if start <= place < stop:
                return place
        if len(chunk) < CHUNK_BYTES:
            return None
        at = offset
    return None


def _cut_all(file, first: int, decoder, end: int | None = None) -> Iterator[Piece]:
    cutter, at = Cutter(first), first
    file.seek(first)
    while True:
        chunk = file.read(CHUNK_BYTES if end is None else min(CHUNK_BYTES, end - at))
        at += len(chunk)
        last = not chunk or at == end
        yield from cutter.feed(decoder.decode(chunk, last), last)
        if last:
            return
