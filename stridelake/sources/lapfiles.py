"""XML lap files, read from a stream in bounded memory.

A file is inflated and parsed piece by piece. Its samples are held until the file has proved whole,
since a file that breaks off gives none; one with more than ``HELD`` samples is read a second time
instead, and its samples leave in batches. So memory does not depend on the length of a file.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO
from xml.parsers import expat

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from stridelake import schemas
from stridelake.sources.listing import uri_of

NO_ACTIVITY = "no activity element found"
NO_LAP = "no lap element found"
MALFORMED = "malformed XML"

HELD = 20_000  # samples held of one file, and rows of a batch
PIECE = 1 << 18  # bytes read at a time
LONGEST_VALUE = 1 << 16  # characters of an element's text
DEEPEST = 256  # nested elements
LONGEST_FILE = 1 << 36  # inflated bytes; more is taken for a broken or hostile file
DEALT = 2_000  # files of a task

_BLANK = b" \t\r\n\x0b\x0c\xef\xbb\xbf"  # white space and a byte order mark before the declaration

# Where the used fields stand below an activity, a lap and a sample.
_ACTIVITY = {("Id",): "id", ("Creator", "Name"): "creator"}
_LAP = {
    ("TotalTimeSeconds",): "total_time", ("Calories",): "calories",
    ("AverageHeartRateBpm", "Value"): "average_hr", ("MaximumHeartRateBpm", "Value"): "max_hr",
    ("Extensions", "TPX", "TotalPower"): "total_power",
}
_POINT = {
    ("Time",): "time", ("DistanceMeters",): "distance", ("Cadence",): "cadence",
    ("HeartRateBpm", "Value"): "hr", ("Extensions", "TPX", "Speed"): "speed",
    ("Extensions", "TPX", "Watts"): "watts",
}
_TEXT = {"id", "creator", "time"}
_SAMPLE = tuple(_POINT.values())


class Broken(Exception):
    """A payload that gives no activity; the reason is its text."""


class LapFile:
    """The first lap of the first activity of one file; ``points`` may be taken out meanwhile."""

    def __init__(self) -> None:
        self.parser = expat.ParserCreate()
        self.parser.buffer_text = True
        self.parser.StartElementHandler = self._open
        self.parser.EndElementHandler = self._close
        self.parser.CharacterDataHandler = self._text
        self.stack: list[str] = []
        self.activities = self.laps = 0
        self.found: dict[str, str | float | None] = {}
        self.points: list[tuple] = []
        self.sample: dict[str, str | float | None] | None = None
        self.field: str | None = None
        self.value: list[str] = []
        self.chars = 0
        self.begun = False

    def feed(self, data: bytes) -> None:
        if not self.begun:
            data = data.lstrip(_BLANK)
            self.begun = bool(data)
        if data:
            self.parser.Parse(data, False)

    def end(self) -> None:
        self.parser.Parse(b"", True)
        if not self.activities:
            raise Broken(NO_ACTIVITY)
        if not self.laps:
            raise Broken(NO_LAP)

    def _open(self, name: str, attributes: dict[str, str]) -> None:
        name = name.rpartition(":")[2]
        stack = self.stack
        stack.append(name)
        depth = len(stack)
        if depth > DEEPEST:
            raise Broken(MALFORMED)
        if depth < 3 or stack[1] != "Activities" or stack[2] != "Activity":
            return
        if depth == 3:
            self.activities += 1
            if self.activities == 1:
                self.found["sport"] = attributes.get("Sport")
        if self.activities != 1:
            return
        self.field = None
        if depth == 4 and name == "Lap":
            self.laps += 1
            if self.laps == 1:
                self.found["lap_start"] = attributes.get("StartTime")
        elif depth > 3 and stack[3] != "Lap":
            self.field = _ACTIVITY.get(tuple(stack[3:]))
        elif self.laps == 1 and depth > 4:
            if depth > 6 and stack[4] == "Track" and stack[5] == "Trackpoint":
                self.field = _POINT.get(tuple(stack[6:]))
            elif depth == 6 and stack[4] == "Track" and name == "Trackpoint":
                self.sample = dict.fromkeys(_SAMPLE)
            else:
                self.field = _LAP.get(tuple(stack[4:]))
        self.value, self.chars = [], 0

    def _text(self, data: str) -> None:
        if self.field:
            self.chars += len(data)
            if self.chars > LONGEST_VALUE:
                raise Broken(MALFORMED)
            self.value.append(data)

    def _close(self, name: str) -> None:
        stack = self.stack
        if self.field:
            text = "".join(self.value)
            value: str | float | None = text
            if self.field not in _TEXT:
                try:
                    value = float(text) if text.strip() else None
                except ValueError:
                    raise Broken(MALFORMED) from None
                if "_" in text:  # Python's own way to write numbers
                    raise Broken(MALFORMED)
            # Samples are open only while their fields are.
            (self.found if self.sample is None else self.sample)[self.field] = value
            self.field = None
        if self.sample is not None and len(stack) == 6:
            self.points.append(tuple(self.sample.values()))
            self.sample = None
        stack.pop()


def pieces(source: BinaryIO, zipped: bool) -> Iterator[bytes]:
    """The content of a file in pieces, inflated where ``zipped``."""
    length = 0
    inflate = zlib.decompressobj(31) if zipped else None
    while data := source.read(PIECE):
        while data:
            if inflate is None:
                piece, data = data, b""
            else:
                if inflate.eof:  # another member follows
                    inflate = zlib.decompressobj(31)
                try:
                    piece = inflate.decompress(data, PIECE)
                except zlib.error as problem:
                    raise Broken(f"no valid gzip stream: {problem}") from None
                data = inflate.unconsumed_tail or inflate.unused_data
            length += len(piece)
            if length > LONGEST_FILE:
                raise Broken("payload is too long")
            yield piece
    if inflate is not None and not inflate.eof:
        raise Broken("gzip stream ends early")


def read(open_file: Callable[[], BinaryIO], zipped: bool) -> Iterator[dict | list[tuple]]:
    """First what is known of the file, with ``error``, then its samples in lists."""
    lap, held, whole = LapFile(), [], True
    error = None
    try:
        with open_file() as source:
            for piece in pieces(source, zipped):
                lap.feed(piece)
                if lap.points:
                    if whole:
                        held += lap.points
                        whole = len(held) <= HELD
                        held = held if whole else []
                    lap.points.clear()
            lap.end()
    except Broken as problem:
        error = str(problem)
    except expat.ExpatError:
        error = MALFORMED
    except OSError as problem:
        error = f"payload could not be read: {problem}"
    found = lap.found
    if error not in (None, NO_ACTIVITY, NO_LAP):
        found = {}
    start = found.pop("lap_start", None) or found.pop("id", None)
    found.pop("id", None)
    yield {**found, "start": start.strip() if start else start, "error": error}
    if error is None and whole:
        yield held
    elif error is None:
        again = LapFile()
        with open_file() as source:
            for piece in pieces(source, zipped):
                again.feed(piece)
                if len(again.points) >= HELD:
                    yield again.points
                    again.points = []
        yield again.points


def rows(
    files: Iterator[tuple[str, Callable[[], BinaryIO]]]
) -> Iterator[pa.RecordBatch]:
    """Files and their samples as batches of ``schemas.LAP_ROW``."""
    schema = to_arrow_schema(schemas.LAP_ROW)
    names, width = schema.names, len(schema.names)
    sample = [names.index(name) for name in _SAMPLE]
    held: list[list] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*held)) if held else [[]] * width
        made = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        held.clear()
        return made

    for payload, open_file in files:
        # The suffix test is case-sensitive, as in the id rule.
        for part in read(open_file, payload.endswith(".gz")):
            if isinstance(part, dict):
                held.append([payload, True, *(part.get(name) for name in names[2:])])
                continue
            for point in part:
                row = [payload, False] + [None] * (width - 2)
                for at, value in zip(sample, point):
                    row[at] = value
                held.append(row)
            if len(held) >= HELD:
                yield batch()
    yield batch()


def parse_contents(files: DataFrame) -> DataFrame:
    """``schemas.LAP_ROW`` of files given as ``payload`` and ``content``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def opened() -> Iterator[tuple[str, Callable[[], BinaryIO]]]:
            for batch in batches:
                for payload, content in zip(batch.column(0), batch.column(1)):
                    data = content.as_buffer() if content.is_valid else b""
                    yield payload.as_py(), lambda data=data: pa.BufferReader(data)
        yield from rows(opened())

    return files.select("payload", "content").mapInArrow(run, schemas.LAP_ROW)


def parse_stored(payloads: DataFrame, root: str) -> DataFrame:
    """``schemas.LAP_ROW`` of the files named by ``payload``, a path below ``root``.

    A file is opened in the task by its exact name, whatever characters it has. Names are short and
    say nothing of the work behind them, so the number of tasks goes by files, not by bytes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(uri_of(root))

        def opened() -> Iterator[tuple[str, Callable[[], BinaryIO]]]:
            for batch in batches:
                for payload in batch.column(0).to_pylist():
                    yield payload, lambda name=payload: store.open_input_stream(
                        f"{top}/{name}", compression=None)
        yield from rows(opened())

    spread = payloads.select("payload").distinct()
    cores = payloads.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-payloads.count() // DEALT))
    return spread.repartition(tasks, "payload").mapInArrow(run, schemas.LAP_ROW)
