"""Byte-split gzip corpora (S4): one stream per folder, cut into parts at arbitrary bytes, read by many tasks.

A gzip stream is a chain of members; each can be inflated on its own. The members are found without reading the
stream in order:

1. every part is searched for member headers by a task of its own (a match may be chance);
2. every match is inflated by a task of its own to the end of its member, whose checksum and length must fit; the
   few numbers that line numbering needs are noted;
3. the chain from byte 0 tells real members from chance matches: each must begin where its predecessor ends. The
   walk over these notes gives each unit of work its first line number.

Then each unit, some consecutive members, is inflated by one task, which yields the lines that begin in it; a line
that runs on into the next member is read to its end by the task where it began. A stream that is one single
member remains one task: its bytes cannot be inflated from the middle.

The list of part files is on the driver (as for any scan) and broadcast; notes are one row a member.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_table

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a read at most; the first of a run of reads is small, as most members are.
CHUNK, FIRST_CHUNK = 1 << 20, 16 << 10
#: Compressed bytes of a unit of work, at least (a unit ends with the member that reaches it).
UNIT_BYTES = 32 << 20
#: Tasks that read the units, at most; more units than that share tasks.
TASKS_PER_CORE = 16


class Stream:
    """The parts of one corpus as one sequence of bytes."""

    def __init__(self, paths: list[str], lengths: list[int]):
        self.paths = paths
        self.starts = [0, *accumulate(lengths)]

    @property
    def size(self) -> int:
        return self.starts[-1]

    def read(self, start: int, chunk: int = CHUNK) -> Iterator[bytes]:
        """The bytes from ``start`` on."""
        import pyarrow.fs as pfs

        at, size = start, min(FIRST_CHUNK, chunk)
        for i in range(bisect_right(self.starts, start) - 1, len(self.paths)):
            path = self.paths[i]
            if path.startswith("file:/") and not path.startswith("file:///"):
                path = "file:///" + path[len("file:/"):].lstrip("/")
            fs, inner = pfs.FileSystem.from_uri(path)
            with fs.open_input_file(inner) as fh:
                fh.seek(at - self.starts[i])
                while buf := fh.read(size):
                    at += len(buf)
                    yield buf
                    size = min(2 * size, chunk)


def header_places(stream: Stream, part: int) -> Iterator[int]:
    """Places in the stream where a member header may begin, of one part."""
    begin, end = stream.starts[part], stream.starts[part + 1]
    held, at = b"", begin
    for buf in stream.read(begin):
        held += buf
        i = held.find(MAGIC)
        while i >= 0 and at + i < end:
            yield at + i
            i = held.find(MAGIC, i + 1)
        if at + len(held) >= end + len(MAGIC) - 1:
            return
        at, held = at + len(held) - min(len(held), 2), held[-2:]


def _after_padding(stream: Stream, place: int) -> int:
    """Zero padding may follow a member."""
    for buf in stream.read(place):
        rest = buf.lstrip(b"\0")
        if rest:
            return place + len(buf) - len(rest)
        place += len(buf)
    return stream.size


def inflate(stream: Stream, start: int) -> Iterator[tuple[bytes, int | None]]:
    """Inflated pieces of the member at ``start``, then ``(b"", place of the next member)``.

    Raises zlib.error where the bytes are no gzip member, EOFError where the stream ends inside it.
    """
    dec = zlib.decompressobj(31)
    at = start
    for buf in stream.read(start):
        at += len(buf)
        yield dec.decompress(buf), None
        if dec.eof:
            yield b"", _after_padding(stream, at - len(dec.unused_data))
            return
    raise EOFError(f"the gzip stream of {stream.paths[0]} ends inside a member: a part is missing or cut")


def split_universal(raw: bytes) -> list[str]:
    """One ``\\n``-delimited record -> lines under universal newlines (``\\r\\n`` and lone ``\\r`` break too)."""
    pieces = raw.split(b"\r")
    if len(pieces) > 1 and pieces[-1] == b"":
        pieces.pop()
    return [p.decode("utf-8") for p in pieces]


def _count(returns: int, ends_with_return: bool) -> int:
    """Lines of a record, from its number of carriage returns."""
    return returns if returns and ends_with_return else returns + 1


NOTE = "folder string, start long, next long, whole boolean, broken boolean, inner long, head_len long, head_cr long, head_last boolean, tail_len long, tail_cr long, tail_last boolean"


def note(stream: Stream, folder: str, start: int) -> dict | None:
    """What line numbering needs to know of the member at ``start``; None if there is none.

    ``head`` is the text before the first newline (all of it where there is none), ``tail`` that behind the last,
    ``inner`` the lines in between. ``broken``: the stream ends inside the member.
    """
    n = {"folder": folder, "start": start, "whole": False, "broken": False, "inner": 0, "head_len": 0, "head_cr": 0, "head_last": False, "tail_len": 0, "tail_cr": 0, "tail_last": False}

    def extend(side: str, raw: bytes) -> None:
        if raw:
            n[side + "_len"] += len(raw)
            n[side + "_cr"] += raw.count(b"\r")
            n[side + "_last"] = raw.endswith(b"\r")

    try:
        for piece, after in inflate(stream, start):
            if after is not None:
                return n | {"next": after}
            first, *more = piece.split(b"\n")
            if not n["whole"]:
                extend("head", first)
            else:
                extend("tail", first)
            for record in more:
                if n["whole"]:
                    n["inner"] += _count(n["tail_cr"], n["tail_last"])
                n["whole"] = True
                n |= {"tail_len": 0, "tail_cr": 0, "tail_last": False}
                extend("tail", record)
    except zlib.error:
        return None
    except EOFError:
        return n | {"next": stream.size, "broken": True}
    return None


def chain(folder: str, size: int, notes: list[dict], unit_bytes: int = UNIT_BYTES) -> list[tuple]:
    """Units ``(folder, start, stop, skip, position)`` of a corpus from the notes of its members, chance matches
    included. ``skip``: the unit's text begins inside a line of an earlier one; ``position``: its first own line."""
    by_start = {n["start"]: n for n in notes}
    units: list[list] = []
    at = position = 0
    open_line: tuple[int, bool] | None = None  # carriage returns so far, and whether the last byte is one
    while at < size:
        n = by_start.get(at)
        if n is None:
            raise ValueError(f"{folder}: no gzip member begins at byte {at}")
        if n["broken"]:
            raise EOFError(f"{folder}: the gzip stream ends inside a member: a part is missing or cut")
        skip = open_line is not None
        crossing = 0
        if skip and n["whole"]:  # the open line ends here
            crossing = _count(open_line[0] + n["head_cr"], n["head_last"] if n["head_len"] else open_line[1])
        if not units or n["whole"] and units[-1][2] - units[-1][1] >= unit_bytes:
            units.append([folder, at, at, skip, position + crossing])
        units[-1][2] = at = n["next"]
        if n["whole"]:
            position += crossing + n["inner"] + (0 if skip else _count(n["head_cr"], n["head_last"]))
            open_line = (n["tail_cr"], n["tail_last"]) if n["tail_len"] else None
        elif n["head_len"]:
            open_line = (n["head_cr"] + (open_line[0] if skip else 0), n["head_last"])
    return [tuple(u) for u in units]


def unit_lines(stream: Stream, start: int, stop: int, skip: bool) -> Iterator[str]:
    """The lines that begin in the members from ``start`` to ``stop``."""
    at, pending = start, b""
    while at < stream.size and (at < stop or pending):
        beyond = at >= stop
        for piece, after in inflate(stream, at):
            if after is not None:
                at = after
                break
            if skip:
                i = piece.find(b"\n")
                if i < 0:
                    continue
                piece, skip = piece[i + 1 :], False
            records = piece.split(b"\n")
            records[0] = pending + records[0]
            pending = records.pop()
            for record in records:
                yield from split_universal(record)
                if beyond:
                    return
    if pending:
        yield from split_universal(pending)


def scan_members(spark: SparkSession, parts: dict[str, tuple[list[str], list[int]]], unit_bytes: int = UNIT_BYTES, batch_rows: int = 4096) -> DataFrame:
    """``folder, position, text`` of the corpora: folder -> (part files in order, their lengths)."""
    schema = "folder string, position bigint, text string"
    if not parts:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast({folder: Stream(*files) for folder, files in parts.items()})
    cores = spark.sparkContext.defaultParallelism

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for folder, part in zip(b["folder"], b["part"]):
                yield pd.DataFrame({"folder": folder, "start": list(header_places(shared.value[folder], part))}).astype({"start": "int64"})

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in NOTE.split(", ")]
        for b in batches:
            notes = []
            for folder, start in zip(b["folder"], b["start"]):
                found = note(shared.value[folder], folder, int(start))
                if found is not None:
                    notes.append(found)
                elif start == 0:
                    raise ValueError(f"{folder}: no gzip member begins at byte 0")
            yield pd.DataFrame(notes, columns=columns)

    def walk(notes: pd.DataFrame) -> pd.DataFrame:
        folder = notes["folder"].iloc[0]
        found = chain(folder, shared.value[folder].size, notes.to_dict("records"), unit_bytes)
        return pd.DataFrame(found, columns=["folder", "start", "stop", "skip", "position"])

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for folder, start, stop, skip, position in zip(b["folder"], b["start"], b["stop"], b["skip"], b["position"]):
                buf: list[str] = []
                for line in unit_lines(shared.value[folder], int(start), int(stop), bool(skip)):
                    buf.append(line)
                    if len(buf) == batch_rows:
                        yield pd.DataFrame({"folder": folder, "position": range(position, position + len(buf)), "text": buf})
                        position += len(buf)
                        buf = []
                if buf:
                    yield pd.DataFrame({"folder": folder, "position": range(position, position + len(buf)), "text": buf})

    pieces = [(f, i) for f, (paths, _) in parts.items() for i in range(len(paths))]
    found = spark.createDataFrame(pieces, "folder string, part int").repartition(min(len(pieces), 4 * cores)).mapInPandas(find, "folder string, start long")
    begins = spark.createDataFrame([(f, 0) for f, (_, lengths) in parts.items() if sum(lengths)], "folder string, start long")
    notes = found.unionByName(begins).distinct().repartition(4 * cores).mapInPandas(look, NOTE)
    units = write_table(notes.groupBy("folder").applyInPandas(walk, "folder string, start long, stop long, skip boolean, position long"), "gzip-units")
    return units.repartition(max(1, min(units.count(), TASKS_PER_CORE * cores))).mapInPandas(emit, schema)
