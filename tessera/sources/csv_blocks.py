"""CSV objects read in blocks of bytes, quoted line ends included.

An object is cut into blocks of a fixed number of bytes, so that a large one is read by
many tasks.  Whether a block starts inside a quoted field depends on all bytes before
it: a first pass over the blocks of large objects gives, for each block, the state at
its end as a function of the state at its start, and a running composition of these
functions gives every block its start.  A block then reads the records that start in
it.  Each byte of an object belongs to one record, which is decoded as UTF-8 as a whole.

The state changes at runs of quotes alone.  A run of an even number changes nothing: its
quotes are an empty field, or are escaped by each other.  A run of an odd number that
starts a field opens it if none is open, and closes it otherwise; one that starts no
field closes an open one and is literal text elsewhere, so that none is open after it.
"""

from __future__ import annotations

import csv
import io
import os
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import local_path, pyarrow_filesystem

BLOCK_BYTES = 32 << 20
BATCH_ROWS = 8192
BOM = b"\xef\xbb\xbf"
QUOTE, LF, CR = 34, 10, 13

# Kinds of failure, in the order in which they are reported.
UNREADABLE, NOT_UTF8, NOT_CSV = 1, 2, 3


def open_object(path: str):
    """A seekable binary stream of an object."""
    if path.startswith(("file:", "/")):
        return open("/" + local_path(path).lstrip("/"), "rb")
    filesystem, p = pyarrow_filesystem(path)
    return filesystem.open_input_file(p)


def odd_runs(data: np.ndarray, before: int, sep: int) -> tuple[np.ndarray, np.ndarray]:
    """(end, starts a field) of the runs of an odd number of quotes in ``data``; ``before``
    is the byte in front of it, or -1 at the start of the object.  A run that goes on
    from the byte before belongs to the data before."""
    at = np.flatnonzero(data == QUOTE)
    if not len(at):
        return at, np.zeros(0, bool)
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    last = np.append(first[1:], len(at)) - 1
    starts, ends = at[first], at[last] + 1
    previous = np.where(starts > 0, data[starts - 1], before if before >= 0 else LF)
    odd = (ends - starts) % 2 == 1
    if before == QUOTE and starts[0] == 0:
        odd[0] = False
    return ends[odd], np.isin(previous[odd], (sep, LF, CR))


def transition(ends: np.ndarray, opens: np.ndarray) -> tuple[bool, int]:
    """A block's function: (whether the state at its end does not depend on its start, the
    number of changes, modulo 2, since the last run after which no field is open)."""
    fixed = np.flatnonzero(~opens)
    if len(fixed):
        return True, (len(ends) - 1 - int(fixed[-1])) % 2
    return False, len(ends) % 2


def states(opens: np.ndarray, start: int) -> np.ndarray:
    """1 where a quoted field is open after each run, ``start`` being so before the first."""
    n = np.arange(1, len(opens) + 1)
    fixed = np.maximum.accumulate(np.where(opens, 0, n))
    return np.where(fixed > 0, n - fixed, n + start) % 2


def record_end(data: np.ndarray, ends: np.ndarray, opens: np.ndarray, start: int, frm: int) -> int:
    """Position after the first line end at or after ``frm`` that no field holds; -1 if none."""
    after = states(opens, start)
    lines = frm + np.flatnonzero(data[frm:] == LF)
    run = np.searchsorted(ends, lines, side="right") - 1
    free = lines[np.where(run >= 0, after[np.maximum(run, 0)] if len(after) else start, start) == 0]
    return int(free[0]) + 1 if len(free) else -1


def _past_quotes(f, data: bytes) -> bytes:
    """``data`` and the quotes that directly follow it, which belong to its last run."""
    more = []
    while data.endswith(b'"') or more:
        chunk = f.read(4096)
        rest = chunk.lstrip(b'"')
        more.append(chunk[:len(chunk) - len(rest)])
        if rest or not chunk:
            break
    return data + b"".join(more)


def _to_record_end(f, head: bytes, before: int, start: int, frm: int, sep: int, chunk: int = 1 << 16) -> bytes:
    """``head`` and what follows it up to the end of the record that holds byte ``frm``."""
    data = head
    while True:
        raw = np.frombuffer(data, np.uint8)
        end = record_end(raw, *odd_runs(raw, before, sep), start, frm)
        # A run of quotes at the very end may go on; a line end before it is not touched.
        if end >= 0:
            return data[:end]
        more = f.read(max(chunk, len(data)))
        if not more:
            return data
        data += more


def first_record(path: str, sep: str) -> bytes:
    """Bytes of an object's first record, line ends in quoted fields included, without a
    byte order mark."""
    with open_object(path) as f:
        head = f.read(1 << 16)
        head = head[3:] if head.startswith(BOM) else head
        return _to_record_end(f, head, -1, 0, 0, ord(sep))


def parse(text: str, sep: str, field_limit: int | None) -> Iterator[list[str]]:
    """Records of a text; a field of more than ``field_limit`` characters is an error."""
    limit = csv.field_size_limit(field_limit or max(len(text) + 1, 131_072))
    try:
        yield from csv.reader(io.StringIO(text), delimiter=sep)
    finally:
        csv.field_size_limit(limit)


def read_block(path: str, offset: int, end: int | None, start: int, sep: str) -> bytes:
    """Bytes of the records that start at ``offset`` or later and before ``end`` (None: the
    object's end), ``start`` being the state before the first byte."""
    with open_object(path) as f:
        f.seek(max(offset - 1, 0))
        before = f.read(1)[0] if offset else -1
        data = f.read(end - offset) if end is not None else f.read()
        if offset == 0 and data.startswith(BOM):
            data = data[3:]
        raw = np.frombuffer(data, np.uint8)
        skip = 0
        if offset and not (before == LF and start == 0):
            ends, opens = odd_runs(raw, before, ord(sep))
            skip = record_end(raw, ends, opens, start, 0)
            if skip < 0 or (end is not None and skip >= len(raw)):
                return b""              # the next block's records start after this one
        if end is None or not len(raw):
            return data[skip:]
        return _to_record_end(f, data, before, start, len(raw) - 1, ord(sep))[skip:]


def with_states(blocks: DataFrame, sep: str) -> DataFrame:
    """``blocks(file_path, block, offset, stop, ...)`` -> the same with ``start``: 1 where a
    block starts inside a quoted field.  Only objects of several blocks are read for it."""
    sep_byte = ord(sep)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, block, offset, stop in zip(*[c.to_pylist() for c in batch.columns]):
                fixed, changes = False, 0
                try:
                    with open_object(path) as f:
                        f.seek(max(offset - 1, 0))
                        before = f.read(1)[0] if offset else -1
                        data = f.read(stop - offset)
                        if offset == 0 and data.startswith(BOM):
                            data = data[3:]
                        fixed, changes = transition(*odd_runs(np.frombuffer(_past_quotes(f, data), np.uint8), before, sep_byte))
                except (OSError, IndexError):
                    pass                # reported by the read of the block
                out.append((path, block, fixed, changes))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["file_path", "block", "fixed", "changes"])

    scanned = blocks.where("n_blocks > 1 and block < n_blocks - 1").select("file_path", "block", "offset", "stop")
    scanned = spread(scanned).mapInArrow(fn, "file_path string, block long, fixed boolean, changes long")
    here = Window.partitionBy("file_path").orderBy("block")
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = scanned.withColumn("sum", F.sum("changes").over(upto))
    # Changes since the last block whose end does not depend on its start, that block's own included.
    base = F.coalesce(F.last(F.when(F.col("fixed"), F.col("sum") - F.col("changes")), ignorenulls=True).over(upto), F.lit(0))
    starts = scanned.select("file_path", (F.col("block") + 1).alias("block"), ((F.col("sum") - base) % 2).alias("start"))
    return blocks.join(starts, ["file_path", "block"], "left").withColumn("start", F.coalesce("start", F.lit(0)))


def spread(blocks: DataFrame) -> DataFrame:
    """A fixed number of tasks: thin rows would be coalesced to one."""
    spark = blocks.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return blocks.repartition(tasks, "file_path", "block")


def blocks_of(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``files(file_path, length, ...)`` -> one row per block: ``block, n_blocks, offset, stop``."""
    n = F.greatest(F.lit(1), F.ceil(F.col("length") / block_bytes)).cast("long")
    out = files.withColumn("n_blocks", n).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    offset = F.col("block") * block_bytes
    return out.withColumn("offset", offset).withColumn("stop", offset + block_bytes)


ROWS_SCHEMA = ("file_path string, row_no long, is_short boolean, is_long boolean, failure int, fields array<string>")


def read_rows(files: DataFrame, sep: str = ",", block_bytes: int = BLOCK_BYTES, field_limit: int | None = None) -> DataFrame:
    """``files(file_path, length, width)`` -> the records after the first of every object:
    ``file_path, row_no`` (grows with the position), ``is_short, is_long`` (fewer, or more,
    fields than ``width``), ``failure`` and ``fields``, exactly ``width`` of them.

    Blank lines are no records.  A block that cannot be read, decoded or parsed gives one
    row whose ``failure`` says so (null elsewhere), with no fields; where bytes are no
    UTF-8, its records follow with replacement characters.  A failure fails no other
    object."""
    blocks = with_states(blocks_of(files.select("file_path", "length", "width"), block_bytes), sep)
    blocks = spread(blocks.select("file_path", "block", "n_blocks", "offset", "stop", "start", "width"))

    def records(path, block, n_blocks, offset, stop, start, width):
        """(row, fields) of a block, failures as (row, kind)."""
        try:
            raw = read_block(path, offset, stop if block < n_blocks - 1 else None, start, sep)
        except (OSError, IndexError):
            yield offset, UNREADABLE
            return
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            yield offset, NOT_UTF8
            text = raw.decode("utf-8", errors="replace")
        del raw
        if "\0" in text:
            yield offset, NOT_CSV
            return
        at = offset
        rows = parse(text, sep, field_limit)
        try:
            if block == 0:
                next(rows, None)
            for row in rows:
                if row:
                    yield at, row
                    at += 1
        except csv.Error:
            yield at, NOT_CSV

    def batch_of(path: str, width: int, rows: list) -> pa.RecordBatch:
        fields = [() if isinstance(r, int) else r if len(r) == width else (r + [None] * width)[:width] for _, r in rows]
        sizes = [-1 if isinstance(r, int) else len(r) for _, r in rows]
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in fields])])
        return pa.RecordBatch.from_arrays([
            pa.array([path]).take(pa.array(np.zeros(len(rows), np.int32))), pa.array([at for at, _ in rows], pa.int64()),
            pa.array([0 <= n < width for n in sizes]), pa.array([n > width for n in sizes]),
            pa.array([r if isinstance(r, int) else None for _, r in rows], pa.int32()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(chain.from_iterable(fields), pa.string()))],
            names=["file_path", "row_no", "is_short", "is_long", "failure", "fields"])

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in zip(*[c.to_pylist() for c in batch.columns]):
                found = records(*block)
                while rows := list(islice(found, BATCH_ROWS)):
                    yield batch_of(block[0], block[-1], rows)

    return blocks.mapInArrow(fn, ROWS_SCHEMA)


def list_folder(path: str) -> list[tuple[str, bool, int, int]]:
    """(path, is a folder, length, modification time in ms) of what a folder holds."""
    if path.startswith(("file:", "/")):
        with os.scandir("/" + local_path(path).lstrip("/")) as entries:
            found = [(e.path, e.is_dir(), e.stat()) for e in entries]
        return [("file:" + p, d, s.st_size, int(s.st_mtime * 1000)) for p, d, s in found]
    from pyarrow import fs as pafs
    filesystem, p = pyarrow_filesystem(path)
    scheme = path.split("://", 1)[0] + "://"
    return [(scheme + e.path, e.type == pafs.FileType.Directory, e.size or 0, int((e.mtime_ns or 0) / 1e6))
            for e in filesystem.get_file_info(pafs.FileSelector(p))]
