"""FASTQ chunks: compressed files one task each, plain files in byte ranges.

A gzip file cannot be split, so its records are counted off from the top. A plain file is read in ranges; a
range owns the records that start in it. Where a record starts is found from the four lines themselves: a line that
starts with ``@`` may be a quality string, but not with ``+`` two lines on and two lines of one length.
"""

from __future__ import annotations

import gzip
import sys
from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_RECORDS = "chunk string, _file bigint, _start bigint, _record bigint, name string, seq string, qual string"
_COUNTS = "_file bigint, _start bigint, _records bigint"
_BLOCK = 1 << 21
#: Bytes of a range of a plain file.
SPLIT = 1 << 27
#: Records behind the start of a range that have to agree on where records start.
AGREEING = 4


class _Range(InputPartition):
    def __init__(self, path: str, chunk: str, start: int, stop: int | None):
        self.path, self.chunk, self.start, self.stop = path, chunk, start, stop
        self.file = int.from_bytes(blake2b(path.encode(), digest_size=8).digest(), signed=True)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _files(path: str) -> list[tuple[str, int]]:
    """Path and size of a file, or of the regular files of a folder."""
    system, folder = _open(path)
    info = system.get_file_info(folder)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    scheme = path.split("://")[0] + "://" if "://" in path and system.type_name != "local" else ""
    # Names that start with _ or . are hidden, as for Spark's own file sources.
    return sorted((scheme + i.path, i.size) for i in found if i.type == fs.FileType.File and i.base_name[0] not in "._")


def _chunks(paths: list[str]) -> list[str]:
    """File names up to their first dot; after as many folders as tell equal names in different folders apart."""
    parts = [path.split("/") for path in paths]
    stems = [p[-1].split(".")[0] for p in parts]
    for depth in range(1, max(map(len, parts), default=1) + 1):
        names = ["/".join([*p[-depth:-1], stem]) for p, stem in zip(parts, stems, strict=True)]
        if len(set(names)) == len({(*p[:-1], stem) for p, stem in zip(parts, stems, strict=True)}):
            break
    return names if paths else []


def _ranges(paths: Sequence[str], size: int) -> list[_Range]:
    files = [f for path in paths for f in _files(path)]
    out = []
    for (path, length), chunk in zip(files, _chunks([path for path, _ in files]), strict=True):
        if path.endswith(".gz"):
            out.append(_Range(path, chunk, 0, None))
        else:
            out += [_Range(path, chunk, at, min(at + size, length)) for at in range(0, max(length, 1), size)]
    return out


class _FastqReader(DataSourceReader):
    def __init__(self, paths: list[str], split: int, count: bool):
        self.paths, self.split, self.count = paths, split, count

    def partitions(self) -> list[_Range]:
        found = _ranges(self.paths, self.split)
        if self.count:
            several = {r.path for r in found if r.start}
            return [r for r in found if r.path in several]
        return found

    def read(self, partition: _Range | None) -> Iterator[pa.RecordBatch]:
        # Without partitions (an empty or missing folder) Spark still starts one task.
        if not hasattr(partition, "path"):
            return
        counted = 0
        for names, seqs, quals in _records(partition):
            ids = np.arange(counted, counted + len(names))
            counted += len(names)
            if not self.count:
                whole = [pa.scalar(x, pa.int64()) for x in (partition.file, partition.start)]
                place = [pa.repeat(x, len(names)) for x in (partition.chunk, *whole)]
                texts = [pa.array(c, pa.binary()).cast(pa.string()) for c in ([n[1:] for n in names], seqs, quals)]
                yield pa.RecordBatch.from_arrays(
                    [*place, pa.array(ids, pa.int64()), *texts], names=["chunk", "_file", "_start", "_record", "name", "seq", "qual"]
                )
        if self.count:
            yield pa.record_batch({"_file": [partition.file], "_start": [partition.start], "_records": [counted]})


def _records(part: _Range) -> Iterator[tuple[list[bytes], list[bytes], list[bytes]]]:
    """Names, sequences and qualities of the records that start in a range."""
    system, path = _open(part.path)
    if part.stop is None:
        with system.open_input_stream(path, compression=None) as raw:
            yield from (_checked(lines, part.path) for lines in _raw_groups(gzip.open(raw)))
        return
    with system.open_input_file(path) as raw:
        at = _first_record(raw, part)
        if at is None:
            return
        raw.seek(at)
        for lines in _raw_groups(raw):
            starts = at + np.cumsum([0, *map(len, lines)][:-1]) + np.arange(len(lines))
            own = int((starts[::4] < part.stop).sum())
            at = int(starts[-1]) + len(lines[-1]) + 1
            if own:
                yield _checked(lines[: 4 * own], part.path)
            if 4 * own < len(lines):
                return


def _checked(lines: list[bytes], path: str) -> tuple[list[bytes], list[bytes], list[bytes]]:
    lines = _stripped(lines)
    names, seqs, quals = lines[0::4], lines[1::4], lines[3::4]
    if len(lines) % 4 or not all(n.startswith(b"@") for n in names):
        raise ValueError(f"{path}: not whole records of four lines")
    return names, seqs, quals


def _first_record(raw, part: _Range) -> int | None:
    """Where the first record at or after the start of a range begins; None where the file ends before."""
    if part.start == 0:
        return 0
    raw.seek(part.start - 1)
    seen = b""
    while True:
        block = raw.read(_BLOCK)
        seen += block
        # The first line is one that began before the range, or the line break before it.
        lines = seen.split(b"\n")
        offsets = part.start - 1 + np.cumsum([0, *(len(x) + 1 for x in lines[:-1])])
        whole = [x.rstrip(b"\r") for x in (lines[1:-1] if block else _without_blank_end(lines[1:]))]
        fits = [k for k in range(4) if _fit(whole[k:], AGREEING)]
        if len(fits) == 1 and (not block or len(whole) >= 4 * (AGREEING + 1)):
            return int(offsets[fits[0] + 1])
        if not block:
            # Up to three lines may belong to a record of the range before.
            if len(whole) < 4:
                return None
            raise ValueError(f"{part.path}: cannot tell where records start behind byte {part.start}")


def _without_blank_end(lines: list[bytes]) -> list[bytes]:
    while lines and not lines[-1].strip():
        lines = lines[:-1]
    return lines


def _fit(lines: list[bytes], most: int) -> bool:
    """Whether lines are records from the first on: at least one whole record, and no sign against it in the first ``most``."""
    records = [lines[i : i + 4] for i in range(0, min(len(lines) // 4, most) * 4, 4)]
    return bool(records) and all(
        r[0].startswith(b"@") and r[2].startswith(b"+") and len(r[1]) == len(r[3]) and not r[1].startswith((b"@", b"+")) for r in records
    )


def _line_groups(stream) -> Iterator[list[bytes]]:
    """Lines of a byte stream, in groups of whole records but for a broken end."""
    return map(_stripped, _raw_groups(stream))


def _stripped(lines: list[bytes]) -> list[bytes]:
    return [line.rstrip(b"\r") for line in lines] if lines[0].endswith(b"\r") else lines


def _raw_groups(stream) -> Iterator[list[bytes]]:
    """The same with the carriage returns, so that lengths add up to places in the file."""
    rest: list[bytes] = [b""]
    while block := stream.read(_BLOCK):
        lines = (rest.pop() + block).split(b"\n")
        rest += lines
        # The last line may go on in the next block.
        whole = (len(rest) - 1) // 4 * 4
        if whole:
            yield rest[:whole]
            rest = rest[whole:]
    while rest and not rest[-1].strip():
        rest.pop()
    if rest:
        yield rest


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return _COUNTS if self.options.get("count") == "true" else _RECORDS

    def reader(self, schema) -> DataSourceReader:
        return _FastqReader(self.options["paths"].split("\n"), int(self.options["split"]), self.options.get("count") == "true")


def read_fastq(spark: SparkSession, path: str | Sequence[str], split: int = SPLIT) -> DataFrame:
    """Interleaved pairs ``chunk, pair_id, mate, name, seq, qual`` of files, or of every regular file of folders.

    No rows where a folder does not exist. ``pair_id`` counts from 0 in each ``chunk``, the file name up to its
    first dot; where files of several folders share a name, with the folders that tell them apart before it. A plain file of
    more than ``split`` bytes is read in ranges of that size by tasks of their own. Its records are counted once
    before, range by range, so pairs are numbered as from the top of the file; a range whose
    first record cannot be told for certain raises.
    """
    # Executors need not have this package: the source travels with the query.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(FastqSource)
    paths = [path] if isinstance(path, str) else list(path)
    options = {"paths": "\n".join(paths), "split": str(split)}
    rows = spark.read.format("fastq").options(**options).load()
    before = F.lit(0)
    if any(r.start for r in _ranges(paths, split)):
        counts = spark.read.format("fastq").options(**options, count="true").load()
        earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("_file", "_start", F.sum("_records").over(earlier).alias("_before"))
        # One row per range of ``split`` bytes.
        rows = rows.join(F.broadcast(offsets), ["_file", "_start"], "left")
        before = F.coalesce("_before", F.lit(0))
    number = F.col("_record") + before
    return rows.select(
        "chunk", F.floor(number / 2).cast("bigint").alias("pair_id"), (number % 2 + 1).cast("int").alias("mate"), "name", "seq", "qual"
    )
