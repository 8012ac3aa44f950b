"""Web-archive sources: whole files as a data source, or single records by byte range."""

from __future__ import annotations

import io
import json
from collections.abc import Callable, Collection, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.html_outline import OUTLINE_TYPE, outline
from ..schemas import WARC_RECORDS
from .warc_format import UNREADABLE, first_record, read_records

_COLUMNS = WARC_RECORDS.names
_ARROW = pa.schema([
    (f.name, pa.map_(pa.string(), pa.string()) if f.name == "headers" else pa.binary() if f.name == "payload" else pa.string())
    for f in WARC_RECORDS.fields
])


#: Compressed bytes of an archive that one task reads.
SPLIT_BYTES = 256 << 20
#: Bytes of records that a task holds before it hands them on; what a record counts besides its payload.
PACK_BYTES, RECORD_BYTES = 8 << 20, 1 << 10
#: Bits of the filter that wanted urls are put into, at most.
FILTER_BITS = 1 << 26
_PROBES = 4


class WarcPiece(InputPartition):
    """Records that begin in a stretch of an archive."""

    def __init__(self, path: str, name: str, start: int, end: int) -> None:
        self.path, self.name, self.start, self.end = path, name, start, end


def pieces(path: str, split_bytes: int = SPLIT_BYTES) -> list[WarcPiece]:
    """The archive at ``path``, or all archives below it, cut into stretches of about ``split_bytes``."""
    storage, root = fs.FileSystem.from_uri(path)
    info = storage.get_file_info(root)
    if info.type == fs.FileType.File:
        found = [(path, path, info.size)]
    else:
        prefix, inner = path.rstrip("/"), root.rstrip("/")
        files = storage.get_file_info(fs.FileSelector(root, recursive=True))
        named = [(f.path[len(inner):], f.size) for f in files if f.type == fs.FileType.File and f.path.endswith((".warc", ".warc.gz"))]
        found = [(prefix + name, name.lstrip("/"), size) for name, size in sorted(named)]
    out = []
    for file, name, size in found:
        n = max(1, -(-size // split_bytes))
        out += [WarcPiece(file, name, size * i // n, size * (i + 1) // n) for i in range(n)]
    return out


def _read_piece(piece: WarcPiece, wanted: Callable[[str, str, str], bool] | None) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size in bytes: rows would be gathered by number, whatever they weigh."""
    storage, path = fs.FileSystem.from_uri(piece.path)
    with storage.open_input_file(path) as raw:
        start = first_record(raw, piece.start, piece.end)
        if start is None:
            return
        yield from _batches(read_records(piece.name, raw, start, piece.end, wanted))


def _batches(records: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    for rows in _packs(records):
        columns = dict(zip(_COLUMNS, map(list, zip(*rows, strict=True)), strict=True))
        columns["headers"] = [list(h.items()) for h in columns["headers"]]
        yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in _ARROW], schema=_ARROW)


@dataclass(frozen=True)
class RecordFilter:
    """Tests of a record's type, uri and date that the reader makes before it reads the record's block; all must hold.

    ``types`` and ``uris`` name what is wanted, ``uri_prefix`` how a uri begins, ``date_start`` and ``date_end`` bound the date as
    text, both included. ``files`` names archives as ``filename`` has them; others are not opened.
    """

    types: Sequence[str] | None = None
    uris: Sequence[str] | None = None
    uri_prefix: str = ""
    date_start: str | None = None
    date_end: str | None = None
    files: Sequence[str] | None = None

    def written(self) -> str:
        return json.dumps({k: list(v) if isinstance(v, Collection) and not isinstance(v, str) else v for k, v in vars(self).items()}, sort_keys=True)

    def test(self) -> Callable[[str, str, str], bool] | None:
        """The test itself; None if every record is wanted."""
        types = None if self.types is None else frozenset(self.types)
        uris = None if self.uris is None else frozenset(self.uris)
        low, high, prefix = self.date_start, self.date_end, self.uri_prefix
        if types is None and uris is None and not prefix and low is None and high is None:
            return None

        def wanted(kind: str, uri: str, date: str) -> bool:
            return (
                (types is None or kind in types) and (uris is None or uri in uris) and uri.startswith(prefix)
                and (low is None or date >= low) and (high is None or date <= high)
            )

        return wanted


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.split_bytes = options["path"], int(options.get("splitBytes", SPLIT_BYTES))
        self.wanted = RecordFilter(**json.loads(options.get("wanted", "{}")))

    def partitions(self) -> list[InputPartition]:
        files = self.wanted.files
        return [p for p in pieces(self.path, self.split_bytes) if files is None or p.name in files]

    def read(self, partition: WarcPiece) -> Iterator[pa.RecordBatch]:
        return _read_piece(partition, self.wanted.test())


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(folder)``: one task per stretch of an archive, records streamed.

    ``splitBytes`` is the length of a stretch, ``wanted`` a ``RecordFilter`` as written. Filters are options and not taken from the
    plan: Spark 4.1 keeps filters that it pushed into a Python source with the relation, so that a second filter on the
    same DataFrame, or the other side of a self-join, gets the rows of the first.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self):
        return WARC_RECORDS

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)


def scan_warc(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, wanted: RecordFilter | None = None) -> DataFrame:
    """Every record of every archive below ``path``, or every wanted one, large archives by many tasks.

    A task finds the first record after the start of its stretch and reads the last one that begins there to its end. Blocks of
    records that are not wanted are passed over where they are read; they do not become rows.
    """
    spark.dataSource.register(WarcDataSource)
    wanted = wanted or RecordFilter()
    return spark.read.format("warc").option("splitBytes", split_bytes).option("wanted", wanted.written()).load(path)


def _probes(h: Column, bits: int) -> Column:
    """Places of a 64-bit hash in a filter: low half and multiples of the high half."""
    low, high = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(0x7FFFFFFF))
    return F.array(*[F.pmod(low + high * i, F.lit(bits)) for i in range(_PROBES)])


class UrlFilter:
    """Says no to most strings that were not put in, and never to one that was."""

    def __init__(self, words: np.ndarray, bits: int) -> None:
        self.words, self.bits = words, bits

    def __contains__(self, url: str) -> bool:
        h = xxhash.xxh64_intdigest(url.encode(), 42)
        low, high = h & 0x7FFFFFFF, h >> 32 & 0x7FFFFFFF
        for i in range(_PROBES):
            at = (low + high * i) % self.bits
            if not int(self.words[at >> 6]) >> (at & 63) & 1:
                return False
        return True


def url_filter(urls: DataFrame, most_bits: int = FILTER_BITS) -> UrlFilter:
    """Filter of the column ``url``, counted together in Spark; ``most_bits`` bounds what comes to the driver.

    There are 16 bits a url as long as that bound allows; beyond it more strings pass that were not put in.
    """
    n = urls.agg(F.approx_count_distinct("url")).first()[0]
    bits = 1 << max(10, min((16 * n).bit_length(), most_bits.bit_length() - 1))
    place = urls.select(F.explode(_probes(F.xxhash64("url"), bits)).alias("at"))
    word = F.call_function("shiftright", F.col("at"), F.lit(6)).alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    found = place.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(bits >> 6, np.uint64)
    words[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return UrlFilter(words, bits)


def scan_targets(spark: SparkSession, path: str, index: DataFrame, split_bytes: int = SPLIT_BYTES, most_bits: int = FILTER_BITS) -> DataFrame:
    """The response records below ``path`` whose url is in ``index``: ``target_records`` of a scan, without its payloads on the way.

    The wanted urls go to the tasks as a filter of bounded size, so that a task reads blocks of wanted records and of a
    few others; an exact join drops those. Records that cannot be read are not among the rows.
    """
    urls = index.filter(F.length("url") > 0).select("url")
    shared = spark.sparkContext.broadcast(url_filter(urls, most_bits))
    found = pieces(path, split_bytes)
    if not found:
        return spark.createDataFrame([], WARC_RECORDS)
    places = [(p.path, p.name, p.start, p.end) for p in found]
    table = spark.createDataFrame(places, "path string, name string, start long, end long").repartition(len(found))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        urls = shared.value
        wanted = lambda kind, uri, date: kind == "response" and uri in urls
        for batch in batches:
            for row in batch.to_pylist():
                yield from _read_piece(WarcPiece(**row), wanted)

    records = table.mapInArrow(read, WARC_RECORDS)
    return records.join(urls.select(F.col("url").alias("target_uri")), "target_uri", "left_semi").select(*_COLUMNS)


def parse_members(members: DataFrame, filename: str = "filename", data: str = "member") -> DataFrame:
    """Records from a binary column that holds one or more archive members per row."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One member at a time becomes a Python object.
            rows = zip(batch.column(0), batch.column(1), strict=True)
            yield from _batches(r for name, raw in rows for r in read_records(name.as_py(), io.BytesIO(raw.as_py())))

    return members.select(filename, data).mapInArrow(parse, WARC_RECORDS)


def read_ranges(index: DataFrame, base: str, partitions: int, chunk_bytes: int = 256 << 20) -> DataFrame:
    """Fetch the record behind each index row (filename, offset, length).

    Work is split by stretches of ``chunk_bytes`` within a file, so a file with a third of all rows is
    read by many tasks, each moving forward through its stretch. The partition count is given because
    adaptive execution would merge these tiny rows into too few tasks for the work they cause.
    """
    return _fetch(index, base, partitions, chunk_bytes, lambda frame: frame, WARC_RECORDS)


def read_outlines(
    index: DataFrame, base: str, partitions: int, carry: Sequence[str] = (), chunk_bytes: int = 256 << 20
) -> DataFrame:
    """As ``read_ranges``, with the page's ``outline`` and ``error`` in place of headers and payload.

    Pages are tokenised where they are read: their bytes never pass from Python to the JVM and back.
    ``carry`` names string columns of the index to hand on, which saves joining pages to it later.
    """

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        pages = [outline(p) for p in frame["payload"]]
        parts = pd.DataFrame(pages, columns=OUTLINE_TYPE.names, index=frame.index)
        errors = frame["headers"].map(lambda h: h.get("error", ""))
        return frame.drop(columns=["headers", "payload"]).assign(error=errors).join(parts)

    plain = [f for f in WARC_RECORDS.fields if f.name not in ("headers", "payload")]
    carried = [StructField(c, StringType()) for c in carry]
    schema = StructType([*plain, *carried, StructField("error", StringType()), *OUTLINE_TYPE.fields])
    rows = _fetch(index, base, partitions, chunk_bytes, finish, schema, carry)
    names = [f.name for f in [*plain, *carried]]
    return rows.select(*names, "error", F.struct(*OUTLINE_TYPE.names).alias("outline"))


def _fetch(
    index: DataFrame,
    base: str,
    partitions: int,
    chunk_bytes: int,
    finish: Callable[[pd.DataFrame], pd.DataFrame],
    schema: StructType,
    carry: Sequence[str] = (),
) -> DataFrame:
    columns = [*_COLUMNS, *carry]

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part in batch.groupby("filename", sort=False):
                yield from map(finish, _frames(_read_file_part(base, name, part, carry), columns))

    wanted = index.select("filename", "offset", "length", *carry).distinct()
    spread = wanted.repartition(partitions, "filename", F.floor(F.col("offset") / chunk_bytes))
    return spread.sortWithinPartitions("filename", "offset").mapInPandas(fetch, schema)


def _read_file_part(base: str, name: str, part: pd.DataFrame, carry: Sequence[str]) -> Iterator[tuple]:
    """Records of the ranges, one after the other. What a range lacks or breaks off with is a record of its own, and
    the ranges after it are still read. Without a length the first record at the offset is taken."""
    ranges = list(part[["offset", "length", *carry]].itertuples(index=False, name=None))

    def failed(e: Exception, carried: Sequence) -> tuple:
        return (name, UNREADABLE, "", "", {"error": f"{type(e).__name__}: {e}"}, "", b"", *carried)

    try:
        storage, path = fs.FileSystem.from_uri(f"{base.rstrip('/')}/{name}")
        raw = storage.open_input_file(path)
    except OSError as e:
        for _, _, *carried in ranges:
            yield failed(e, carried)
        return
    with raw:
        for offset, length, *carried in ranges:
            try:
                if pd.isna(offset):
                    raise ValueError("index row without an offset")
                if pd.isna(length):
                    yield from ((*r, *carried) for r in islice(read_records(name, raw, int(offset)), 1))
                else:
                    member = io.BytesIO(raw.read_at(int(length), int(offset)))
                    yield from ((*r, *carried) for r in read_records(name, member))
            except (OSError, ValueError) as e:
                yield failed(e, carried)


def _frames(records: Iterable[tuple], columns: list[str] = _COLUMNS) -> Iterator[pd.DataFrame]:
    """Records packed into frames of bounded size, so that a task holds little at a time."""
    return (pd.DataFrame(rows, columns=columns) for rows in _packs(records))


def _packs(records: Iterable[tuple], max_bytes: int = PACK_BYTES) -> Iterator[list[tuple]]:
    payload = _COLUMNS.index("payload")
    rows: list[tuple] = []
    size = 0
    for r in records:
        rows.append(r)
        size += len(r[payload]) + RECORD_BYTES
        if size >= max_bytes:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def unreadable(records: DataFrame) -> DataFrame:
    """Damaged files and ranges as rows of the error table."""
    error = F.col("error") if "error" in records.columns else F.col("headers")["error"]
    return records.filter(F.col("warc_type") == UNREADABLE).select(
        F.lit("download_failed").alias("error_type"),
        error.alias("message"),
        F.create_map(F.lit("filename"), F.col("filename")).alias("context"),
    )
