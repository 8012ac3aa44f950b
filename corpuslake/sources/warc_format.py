"""Per-file helper: records of a (gzip) web archive read from a byte stream."""

from __future__ import annotations

import io
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

# filename, warc_type, target_uri, warc_date, headers, status_code, payload
Record = tuple[str, str, str, str, dict[str, str], str, bytes]

UNREADABLE = "unreadable"


#: A chain of whole members that runs further than this is the archive's own. Bytes of an archive that lie in a payload show
#: only inside stored blocks of the payload's own deflate stream, which hold at most 65,535.
SURE = 65_535
_MAGIC = b"\x1f\x8b\x08"
_LINE = b"WARC/"


class Plain:
    """An uncompressed archive; every place is one where reading may begin."""

    def __init__(self, raw: BinaryIO, at: int = 0, chunk: int = 1 << 16) -> None:
        raw.seek(at)
        self._raw, self._chunk = raw, chunk
        self._ready, self._at, self._before = b"", 0, at

    def _more(self) -> bool:
        self._before += len(self._ready)
        self._ready, self._at = self._raw.read(self._chunk), 0
        return bool(self._ready)

    def here(self) -> int | None:
        """Place in the file of what is read next, if reading may begin there."""
        return self._before + self._at

    def read(self, size: int) -> bytes:
        out = []
        while size:
            if self._at == len(self._ready) and not self._more():
                break
            part = self._ready[self._at : self._at + size]
            self._at += len(part)
            size -= len(part)
            out.append(part)
        return b"".join(out)

    def skip(self, size: int) -> int:
        """Pass over ``size`` bytes without reading them; how many there were."""
        left = size - (len(self._ready) - self._at)
        if left <= 0:
            self._at += size
            return size
        place, last = self._before + len(self._ready) + left, self._raw.seek(0, io.SEEK_END)
        self._before = self._raw.seek(min(place, last))
        self._ready, self._at = b"", 0
        return size - max(0, place - last)

    def readline(self) -> bytes:
        out = []
        while self._at < len(self._ready) or self._more():
            end = self._ready.find(b"\n", self._at) + 1 or len(self._ready)
            out.append(self._ready[self._at : end])
            self._at = end
            if out[-1].endswith(b"\n"):
                break
        return b"".join(out)


class Members(Plain):
    """Concatenated gzip members as one stream. Reading may begin where a member does. All whole members are handed out
    before a damaged one raises."""

    def __init__(self, raw: BinaryIO, at: int = 0, chunk: int = 1 << 16) -> None:
        super().__init__(raw, at, chunk)
        self._member = None
        self._rest = b""
        self._next = at  # place of the first byte of ``_rest``
        self.sound = at  # where the last whole member ended

    def _open(self) -> bool:
        """Begin the member after the last one, zeros between them passed over; False at the end of the file."""
        while True:
            data = self._rest or self._raw.read(self._chunk)
            if not data:
                return False
            self._rest = data.lstrip(b"\0")
            self._next += len(data) - len(self._rest)
            if self._rest:
                break
        self._member = zlib.decompressobj(31)
        return True

    def _pull(self) -> None:
        data = self._rest or self._raw.read(self._chunk)
        if not data:
            raise EOFError("gzip member cut short")
        self._ready, self._at = self._member.decompress(data), 0
        self._rest = self._member.unused_data
        self._next += len(data) - len(self._rest)
        if self._member.eof:
            self.sound = self._next

    def _more(self) -> bool:
        self._ready, self._at = b"", 0
        while not self._ready:
            if (self._member is None or self._member.eof) and not self._open():
                return False
            self._pull()
        return True

    def here(self) -> int | None:
        while self._at == len(self._ready):
            if self._member is None or self._member.eof:
                # What follows is not looked into yet: it may be damaged, and what came before it is whole.
                while True:
                    data = self._rest or self._raw.read(self._chunk)
                    self._rest = data.lstrip(b"\0")
                    self._next += len(data) - len(self._rest)
                    if self._rest or not data:
                        return self._next
            self._pull()
        return None

    def skip(self, size: int) -> int:
        """Pass over ``size`` bytes, which have to be decompressed, without keeping them; how many there were."""
        left = size
        while left:
            if self._at == len(self._ready) and not self._more():
                break
            step = min(left, len(self._ready) - self._at)
            self._at += step
            left -= step
        return size - left

    def pass_member(self) -> None:
        """Go to the end of the member that is being read."""
        while self._member is not None and not self._member.eof:
            self._pull()
        self._ready, self._at = b"", 0


def is_gzip(raw: BinaryIO, at: int = 0) -> bool:
    raw.seek(at)
    return raw.read(2) == _MAGIC[:2]


def open_stream(raw: BinaryIO, at: int = 0) -> Plain:
    """Decompressed stream from a place where reading may begin; one gzip member per record is the usual layout."""
    return (Members if is_gzip(raw, at) else Plain)(raw, at)


def _candidates(raw: BinaryIO, mark: bytes, start: int, end: int, chunk: int = 1 << 20) -> Iterator[int]:
    """Places in [start, end) where the bytes of ``mark`` stand."""
    at, kept = start, b""
    while at - len(kept) < end:
        raw.seek(at)
        data = raw.read(chunk)
        if not data:
            return
        block = kept + data
        first = at - len(kept)
        found = block.find(mark)
        while found >= 0 and first + found < end:
            yield first + found
            found = block.find(mark, found + 1)
        at += len(data)
        kept = block[-(len(mark) - 1) :]


def _version_line(stream: Plain) -> bool | None:
    """Whether a version line comes next, blank lines aside; None at the end."""
    head = b""
    while len(head) < len(_LINE):
        more = stream.read(len(_LINE) - len(head))
        if not more:
            break
        head = (head + more).lstrip(b"\r\n")
    return head == _LINE if head else None


def _first_after(raw: BinaryIO, start: int, least: int) -> int | None:
    """First place from ``least`` on where a member with a version line begins, reached member by member from ``start``."""
    stream = Members(raw, start)
    while True:
        here = stream.here()
        found = _version_line(stream)
        if found is None:
            return None
        if found and here >= least:
            return here
        stream.pass_member()


def _trial(raw: BinaryIO, at: int) -> bool | None:
    """Whether a member of the archive begins at ``at``; None if a fault soon after leaves that open."""
    stream = Members(raw, at)
    try:
        if not _version_line(stream):
            return False
    except (OSError, EOFError, zlib.error):
        return False
    try:
        while stream.sound - at <= SURE:
            if not stream.skip(1 << 16):
                return True
    except (OSError, EOFError, zlib.error):
        return None
    return True


def _headers(raw: BinaryIO) -> Iterator[int]:
    """Places of the records of an uncompressed archive; of each only the header is read."""
    stream = Plain(raw, 0, 1 << 12)
    while True:
        here = stream.here()
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(_LINE):
            raise ValueError("no WARC version line")
        yield here
        size = int({k.lower(): v for k, v in _header_block(stream).items()}.get("content-length", "0"))
        if stream.skip(size) < size:
            raise EOFError("record cut short")


def first_record(raw: BinaryIO, start: int, end: int) -> int | None:
    """Place of the first record of the archive that can be read by itself from [start, end); None if there is none.

    In a gzip archive these are the members that begin with a version line. A place that only looks like one, because the
    payload of a record holds the bytes of an archive, leads to a fault within SURE bytes; a damaged archive may too.
    Then the members are followed from the file's beginning, which settles it. In an uncompressed archive nothing tells a
    record from a copy of one in a payload, so there the headers are always followed from the beginning.
    """
    if start == 0:
        return 0
    if not is_gzip(raw):
        try:
            first = next((here for here in _headers(raw) if here >= start), None)
        except (EOFError, ValueError):
            return None  # damaged before the stretch: reading ended there
        return first if first is not None and first < end else None
    for at in _candidates(raw, _MAGIC, start, end):
        found = _trial(raw, at)
        if found is None:
            try:
                first = _first_after(raw, 0, start)
            except (OSError, EOFError, zlib.error):
                return at
            return first if first is not None and first < end else None
        if found:
            return at
    return None


def _header_block(stream: BinaryIO) -> dict[str, str]:
    headers: dict[str, str] = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        headers[name.strip()] = value.strip()
    return headers


def unchunked(body: bytes) -> bytes:
    """A body sent in chunks, put together. Crawlers often store it that way already: then it stays as it is."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            return body
        if size < 0 or end + 2 + size > len(body):
            return body
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2


def unpacked(body: bytes, coding: str) -> bytes:
    """A gzip or deflate body unpacked; as it is where it turns out to be neither."""
    tries = {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}.get(coding, ())
    for bits in tries:
        try:
            return zlib.decompressobj(bits).decompress(body)
        except zlib.error:
            continue
    return body


def split_http(block: bytes) -> tuple[str, bytes]:
    """Status code and body of an HTTP response, chunks and compression undone; ('', block) if it is none."""
    if not block.startswith(b"HTTP/"):
        return "", block
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    fields = {k.strip().lower(): v.strip().lower().decode("ascii", "replace") for k, _, v in (x.partition(b":") for x in lines[1:])}
    if "chunked" in fields.get(b"transfer-encoding", ""):
        body = unchunked(body)
    for coding in reversed(fields.get(b"content-encoding", "").split(",")):
        body = unpacked(body, coding.strip())
    first = lines[0].split()
    return (first[1].decode("ascii", "replace") if len(first) > 1 else ""), body


def read_records(
    filename: str,
    raw: BinaryIO,
    start: int = 0,
    end: int | None = None,
    wanted: Callable[[str, str, str], bool] | None = None,
) -> Iterator[Record]:
    """All records in order, or those from place ``start`` on that begin before ``end``: the last one is read to its end.

    A damaged file ends with one ``unreadable`` record that names the error; the records before it stay. Records that
    ``wanted`` (type, uri, date) does not want are passed over, their blocks unread.
    """
    try:
        stream = open_stream(raw, start)
        begun = None  # where reading may begin for the record that comes next
        while True:
            here = stream.here()
            begun = begun if here is None else here
            line = stream.readline()
            if not line:
                return
            if not line.strip():
                continue
            if not line.startswith(_LINE):
                raise ValueError("no WARC version line")
            if end is not None and begun is not None and begun >= end:
                return
            begun = None
            headers = _header_block(stream)
            named = {k.lower(): v for k, v in headers.items()}
            size = int(named.get("content-length", "0"))
            kind, uri, date = named.get("warc-type", ""), named.get("warc-target-uri", "").strip("<>"), named.get("warc-date", "")
            if wanted is not None and not wanted(kind, uri, date):
                if stream.skip(size) < size:
                    raise EOFError("record cut short")
                continue
            block = stream.read(size)
            if len(block) < size:
                raise EOFError("record cut short")
            status, payload = split_http(block) if kind == "response" else ("", block)
            yield filename, kind, uri, date, headers, status, payload
    except (OSError, EOFError, ValueError, zlib.error) as e:
        if wanted is None or wanted(UNREADABLE, "", ""):
            yield filename, UNREADABLE, "", "", {"error": f"{type(e).__name__}: {e}"}, "", b""
