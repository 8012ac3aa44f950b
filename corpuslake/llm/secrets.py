"""Secret scans: fixed patterns, and strings in sensitive context that a primed compressor finds new."""

from __future__ import annotations

import re
from functools import cache
from random import Random
from statistics import median

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .columns import without
from .tasks import utf8

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
# The same on bytes, to pass over texts that have none.
HEX_RAW = re.compile(rb"[0-9a-f]{32}")
CANDIDATE_RAW = re.compile(rb"[A-Za-z0-9+/_=-]{16}")
_HINT = re.compile(rb"passw|secret|token|api_?key", re.IGNORECASE)

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SENSITIVE = re.compile(r"passw|pwd|secret|token|credential|bearer|auth|private|access|api|key|signature|login", re.IGNORECASE | re.ASCII)
#: Characters before a candidate that make up its context, and on both sides that prime the compressor.
NEAR, AROUND = 40, 2000
#: Share of the new bytes of a random string of the same alphabet and length from which a candidate counts as incompressible.
NOVEL = 0.85
#: Random strings drawn to see what such strings need, and their greatest length.
DRAWS, LONG = 15, 512
#: From few characters to many: hexadecimal, base 32, base 36, letters and digits.
ALPHABETS = (
    "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyz234567",
    "0123456789abcdefghijklmnopqrstuvwxyz", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
)
#: What may stand between the lines of a key: white space, quotes, signs of continuation.
ADJOINS = re.compile(r"""[\s"'\\+,;|>#*]+""")
#: Names that occur in ordinary code; strings made of them are not news.
IDENTIFIERS = (
    "access address admin api application args array async await auth authorization base64 bearer boolean bucket "
    "buffer bytes callback certificate class client config connection const content context cookie credential data "
    "database default delete description development directory document double element encoding endpoint env error "
    "event exception export false file filename final float format function handler hash header host http https id "
    "identifier import index init input instance int integer interface internal json key length level list local "
    "localhost log login long main manager map message method model module name namespace node null number object "
    "option output package parameter parse password path port prefix private process production property protected "
    "protocol provider public query random read record reference region register request resource response result "
    "return root schema secret self server service session settings signature size source static status storage "
    "string struct style system table task template test text thread time timeout timestamp title token true type "
    "undefined update upload url user username uuid value variable version view void width window write www com org "
    "the and for with that this from not are was abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 "
    "1234567890 xxxxxxxxxxxxxxxx 0000000000000000 ________________ ---------------- ================"
)


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in characters."""
    found = []
    if _HINT.search(raw):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if HEX_RAW.search(raw):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def press(around: str):
    """Bytes that a string adds to a compressed stream primed with identifiers and the text around it, as a function."""
    import zstandard

    prime = f"{IDENTIFIERS} {around}".encode()
    known = zstandard.ZstdCompressionDict(prime, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    stream = zstandard.ZstdCompressor(level=19, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)
    empty = len(stream.compress(b""))
    return lambda piece: len(stream.compress(piece.encode())) - empty


def alphabet(word: str) -> str:
    """The least usual alphabet that has the word's letters and digits, with the marks that stand in it."""
    marks = set(word) - set(ALPHABETS[-1])
    plain = set(word) - marks
    return next(a for a in ALPHABETS if plain <= set(a)) + "".join(sorted(marks))


@cache
def _drawn(letters: str, n: int) -> float:
    draw, need = Random(f"{letters} {n}"), press("")
    return median(need("".join(draw.choices(letters, k=n))) for _ in range(DRAWS))


def random_bytes(letters: str, n: int) -> float:
    """New bytes that a random string of n letters needs: the median of some, and in proportion above LONG letters."""
    return _drawn(letters, min(n, LONG)) * max(n, LONG) / LONG


def is_novel(word: str, around: str) -> bool:
    """Whether the word needs about as many new bytes as a random string of its alphabet and length."""
    return press(around)(word) >= NOVEL * random_bytes(alphabet(word), len(word))


def _mixed(word: str) -> bool:
    return any(c.isdigit() for c in word) and any(c.isalpha() for c in word)


def novel_spans(text: str, raw: bytes, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates with letters and digits, apart from the base spans, near a sensitive word, that hardly compress.

    A candidate that adjoins a sensitive one, as the next line of a key does, is sensitive too. Candidates do not
    prime the compressor: a copy of a secret does not make it known.
    """
    if not CANDIDATE_RAW.search(raw) or not SENSITIVE.search(text):
        return []
    found, clean, upto, near = [], None, 0, False
    for m in CANDIDATE.finditer(text):
        word, start, end = m.group(), m.start(), m.end()
        taken = any(s < end and start < e for s, _, e in base)
        carried = near and ADJOINS.fullmatch(text, upto, start)
        near = bool(carried or taken or SENSITIVE.search(text[max(0, start - NEAR) : start]))
        upto = end
        if taken or not near or not _mixed(word):
            continue
        if clean is None:
            clean = CANDIDATE.sub(lambda c: " " * len(c.group()) if _mixed(c.group()) else c.group(), text)
        if is_novel(word, clean[max(0, start - AROUND) : start] + clean[end : end + AROUND]):
            found.append((start, 3, end))
    return found


def spans_of(raw: bytes) -> list[tuple[int, int, int]]:
    """All spans of a text, by start, then kind."""
    text = raw.decode("utf-8", "replace")
    base = base_spans(text, raw)
    return sorted(base + novel_spans(text, raw, base))


SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())]))


@F.arrow_udf(SPANS)
def _scan(texts: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans_of(t)] for t in utf8(texts)], kind)


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: spans of the whole text (kind, start, end in characters, end exclusive).

    Kinds: ``assign`` (a value given to a name that says secret), ``access`` (access key ids), ``hex`` (long hexadecimal
    strings) by fixed patterns; ``novel``: strings of letters and digits near a sensitive word, or adjoining such a
    string, for which a compressor that knows common identifiers and the text around needs about as many new bytes
    as for a random string of the same alphabet and length.
    NULL and empty texts have none.
    """
    rows = docs.withColumn("__spans", _scan.asNondeterministic()(F.col(f"`{text}`")))
    return without(rows, ["secrets"]).withColumnRenamed("__spans", "secrets")


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
