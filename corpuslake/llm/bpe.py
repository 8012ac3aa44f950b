"""Byte-pair encoding by automaton: merges become gadgets, words become paths, arc labels become text again."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, StringType, StructField, StructType

from .tasks import utf8

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: Strings and arcs that a worker remembers, in two generations of this size each; a bound on memory alone.
REMEMBERED, ARCS = 100_000, 300_000
#: Rows whose results are Python objects at a time.
SLICE = 256
_ASCII_WORDS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
# Letters that are composed, and have one lower-case letter among themselves, in every version of Unicode.
_LETTERS = "À-ÖØ-öø-įı-ſЀ-џ"
_SIMPLE = re.compile(f"[\x00-\x7f{_LETTERS}]*")
_SIMPLE_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LETTERS}]+|[0-9]|[^a-z0-9{_LETTERS}]+")


def byte_labels() -> list[str]:
    """The printable character that stands for each byte: itself where it prints, else the next one from 256 on."""
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printed else chr(next(rest)) for b in range(256)]


class Automaton:
    """Deterministic automaton over tokens; its paths are the sequences that the merges produce, and no others.

    The state behind an arc depends on the arc's label alone, so states are numbered as tokens are. At first every
    state has an arc for each base symbol. A merge (u, v) in its turn adds a gadget: an arc ``uv`` wherever ``u`` leaves and
    can be followed by ``v``, leading to a copy of the state behind ``v``; and the state behind ``u`` loses its arc ``v``. What
    is copied is kept by reference with the time of copying, so that the whole automaton takes four entries a merge.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        size = max(vocab.values(), default=-1) + 1
        self.width = size
        self.born = array("i", [0]) * size
        self.leaves_like = array("i", [-1]) * size
        self.state_like = array("i", [-1]) * size
        self.closed: dict[int, int] = {}
        self.known: dict[int, bool] = {}
        symbols: dict[int, tuple[int, ...]] = {}
        for b, label in enumerate(byte_labels()):
            for name, symbol in ((label, b), (label + suffix, 256 + b)):
                if name in vocab:
                    symbols[vocab[name]] = (symbol,)
        for time, (left, right) in enumerate(merges, 1):
            u, v, w = vocab[left], vocab[right], vocab[left + right]
            if u in symbols and v in symbols and w not in symbols and self._arc(u, v, 2 * time):
                self.born[w], self.leaves_like[w], self.state_like[w] = time, u, v
                self.closed[u * size + v] = 2 * time
                symbols[w] = symbols[u] + symbols[v]
        self.length = array("i", [0]) * size
        self.spellings = ahocorasick.Automaton()
        for t, path in symbols.items():
            self.length[t] = len(path)
            self.spellings.add_word("".join(map(chr, path)), t)
        self.spellings.make_automaton()

    def _arc(self, state: int, label: int, now: int) -> bool:
        """Whether the state behind ``state`` has the arc ``label`` before the time ``now``.

        Of the two the younger is traced back to what it was copied from: an arc to its first part once its own gadget is
        in place, a state to that of its last part just before.
        """
        closed, born, size = self.closed, self.born, self.width
        while True:
            if closed.get(state * size + label, now) < now:
                return False
            if born[label] >= born[state]:
                if not born[label]:
                    return True
                now, label = min(now, 2 * born[label] + 1), self.leaves_like[label]
            else:
                now, state = min(now, 2 * born[state]), self.state_like[state]

    def arc(self, state: int, label: int) -> bool:
        key = state * self.width + label
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= ARCS:
                self.known.clear()
            found = self.known[key] = self._arc(state, label, 1 << 62)
        return found

    def path(self, word: bytes) -> array:
        """The labels of the one path that spells the word.

        One run over the word finds where arcs are spelled. At every place just one of those that end there goes on from the
        path to where it begins; so time and memory grow with the length alone.
        """
        n = len(word)
        spelled = word[:-1].decode("latin-1") + chr(256 + word[-1])
        ends = array("i", [-1]) * n
        known, size, length, done = self.known.get, self.width, self.length, -1
        for end, label in self.spellings.iter(spelled):
            if end == done:
                continue
            before = end - length[label]
            if before >= 0:
                state = ends[before]
                there = known(state * size + label)
                if there is None:
                    there = state >= 0 and self.arc(state, label)
                if not there:
                    continue
            ends[end], done = label, end
        out, at = array("I"), n - 1
        while at >= 0:
            if ends[at] < 0:
                raise ValueError("the vocabulary lacks a byte")
            out.append(ends[at])
            at -= length[ends[at]]
        out.reverse()
        return out


class _Remembered(dict):
    """What ``make`` gives, kept for the keys asked for of late."""

    def __init__(self, make) -> None:
        self.make, self.before = make, {}

    def __missing__(self, key):
        found = self.before.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[key] = found
        return found


class Coder:
    """Encoder of one vocabulary file, its text splitting as the file says."""

    def __init__(self, written: str) -> None:
        from tokenizers import Tokenizer

        content = json.loads(written)
        model = content["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        library = Tokenizer.from_str(written)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.special = {a["content"].encode(): a["id"] for a in content["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile(b"(" + b"|".join(map(re.escape, longest_first)) + b")") if self.special else None
        self.to_byte = str.maketrans({label: chr(b) for b, label in enumerate(byte_labels())})
        self.words = _Remembered(lambda word: self.automaton.path(word).tobytes())
        self.strings = _Remembered(self._string)

    def _string(self, string: bytes) -> bytes:
        """Ids of a string without ASCII white space."""
        if string.isalpha():  # ASCII letters alone
            return self.words[string.lower()]
        if self.cut is None or b"<" not in string:
            return self._plain(string)
        out = []
        for part in self.cut.split(string):
            out.append(array("I", [self.special[part]]).tobytes() if part in self.special else self._plain(part))
        return b"".join(out)

    def _plain(self, string: bytes) -> bytes:
        words = self.words
        if string.isascii():
            found = _ASCII_WORDS.findall(string.lower())
        else:
            text = string.decode("utf-8", "replace")
            if _SIMPLE.fullmatch(text):
                found = [w.encode() for w in _SIMPLE_WORDS.findall(text.lower())]
            else:
                pieces = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
                found = [w.translate(self.to_byte).encode("latin-1") for w, _ in pieces]
        if len(found) == 1 and len(found[0]) < 64:
            return words[found[0]]
        return b"".join([words[w] if len(w) < 64 else words.make(w) for w in found])

    def encode(self, text: bytes) -> bytes:
        """Ids of a text as packed unsigned 32-bit integers. Nothing reaches across ASCII white space."""
        strings = self.strings
        return b"".join([strings[s] if len(s) < 64 else strings.make(s) for s in text.split()])


class Labels:
    """The arc labels of one vocabulary file, special tokens included, by id."""

    def __init__(self, written: str) -> None:
        content = json.loads(written)
        labels = {i: t for t, i in content["model"]["vocab"].items()} | {a["id"]: a["content"] for a in content["added_tokens"]}
        self.labels = [labels.get(i) for i in range(max(labels) + 1)]

    def decode(self, ids: bytes) -> str:
        labels, last = self.labels, len(self.labels)
        found = np.frombuffer(ids, "<u4")
        if len(found) and int(found.max()) >= last:
            found = found[found < last]
        return " ".join([x for x in map(labels.__getitem__, found.tolist()) if x is not None])


_COMPILED: dict[tuple, Coder | Labels] = {}


def _compiled(kind, written):
    """The coder or the labels of this worker, made once, whatever the number of tasks."""
    key = kind, hash(written.value)
    if key not in _COMPILED:
        if len(_COMPILED) > 1:
            _COMPILED.clear()
        _COMPILED[key] = kind(written.value)
    return _COMPILED[key]


def _written(spark, vocabulary: str):
    with open(vocabulary, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _mapped(rows: DataFrame, source: str, keep: Sequence[str], names: list[str], kinds: list[DataType], make) -> DataFrame:
    """The columns ``keep`` of ``rows`` with further ones of these names, which ``make`` gives for a stretch of the column ``source``.

    Batches are handed on SLICE rows at a time, so that a task holds little more than the batch it has been given.
    """
    taken = {n.lower() for n in names}
    kept = [c for c in keep if c.lower() not in taken]
    form = StructType([*[rows.schema[c] for c in kept], *[StructField(n, k) for n, k in zip(names, kinds, strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *make(part.column(0))], names=form.names)

    return rows.select(F.col(f"`{source}`").alias("__source"), *[F.col(f"`{c}`") for c in kept]).mapInArrow(run, form)


def encode(
    docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, ids: str = "ids", decoded: str | None = None, keep: Sequence[str] | None = None
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with a binary column ``ids``: the whole text's token ids, 32 bits each,
    lowest byte first. With ``decoded`` a column of that name holds what ``decode`` makes of the ids.

    Texts are normalised and split into words as the vocabulary file says (a ``tokenizers`` file whose model is byte-level
    BPE with a word end); special tokens in a text are tokens. NULL, empty and blank texts have no ids. Equal texts
    have equal ids. Columns of the input that are named like new ones are replaced. The file is read by the driver.
    """
    written = _written(docs.sparkSession, vocabulary)

    def coded(texts: pa.Array) -> list[pa.Array]:
        packed = list(map(_compiled(Coder, written).encode, utf8(texts)))
        out = [pa.array(packed, pa.binary())]
        if decoded is not None:
            out.append(pa.array(list(map(_compiled(Labels, written).decode, packed)), pa.string()))
        return out

    names, kinds = [ids, *([decoded] if decoded is not None else [])], [BinaryType(), StringType()]
    return _mapped(docs, text, docs.columns if keep is None else keep, names, kinds[: len(names)], coded)


def decode(rows: DataFrame, ids: str = "ids", vocabulary: str = VOCABULARY, text: str = "decoded") -> DataFrame:
    """``rows`` with ``decoded``: the labels of the ids, special tokens too, with a blank between them, as a file without
    a decoder has it. NULL is empty; ids outside the vocabulary are left out."""
    written = _written(rows.sparkSession, vocabulary)

    def read(packed: pa.Array) -> list[pa.Array]:
        one = _compiled(Labels, written).decode
        return [pa.array([one(x or b"") for x in packed.to_pylist()], pa.string())]

    return _mapped(rows, ids, rows.columns, [text], [StringType()], read)


def unpacked(ids: Column) -> Column:
    """The ids as an array of longs."""
    each = F.sequence(F.lit(0), (F.length(ids) / 4).cast("int") - 1)
    byte = lambda i, k: F.conv(F.hex(F.substring(ids, i * 4 + k + 1, F.lit(1))), 16, 10).cast("long")
    number = lambda i: byte(i, 0) + byte(i, 1) * 256 + byte(i, 2) * 65536 + byte(i, 3) * 16777216
    return F.when(F.length(ids) > 0, F.transform(each, number)).otherwise(F.array().cast("array<long>"))
