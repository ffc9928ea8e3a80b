"""Token ids of whole texts by a public tokenizer, a unit of text at a time.

The tokenizers library encodes each distinct unit once per worker; a text is put together from
its units, for a batch of texts at once. That gives the ids of encoding it whole, because neither
tokenizer joins characters across the cuts used here; a text where that is not certain is encoded
whole. Units are told apart by a 64-bit hash and their length.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import bound_batches, mix, slices, span_hashes, text_bytes, text_of, word_spans, worker_state
from tickloom.session import materialise

# Units that a worker keeps, in two generations.
MOST_UNITS = 800_000
_TOGETHER = 256
BATCH_BYTES = 4 << 20


_STOPS, _LETTERS = np.zeros(256, bool), np.zeros(256, bool)
_STOPS[[0x2C, 0x2E]] = True
_LETTERS[[*range(65, 91), *range(97, 123)]] = True


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers ``begin, begin + 1, ...``, ``length`` of them, for every pair."""
    ends = np.cumsum(length)
    out = np.arange(ends[-1] if len(ends) else 0)
    return out + np.repeat(begin - (ends - length), length)


class Units:
    """What a worker knows: unit hashes, sorted, and the place of each unit in one array of ids."""

    def __init__(self):
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.begin, self.length = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)
        self.ids, self.n, self.used = np.zeros(1 << 14, np.uint16), 0, 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Store the ids of units, one behind the other; returns their places."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n + len(sizes) > len(self.begin):
            self.begin, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.length))
        places = np.arange(self.n, self.n + len(sizes))
        self.ids[self.used : self.used + len(ids)] = ids
        self.begin[places], self.length[places] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used, self.n = self.used + len(ids), self.n + len(sizes)
        return places

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids at some places, one behind the other, and how many each has."""
        sizes = self.length[places].astype(np.int64)
        return self.ids[_ranges(self.begin[places], sizes)], sizes

    def name(self, hashes: np.ndarray, places: np.ndarray) -> None:
        """Remember where the units of some hashes, none of them known, are."""
        keys, at = np.concatenate([self.keys, hashes]), np.concatenate([self.at, places])
        order = np.argsort(keys, kind="stable")
        self.keys, self.at = keys[order], at[order]

    def known(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(hashes), -1)
        spot = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[spot] == hashes, self.at[spot], -1)


class UnitEncoder:
    """Base of the two tokenizers: how to cut texts, and how to encode many units at once."""

    most_units = MOST_UNITS

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Contents of added tokens, which the library takes for one id wherever they stand.
        self.markers = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values() if token.content]
        if self.tokenizer.get_vocab_size() > 65536:
            raise ValueError("token ids are kept in 16 bits")
        self.units, self.before = Units(), Units()
        self.stops = np.zeros(256, np.uint16)
        (self.stops[0x2C],), (self.stops[0x2E],) = self.each([",", "."])

    def each(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint16) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, one behind the other, and how many each has."""
        coded = self.each(texts)
        return np.concatenate([np.zeros(0, np.uint16), *coded]), np.array([len(c) for c in coded], np.int64)

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of every unit, the number of units before each text, and which texts need encoding whole."""
        raise NotImplementedError

    #: What stands between units that are encoded together.
    between = b""

    def plain(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which units may be encoded together with others."""
        raise NotImplementedError

    def parted(self, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of ``n`` units encoded together, one behind the other, and how many each has; None if that is not certain."""
        raise NotImplementedError

    def places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the ids of each unit are; units not known are encoded.

        There are two generations. A full one becomes the old one, from which units are taken over
        when they come again; so frequent units are never encoded twice.
        """
        hashes = self._hashes(data, starts, ends)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        found = self.units.known(distinct)
        if len(self.units.keys) + 2 * (found < 0).sum() > self.most_units // 2:
            self.before, self.units = self.units, Units()
            found[:] = -1
        missing = np.flatnonzero(found < 0)
        old = self.before.known(distinct[missing])
        there = missing[old >= 0]
        found[there] = self._store(distinct[there], *self.before.of(old[old >= 0]))
        new = missing[old < 0]
        if len(new):
            new = new[np.argsort(first[new])]
            found[new] = self._learn(data, starts[first[new]], ends[first[new]], distinct[new])
        return found[back]

    def _store(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        places = self.units.add(ids, sizes)
        self.units.name(hashes, places)
        return places

    def _mark(self, data: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> None:
        """Texts with a marker in them are encoded whole."""
        raw = data.tobytes()
        for marker in self.markers:
            at = raw.find(marker)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, "right")) - 1
                odd[text] |= at + len(marker) <= offsets[text + 1]
                at = raw.find(marker, at + 1)

    @staticmethod
    def _hashes(data, starts, ends):
        return mix(span_hashes(data, starts, ends) + (ends - starts).astype(np.uint64))

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Encode distinct units; a comma or full stop behind a letter is a token of its own."""
        stop = (ends - starts > 2) & _STOPS[data[ends - 1]] & _LETTERS[data[ends - 2]]
        bases = self._hashes(data, starts[stop], ends[stop] - 1)
        wanted, at = np.unique(bases, return_index=True)
        own = (self.units.known(wanted) < 0) & ~np.isin(wanted, hashes[~stop])
        at = np.flatnonzero(stop)[at[own]]
        starts_, ends_ = np.concatenate([starts[~stop], starts[at]]), np.concatenate([ends[~stop], ends[at] - 1])
        self._encode_units(data, starts_, ends_, np.concatenate([hashes[~stop], wanted[own]]))
        ids, sizes = self.units.of(self.units.known(bases))
        # Every base with one more place for the mark behind it.
        composed = np.insert(ids, np.cumsum(sizes), self.stops[data[ends[stop] - 1]])
        self._store(hashes[stop], composed, sizes + 1)
        return self.units.known(hashes)

    def _encode_units(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        # The units alone, side by side: the rest of the texts is not looked at.
        sizes = ends - starts
        data = data[_ranges(starts, sizes)]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        plain = self.plain(data, starts, ends)
        alone, plain = np.flatnonzero(~plain), np.flatnonzero(plain)
        # The plain ones with what parts them, a group to a text.
        sizes = sizes[plain] + len(self.between)
        stops = np.cumsum(sizes)
        joined = np.empty(stops[-1] if len(stops) else 0, np.uint8)
        joined[_ranges(stops - sizes, sizes - len(self.between))] = data[_ranges(starts[plain], sizes - len(self.between))]
        for k, byte in enumerate(self.between):
            joined[stops - len(self.between) + k] = byte
        raw = joined.tobytes()
        edges = [0, *stops[_TOGETHER - 1 : -1 : _TOGETHER].tolist(), *stops[-1:].tolist()]
        texts = [raw[a : b - len(self.between)].decode() for a, b in zip(edges, edges[1:])]
        done = [(np.zeros(0, np.uint64), np.zeros(0, np.uint16), np.zeros(0, np.int64))]
        for k, coded in enumerate(self.each(texts)):
            group = plain[k * _TOGETHER : (k + 1) * _TOGETHER]
            parts = self.parted(coded, len(group))
            if parts is None:
                alone = np.concatenate([alone, group])
            else:
                done.append((hashes[group], *parts))
        if len(alone):
            done.append((hashes[alone], *self.whole([data[a:b].tobytes().decode() for a, b in zip(starts[alone].tolist(), ends[alone].tolist())])))
        self._store(*map(np.concatenate, zip(*done, strict=True)))

    def encode(self, texts: pa.Array, end: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by ``end``, and where each text's ids begin."""
        data, offsets = text_bytes(texts)
        starts, ends, before, odd = self.cut(data, offsets)
        self._mark(data, offsets, odd)
        doc = np.repeat(np.arange(len(texts)), np.diff(before))
        keep = ~odd[doc]
        place = self.places(data, starts[keep], ends[keep])
        units = self.units
        counts = np.bincount(doc[keep], minlength=len(texts))
        base, base_n = units.used, units.n  # what is added from here on is dropped again
        strange = np.flatnonzero(odd)
        ids, sizes = self.whole([texts[int(i)].as_py() for i in strange])
        extra = units.add(np.append(ids, np.array(end, np.uint16)), np.append(sizes, len(end)))
        at = np.cumsum(counts)
        # Behind the units of a text come its ids as a whole, if it has such, and the end.
        spots = np.concatenate([at[strange], at])
        values = np.concatenate([extra[:-1], np.full(len(at), extra[-1])])
        order = np.argsort(np.concatenate([strange, np.arange(len(at))]), kind="stable")
        place = np.insert(place, spots[order], values[order])
        sizes = units.length[place]
        ids = units.ids[_ranges(units.begin[place], sizes)]
        heads = np.append(0, np.cumsum(sizes, dtype=np.int64))
        texts_at = counts + 1 + odd
        begins = heads[np.append(0, np.cumsum(texts_at))]
        units.used, units.n = base, base_n
        return ids, begins


_BREAKS = np.zeros(256, bool)
_BREAKS[[0x20, 0x0A]] = True
_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
_WIDE_SPACE = np.zeros(65536, bool)
_WIDE_SPACE[[0xC285, 0xC2A0, 0xE19A, 0xE280, 0xE281, 0xE380]] = True
_SPACE_80 = np.zeros(256, bool)
_SPACE_80[[*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF]] = True


class ByteEncoder(UnitEncoder):
    """Byte-level BPE: a space belongs to the word behind it, other white space stands apart.

    A unit begins at every space and line feed. A run of white space gives all but its last
    character to one token, so a text is encoded whole if a unit begins inside such a run.
    """

    def __init__(self, path: str):
        super().__init__(path)
        self.opens = np.zeros(65536, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.opens[number] = token[0] in "ĠĊ"  # space and line feed, as this vocabulary writes them

    def cut(self, data, offsets):
        breaks = _BREAKS[data]
        at = np.flatnonzero(breaks)
        one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
        after_space = _ASCII_SPACE[one]
        wide = one >= 0x80
        if wide.any():  # white space beyond ASCII
            after_space |= wide & (
                ((two == 0xC2) & ((one == 0xA0) | (one == 0x85)))
                | ((three == 0xE2) & (((two == 0x80) & _SPACE_80[one]) | ((two == 0x81) & (one == 0x9F))))
                | ((three == 0xE3) & (two == 0x80) & (one == 0x80)) | ((three == 0xE1) & (two == 0x9A) & (one == 0x80)))
        doc = np.searchsorted(offsets, at, "right") - 1
        after_space &= at > offsets[doc]
        odd = np.zeros(len(offsets) - 1, bool)
        odd[doc[after_space]] = True
        begins = offsets[:-1][np.diff(offsets) > 0]
        breaks[begins] = True
        starts = np.flatnonzero(breaks)
        return starts, np.append(starts[1:], len(data))[: len(starts)], np.searchsorted(starts, offsets), odd

    def plain(self, data, starts, ends):
        """Units that begin with their space and have no other; two bytes tell white space beyond ASCII, and some that is none."""
        space = _ASCII_SPACE[data]
        space[:-1] |= _WIDE_SPACE[(data[:-1].astype(np.uint16) << np.uint16(8)) | data[1:]]
        before = np.concatenate([[0], np.cumsum(space)])
        return _BREAKS[data[starts]] & (ends - starts > 1) & (before[ends] - before[starts] == 1)

    def parted(self, ids, n):
        begin = np.flatnonzero(self.opens[ids])
        return (ids, np.diff(np.append(begin, len(ids)))) if len(begin) == n and begin[0] == 0 else None


class WordEncoder(UnitEncoder):
    """BPE with word ends: white space parts words and carries no ids.

    A unit is what stands between ASCII white space. Units without the digit 0 are encoded many
    at once with a lone 0 between them.
    """

    def __init__(self, path: str):
        super().__init__(path)
        (self.mark,) = self.tokenizer.encode("0", add_special_tokens=False).ids

    def cut(self, data, offsets):
        starts, ends, before = word_spans(data, offsets)
        return starts, ends, before, np.zeros(len(offsets) - 1, bool)

    between = b" 0 "

    def plain(self, data, starts, ends):
        before = np.concatenate([[0], np.cumsum(data == 0x30)])
        return before[ends] == before[starts]

    def parted(self, ids, n):
        marks = np.flatnonzero(ids == self.mark)
        if len(marks) != n - 1:
            return None
        return np.delete(ids, marks), np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1


def tokenize(docs: DataFrame, path: str, kind: type[UnitEncoder], end_id: int, columns: list[str]) -> DataFrame:
    """``columns``, ``row`` (a number for the row), ``ids`` (16 bits each, end id included) and ``n_tokens``, stored.

    Each text is encoded once; all that follows reads the stored ids. A null text is empty and
    has the end id alone.
    """
    bound_batches(docs.sparkSession)

    def encode(batches):
        encoder = worker_state(f"encoder {kind.__name__} {path}", lambda: kind(path))
        for whole in batches:
            for batch in slices(whole, "_text", BATCH_BYTES):
                ids, begins = encoder.encode(batch.column("_text"), [end_id])
                offsets = pa.py_buffer((2 * begins).astype(np.int32).tobytes())
                coded = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, offsets, pa.py_buffer(ids.astype("<u2").tobytes())])
                rest = [batch.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays([*rest, coded, pa.array(np.diff(begins))], [*columns, "ids", "n_tokens"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema.fields)
    coded = docs.select(*columns, text_of().alias("_text")).mapInArrow(encode, f"{kinds}, ids binary, n_tokens long")
    return materialise(coded.withColumn("row", F.monotonically_increasing_id()), "tokens")


def ids_crc32(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
