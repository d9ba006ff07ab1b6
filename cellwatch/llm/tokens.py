"""Token ids of whole texts by the tokenizers library, one encoding per distinct word.

The byte-level pre-tokenizer always breaks before white space that follows
other characters, and looks no further back. So a text can be cut there, each
piece encoded on its own, and the ids joined; the result is that of encoding
the whole text. Words recur, so the ids of a piece are remembered, and new
pieces are encoded many at a time, one per line: a line break between two
pieces is a token of its own. Pieces are cut, told apart and put together as
arrays; Python handles each distinct piece of a group of texts once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are only cut before these, and never after other white space.
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\x0b\x0c\r")] = True
# In UTF-8 the byte before the last one of all other white space.
_UNSURE = np.zeros(256, bool)
_UNSURE[[0xC2, 0x80, 0x81, 0x9A]] = True
# Pieces that stay what they are after a line break.
_PLAIN = re.compile(r" ?[^\s<]+")
_BROKEN = re.compile(r"\n[^\s<]+")
_REMEMBERED = 600_000
_LONGEST_PIECE = 64
_LINES = 500
_DOCUMENTS = 2_000
_CHARACTERS = 1_000_000


def _strings(column: pa.LargeStringArray) -> list[str]:
    """The strings of a column, cut out of one long string; a piece that has the separator in it is rare."""
    if column.nbytes >= 1 << 30:
        return column.to_pylist()
    lists = pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column.cast(pa.string()))
    whole = pc.binary_join(lists, "\0")[0].as_py()
    found = whole.split("\0")
    return found if len(found) == len(column) else column.to_pylist()


class _Encoder:
    """Ids by piece, in two generations: a full one makes way, and what is used again stays."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        breaks = self.tokenizer.encode("a\nb", add_special_tokens=False).ids
        self.line_break = breaks[1] if len(breaks) == 3 else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Remember new pieces; returns those that are too long to be kept."""
        known, older, long = self.known, self.older, {}
        # What starts with a line break is a line without it.
        plain: list[str] = []
        broken: list[str] = []
        for p in pieces:
            ids = older.get(p) if older else None
            if ids is not None:
                known[p] = ids
            elif len(p) > _LONGEST_PIECE:
                long[p] = self.whole(p)
            elif self.line_break is not None and _PLAIN.fullmatch(p):
                plain.append(p)
            elif self.line_break is not None and _BROKEN.fullmatch(p):
                broken.append(p)
            else:
                known[p] = self.whole(p)
        line_break = np.array([self.line_break or 0], "<u4").tobytes()
        for some, skipped, before in ((plain, 0, b""), (broken, 1, line_break)):
            for i in range(0, len(some), _LINES):
                group = some[i : i + _LINES]
                done = self.tokenizer.encode_batch_fast(["\n".join([p[skipped:] for p in group])], add_special_tokens=False)[0]
                ids = np.array(done.ids, dtype="<u4")
                cuts = (4 * np.flatnonzero(ids == self.line_break)).tolist()
                raw = ids.tobytes()
                if len(cuts) != len(group) - 1:
                    known.update((p, self.whole(p)) for p in group)
                    continue
                known.update(zip(group, [before + raw[a:b] for a, b in zip([0, *[c + 4 for c in cuts]], [*cuts, len(raw)])]))
        return long

    def many(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) >= _REMEMBERED:
            self.older, self.known = self.known, {}
        column = pa.array([t or "" for t in texts], pa.large_string())
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int64)[: len(texts) + 1]
        if not ends[-1]:
            return [b""] * len(texts)
        raw = np.frombuffer(data, np.uint8)[: ends[-1]]
        blank = _BLANK[raw]
        first = np.zeros(len(raw), bool)
        first[1:] = blank[1:] & ~blank[:-1]
        after = np.flatnonzero(first)
        first[after[(raw[after - 1] > 127) & _UNSURE[raw[after - 2]]]] = False
        first[ends[:-1][ends[:-1] < ends[1:]]] = True
        starts = np.flatnonzero(first)
        cuts = pa.py_buffer(np.append(starts, len(raw)).astype(np.int64))
        pieces = pa.LargeStringArray.from_buffers(len(starts), cuts, data).dictionary_encode()
        distinct, known = _strings(pieces.dictionary), self.known
        long = self._learn(set(distinct).difference(known))
        ids = pa.array([long[p] if p in long else known[p] for p in distinct] if long else list(map(known.__getitem__, distinct)), pa.large_binary())
        joined = ids.take(pieces.indices)
        _, offsets, data = joined.buffers()
        at = np.frombuffer(offsets, np.int64)[np.searchsorted(starts, ends)].tolist()
        out = memoryview(data) if data is not None else b""
        return [bytes(out[a:b]) for a, b in zip(at, at[1:])]


_LOADED: dict[str, _Encoder] = {}


def encoded(path: str, texts: Iterable[str | None]) -> Iterator[bytes]:
    """Ids of every text (None: empty) as little-endian unsigned 32-bit bytes, in order.

    ``path`` is a byte-level BPE file without normaliser and without prefix space.
    """
    if path not in _LOADED:
        _LOADED[path] = _Encoder(path)
    encoder, waiting, size = _LOADED[path], [], 0
    for t in texts:
        waiting.append(t)
        size += len(t or "")
        if len(waiting) == _DOCUMENTS or size >= _CHARACTERS:
            yield from encoder.many(waiting)
            waiting, size = [], 0
    if waiting:
        yield from encoder.many(waiting)
