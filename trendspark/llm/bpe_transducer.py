"""Byte-level BPE of a rank file as a transducer, and streaming decoding.

A sequence of tokens is the encoding of its bytes exactly if every two neighbours are the encoding of
theirs: merges never look past the pair in which the first wrong one would happen. So
after each byte of a unit one token ends the encoding of what was read, and a machine
that holds, for every place where a longer token may still have begun, the trie node reached from
there and the tokens up to it, reads a unit byte by byte. What all these possibilities have
in common is final and written at once, the rest is held back; a possibility lasts as
long as its trie path, so nothing is held for longer than the longest token.

The sets of possibilities, with the held tokens, are the states of the determinised
transducer. They are compiled when they are first reached, and thrown away beyond a bound.
"""

from __future__ import annotations

import base64
import gc
import struct
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import batch_of, map_arrow, slices

# bounds of the tables of a worker; a table beyond its bound is begun anew, that of units after two
MAX_STATES = 200_000
MAX_PAIRS = 300_000
MAX_UNITS = 300_000
MAX_UNIT_LENGTH = 48
# token ids that are decoded at a time
CHUNK = 1 << 16
_NEVER = 1 << 62


def read_ranks(path: str) -> list[bytes]:
    """The bytes of each token of a rank file, by id; ids without a token are empty."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks.get(i, b"") for i in range(max(ranks) + 1)]


def merge(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE as it is defined: the pair of least rank, the first of equal ones, is merged until none is left."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        found = [ranks.get(a + b, -1) for a, b in zip(parts, parts[1:], strict=False)]
        least = min((r for r in found if r >= 0), default=-1)
        if least < 0:
            break
        at = found.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def history(data: bytes, ranks: dict[bytes, int]) -> list[tuple[int, bytes, bytes]]:
    """The rank of each merge of ``data`` in order, with the first and the last part that stood before it; then no rank."""
    parts, steps = [data[i : i + 1] for i in range(len(data))], []
    while len(parts) > 1:
        found = [ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        least = min(found)
        if least == _NEVER:
            break
        steps.append((least, parts[0], parts[-1]))
        at = found.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    steps.append((_NEVER, parts[0], parts[-1]))
    return steps


class State(dict):
    """A set of possibilities ``(held tokens, token before, trie node)``; its items are the steps compiled so far.

    A step leads from a byte to the next state, or to that and what is written on the way.
    """

    __slots__ = ("possible",)

    def __init__(self, possible: tuple[tuple[tuple[int, ...], int, int], ...]):
        self.possible = possible


class Transducer:
    """Units of bytes to token ids, by states that are compiled as they are met."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ranks = {t: i for i, t in enumerate(tokens) if t}
        self.written = [struct.pack("<I", i) for i in range(len(tokens))]
        if any(bytes((b,)) not in self.ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has a token for every byte")
        self.children: dict[int, int] = {}
        self.token_at = [-1]
        self.inner = [True]
        self.alone = set()  # tokens that their own bytes do not merge to: only a whole unit is one
        for token, rank in self.ranks.items():
            if merge(token, self.ranks) == [rank]:
                self._insert(token, rank)
            else:
                self.alone.add(token)
        self.pairs: dict[int, bool] = {}
        self.histories: dict[int, list[tuple[int, bytes, bytes]]] = {}
        self._forget()

    def _insert(self, token: bytes, rank: int) -> None:
        node = 0
        for byte in token:
            self.inner[node] = True
            key = node << 8 | byte
            if key not in self.children:
                self.children[key] = len(self.token_at)
                self.token_at.append(-1)
                self.inner.append(False)
            node = self.children[key]
        self.token_at[node] = rank

    def _forget(self) -> None:
        self.states: dict[tuple, State] = {}
        self.start = self._state((((), -1, 0),))

    def _state(self, possible: tuple) -> State:
        if possible not in self.states:
            self.states[possible] = State(possible)
        return self.states[possible]

    def _history(self, token: int) -> list[tuple[int, bytes, bytes]]:
        if token not in self.histories:
            self.histories[token] = history(self.tokens[token], self.ranks)
        return self.histories[token]

    def _follows(self, before: int, token: int) -> bool:
        """Whether the two tokens are the encoding of their bytes."""
        if before < 0:
            return True
        key = before << 32 | token
        if key not in self.pairs:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            self.pairs[key] = self._keep_apart(before, token)
        return self.pairs[key]

    def _keep_apart(self, before: int, token: int) -> bool:
        """Run the merges of both by rank, the left one's first; no pair across may ever be next."""
        left, right, ranks = self._history(before), self._history(token), self.ranks
        i = j = 0
        while True:
            (one, _, end), (other, begin, _) = left[i], right[j]
            across = ranks.get(end + begin, _NEVER)
            if across < one and across <= other and across != _NEVER:
                return False
            if one <= other:
                if one == _NEVER:
                    return True
                i += 1
            else:
                j += 1

    def _step(self, state: State, byte: int) -> State | tuple[State, bytes]:
        """Compile a step: the state after the byte and the tokens that are final by then."""
        children, possible, ended = self.children, [], None
        for held, before, node in state.possible:
            child = children.get(node << 8 | byte)
            if child is None:
                continue
            if self.inner[child]:
                possible.append((held, before, child))
            if ended is None:
                token = self.token_at[child]
                if token >= 0 and self._follows(before, token):
                    ended = (*held, token), token, 0
        possible.append(ended)
        # what all have in common is written; the order is that of the places where they began
        first = possible[0][0]
        shared = len(first)
        for held, _, _ in possible:
            while held[:shared] != first[:shared]:
                shared -= 1
        if shared:
            out = b"".join(map(self.written.__getitem__, first[:shared]))
            rest = tuple((held[shared:], before, node) for held, before, node in possible)
            state[byte] = self._state(rest), out
        else:
            state[byte] = self._state(tuple(possible))
        return state[byte]

    def _last(self, state: State, byte: int) -> bytes:
        """What is written if the unit ends with this byte: the tokens of the possibility that ends here."""
        for held, before, node in state.possible:
            child = self.children.get(node << 8 | byte)
            if child is not None:
                token = self.token_at[child]
                if token >= 0 and self._follows(before, token):
                    return b"".join(map(self.written.__getitem__, held)) + self.written[token]
        raise ValueError("no token ends here")

    def encode_unit(self, unit: bytes) -> bytes:
        """The ids of a unit, each in four bytes: of the whole unit if it is a token, else what the machine writes."""
        if not unit or unit in self.alone:
            return self.written[self.ranks[unit]] if unit else b""
        if len(self.states) > MAX_STATES:
            self._forget()
        state, out = self.start, []
        for byte in unit[:-1]:
            step = state.get(byte)
            if step is None:
                step = self._step(state, byte)
            if type(step) is tuple:
                step, written = step
                out.append(written)
            state = step
        out.append(self._last(state, unit[-1]))
        return b"".join(out)


class Encoder:
    """Texts to ids: each match of ``pattern`` is a unit; the ids of units seen before are kept."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.transducer = Transducer(tokens)
        self.units = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _matches(self, text: str) -> list[str]:
        # a match is one unit whatever groups the pattern has
        return [m[0] for m in self.units.finditer(text)] if self.units.groups else self.units.findall(text)

    def _learn(self, unit: str) -> bytes:
        found = self.known.get(unit) or self.older.get(unit)
        if found is None:
            found = self.transducer.encode_unit(unit.encode("utf-8", "surrogatepass"))
        if len(unit) <= MAX_UNIT_LENGTH:
            if len(self.known) >= MAX_UNITS:
                self.older, self.known = self.known, {}
            self.known[unit] = found
        return found

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        known, learn = self.known, self._learn
        return b"".join([known.get(u) or learn(u) for u in self._matches(text or "")])


# --- decoding -----------------------------------------------------------------

# continuation bytes that a lead byte asks for, and the range of the first of them
_LEADS: dict[int, tuple[int, int, int]] = {b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)}
_LEADS |= {b: (2, 0x80, 0xBF) for b in range(0xE1, 0xF0)} | {0xE0: (2, 0xA0, 0xBF), 0xED: (2, 0x80, 0x9F)}
_LEADS |= {b: (3, 0x80, 0xBF) for b in range(0xF1, 0xF4)} | {0xF0: (3, 0x90, 0xBF), 0xF4: (3, 0x80, 0x8F)}


class Utf8Stream:
    """Characters out of chunks of bytes that may end within a character.

    The machine's state is the begun character: its bytes so far, how many are to come and the range
    of the next one. Bytes that cannot go on or begin a character become U+FFFD, one for each
    longest begun character, as in a decoding of all bytes at once.
    """

    def __init__(self) -> None:
        self.begun = b""

    def feed(self, data: bytes) -> str:
        data = self.begun + data
        cut = self._whole(data)
        self.begun = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.begun = self.begun, b""
        return rest.decode("utf-8", "replace")

    @staticmethod
    def _whole(data: bytes) -> int:
        """Where a character begins that the data leaves open, else its end: the machine runs from the last lead byte."""
        for at in range(len(data) - 1, max(len(data) - 4, -1), -1):
            if 0x80 <= data[at] < 0xC0:
                continue
            missing, low, high = _LEADS.get(data[at], (0, 0, 0))
            for byte in data[at + 1 :]:
                if not missing or not low <= byte <= high:
                    return len(data)
                missing, low, high = missing - 1, 0x80, 0xBF
            return at if missing else len(data)
        return len(data)


def decode_stream(ids: np.ndarray, tokens: list[bytes], chunk: int = CHUNK) -> Iterator[str]:
    """The text of ids, a chunk of ids at a time; ids without a token are an error."""
    stream = Utf8Stream()
    for start in range(0, len(ids), chunk):
        part = ids[start : start + chunk]
        if int(part.max()) >= len(tokens):
            raise ValueError(f"no token has the id {int(part.max())}")
        yield stream.feed(b"".join(map(tokens.__getitem__, part.tolist())))
    yield stream.close()


# --- tables -------------------------------------------------------------------


def _held(kind: str, path: str, make):
    """Tables of this Python worker, which serve one task after the other."""
    held = sys.modules.setdefault("_trendspark_bpe", types.ModuleType("_trendspark_bpe")).__dict__
    if (kind, path) not in held:
        held[kind, path] = make()
    return held[kind, path]


def _encoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    encoder = _held(f"encoder {pattern}", path, lambda: Encoder(read_ranks(path), pattern))
    for batch in slices(batches):
        gc.disable()  # the tables grow by many small objects and have no cycles
        try:
            encoded = [encoder.encode(t.as_py()) for t in batch["text"]]
        finally:
            gc.enable()
        yield batch_of(_ENCODED, [batch["id"], encoded])


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tokens = _held("tokens", path, lambda: read_ranks(path))
    for batch in slices(batches):
        held = (np.frombuffer(b.as_buffer(), "<u4") if b.is_valid else np.zeros(0, "<u4") for b in batch["ids"])
        yield batch_of(_DECODED, [batch["doc_id"], batch["ids"], ["".join(decode_stream(ids, tokens)) for ids in held]])


_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
_DECODED = pa.schema([*_ENCODED, ("text", pa.string())])


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))


def encode_documents(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, ids``: each row's token ids as little-endian unsigned 32-bit integers.

    ``path`` is a rank file that the executors can read, ``pattern`` the split before the merges.
    Null and empty texts have no ids; rows without an id and repeated rows are encoded
    like others; a table without rows gives none. Only the two named columns are read. A text is
    held with its ids, a unit takes time in proportion to its length.
    """
    rows = _texts(docs, id_column, text_column)
    return map_arrow(rows, lambda batches: _encoded(batches, path, pattern), "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text`` of encoded rows: the text that the ids stand for."""
    return map_arrow(encoded.select("doc_id", "ids"), lambda batches: _decoded(batches, path), "doc_id long, ids binary, text string")


def round_trip(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, ids, text``: rows encoded and their ids decoded, batch after batch in one pass."""
    return map_arrow(
        _texts(docs, id_column, text_column),
        lambda batches: _decoded(_encoded(batches, path, pattern), path),
        "doc_id long, ids binary, text string",
    )
