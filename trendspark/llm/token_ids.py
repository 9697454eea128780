"""Token ids of whole texts by a public tokenizer file.

Byte-level BPE of this family splits a text before each single space between two
characters that are not white space, and never merges across such a place. So the
ids of a text are the ids of its pieces between these places, one after the other, and a
piece that was seen before needs no second encoding. ``Encoder`` keeps the ids of seen
pieces in a bounded table and asks the tokenizer for the others: its model, where a piece is a
word of Latin letters, which leaves nothing to split. ``encode_whole`` is
the plain call; tests hold the two against each other on arbitrary texts. A file of another
family is recognised by its settings, and its texts are encoded whole.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import sys
import types
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import regex

from trendspark.llm.common import ENCODERS

# pieces that a table remembers; a full one is kept as the older table, and its pieces that come back move on
MAX_PIECES = 700_000
# a piece longer than this is encoded but not remembered
MAX_REMEMBERED = 64
# characters of texts that are encoded together
GROUP_CHARS = 1 << 20
_MARKS = ".,;:!?"

# fixed value: the unit pattern of byte-level BPE files of this family
_UNITS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _splits_at_spaces(settings: dict) -> bool:
    """Whether the settings of a tokenizer file are those of the family whose units ``_UNITS`` gives."""
    splitter, model = settings.get("pre_tokenizer") or {}, settings.get("model") or {}
    plain = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    return (
        settings.get("normalizer") is None
        and settings.get("post_processor") is None
        and splitter.get("type") == "ByteLevel"
        and splitter.get("use_regex") is True
        and not splitter.get("add_prefix_space")
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in plain)
        and not any(t[k] for t in settings.get("added_tokens", ()) for k in ("single_word", "lstrip", "rstrip"))
    )


def _is_latin(text: str) -> bool:
    """Whether all characters are those of Latin-1."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Pieces(dict[str, bytes]):
    """The ids of pieces. One that it lacks is a hole, the same for all its places, whose ids are filled in later.

    No holes are pieces of the older table, listed in ``moved``, and letters that either has with a mark behind them: they
    are put together anew, and listed in ``marked``.
    """

    def __init__(self, marks: dict[str, bytes], older: dict[str, bytes]):
        self.marks, self.older = marks, older
        self.holes: dict[str, bytearray] = {}
        self.moved: dict[str, bytes] = {}
        self.marked: dict[str, bytes | bytearray] = {}

    def __missing__(self, piece: str) -> bytes | bytearray:
        ids = self.older.get(piece)
        if ids:
            self.moved[piece] = ids
            return ids
        mark = self.marks.get(piece[-1])
        if mark:
            stem = piece[:-1]
            ids = self.get(stem)
            if not ids:
                ids = self.older.get(stem)
                if ids:
                    self.moved[stem] = ids
            if ids and stem.isalpha():
                self.marked[piece] = ids = ids + mark
                return ids
        return self.holes.setdefault(piece, bytearray())


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.by_pieces = _splits_at_spaces(json.loads(self.tokenizer.to_str()))
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))).search if special else None
        # a piece of letters is one unit with the space before it, and a mark behind it is another, unless they may hold
        # a special token
        letters_split = any(t.strip(" " + _MARKS).isalpha() or not t.strip(" " + _MARKS) for t in special)
        self.by_lines = not any("\n" in t for t in special)
        self.marks: dict[str, bytes] = {}
        if self.by_pieces:
            (self.line_feed,) = self.encode_whole("\n").tolist()
            self.feed = np.uint32(self.line_feed).tobytes()
            # by byte, the character that stands for it: its own or, where that does not print, the next one behind Latin-1
            alphabet = sorted(ByteLevel.alphabet())
            behind = iter([c for c in alphabet if ord(c) > 255])
            self.bytewise = "".join(chr(b) if chr(b) in alphabet else next(behind) for b in range(256))
            self.model = self.tokenizer.model
            if not letters_split:
                self.marks = {m: self.encode_whole(m).tobytes() for m in _MARKS}
        self.known = _Pieces(self.marks, {})
        self.recent: set[str] = set()

    def encode_whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """The ids of units of the byte-level split.

        Units with no line feed go to the tokenizer as one text with line feeds between
        them: a line feed before a unit is always a unit, and so an id, of its own.
        """
        found: dict[str, bytes] = {}
        joined = [u for u in units if not u.isspace() and "\n" not in u]
        blocks = [joined[i : i + 128] for i in range(0, len(joined), 128)]
        texts = ["\n".join(b) for b in blocks]
        for block, done in zip(blocks, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(done.ids, np.uint32)
            cuts = np.flatnonzero(ids == self.line_feed)
            if len(cuts) != len(block) - 1:
                raise ValueError("the tokenizer does not keep line feeds apart")
            spans = map(slice, [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), 4 * len(ids)])
            found.update(zip(block, map(ids.tobytes().__getitem__, spans), strict=True))
        for unit in units:
            if unit not in found:
                found[unit] = self.encode_whole(unit).tobytes()
        return list(map(found.__getitem__, units))

    def _encode_letters(self, units: list[str]) -> list[bytes]:
        """The ids of units of Latin letters, some behind a space, by the tokenizer's model: there is nothing left to split."""
        text = codecs.charmap_decode("\n".join(units).encode(), "strict", self.bytewise)[0]
        tokens = list(map(self.model.tokenize, text.split(self.bytewise[10])))
        data = np.array([t.id for t in chain.from_iterable(tokens)], np.uint32).tobytes()
        cuts = list(accumulate([4 * len(t) for t in tokens], initial=0))
        return list(map(data.__getitem__, map(slice, cuts, cuts[1:])))

    def _learn(self, holes: dict[str, bytearray]) -> None:
        """Fills in the ids of pieces that the table lacks. Units are remembered, as pieces of their own, and what comes often."""
        known, older, marks, special = self.known, self.known.older, self.marks, self.special
        remembered, known.moved = known.moved, {}
        # by piece; a unit is a piece without the space in front, or one that is marked as the first
        letters: dict[str, bytearray] = {}
        others: dict[str, bytearray] = {}
        # what is put together, of parts that may be holes, too
        several: list[tuple[str, bytearray, list[bytes | bytearray]]] = []
        # a piece behind a line feed is that and a first piece
        lines: list[tuple[str, bytearray, list[bytes | bytearray]]] = []
        for piece in [p for p in holes if p[0] == "\n"]:
            hole, rest = holes.pop(piece), "  " + piece[1:]
            part = known.get(rest) if piece[1:] else b""
            lines.append((piece, hole, [self.feed, holes.setdefault(rest, bytearray()) if part is None else part]))
        for piece, hole in holes.items():
            ids = older.get(piece)
            if ids:
                remembered[piece] = ids
                hole += ids
                continue
            first = piece[:2] == "  "
            if marks:
                if piece.isalpha():
                    letters[piece] = hole
                    continue
                last = piece[-1]
                stem = piece[:-1] if last in marks else piece
                if (stem[2:] if first else stem).isalpha():
                    if last not in marks:
                        letters[piece] = hole
                        continue
                    part = known.get(stem) or older.get(stem) or holes.get(stem)
                    if part is None:
                        part = letters.setdefault(stem, bytearray())
                    several.append((piece, hole, [part, marks[last]]))
                    continue
            full = piece[2:] if first else " " + piece
            if special and special(full):
                # a special token's text is one id: such a piece is not split
                hole += self.encode_whole(full).tobytes()
                if len(full) <= MAX_REMEMBERED:
                    remembered[piece] = bytes(hole)
                continue
            parts: list[bytes | bytearray] = []
            for unit in _UNITS.findall(full):
                key = unit[1:] if unit[0] == " " and len(unit) > 1 and not unit[1].isspace() else "  " + unit
                if key == piece:
                    others[piece] = hole
                    break
                part = known.get(key) or older.get(key) or holes.get(key)
                if part is None:
                    kind = letters if marks and (unit[1:] if unit[0] == " " else unit).isalpha() else others
                    part = kind.setdefault(key, bytearray())
                parts.append(part)
            else:
                several.append((piece, hole, parts))
        # the tokenizer may know letters of other scripts by another version of Unicode
        if not _is_latin("".join(letters)):
            others.update((p, letters.pop(p)) for p in [p for p in letters if not _is_latin(p)])
        for kind, encode in ((letters, self._encode_letters), (others, self._encode_units)):
            if not kind:
                continue
            units = [p[2:] if p[:2] == "  " else " " + p for p in kind]
            found = encode(units)
            for hole, ids in zip(kind.values(), found, strict=True):
                hole += ids
            remembered.update((p, ids) for p, u, ids in zip(kind, units, found, strict=True) if len(u) <= MAX_REMEMBERED)
        for _, hole, parts in chain(several, lines):
            hole += b"".join(parts)
        # of pieces of several units those that were looked for the last time, too
        made, known.marked = known.marked, {}
        made.update((p, hole) for p, hole, _ in chain(several, lines) if len(p) <= MAX_REMEMBERED)
        remembered.update((p, bytes(made[p])) for p in self.recent.intersection(made))
        self.recent = made.keys() - remembered.keys()
        if len(known) + len(remembered) > MAX_PIECES:
            known.older = {}
            self.known = _Pieces(marks, known)
        self.known.update(remembered)

    def encode(self, text: str | None, end: int) -> np.ndarray:
        """The ids of the whole text and then ``end``, as unsigned 32-bit integers."""
        return next(self.encode_texts([text], end))

    def encode_texts(self, texts: list[str | None], end: int) -> Iterator[np.ndarray]:
        """The ids of each text, as :meth:`encode` gives them. What the table lacks is learned for many texts at once."""
        if not self.by_pieces:
            for text in texts:
                yield np.append(self.encode_whole(text or ""), np.uint32(end)).astype(np.uint32)
            return
        # a text ends before a special token, and line feeds there would be one unit
        special, last, start = self.special, np.uint32(end).tobytes(), 0
        while start < len(texts):
            held, size = [], 0
            look = self.known.__getitem__
            while start < len(texts) and size < GROUP_CHARS:
                text = texts[start] or ""
                held.append(list(map(look, split_pieces(text, self.by_lines and "\n" in text and not (special and special(text))))))
                size, start = size + len(text), start + 1
            holes, self.known.holes = self.known.holes, {}
            if holes or self.known.moved:
                self._learn(holes)
            for ids in held:
                ids.append(last)
                yield np.frombuffer(b"".join(ids), np.uint32)


def shared_encoder(path: str) -> Encoder:
    """The encoder of this Python worker: its table of seen pieces serves one task after the other."""
    held = sys.modules.setdefault(ENCODERS, types.ModuleType(ENCODERS)).__dict__
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


# white space other than the space and the line feed; none is beyond U+3000
_RARE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_CUT = re.compile(r"(?<=\S) (?=\S)")


def split_pieces(text: str, by_lines: bool = False) -> list[str]:
    """``text`` cut at each single space between two characters that are no white space.

    The space itself is left out: every piece but the first has one in front. A first
    piece is marked by a second space instead, which no other piece can start with. With ``by_lines``,
    a text whose line feeds stand between other characters, two in a row at most, is cut before them, too: each is a unit
    of its own there. Such a piece starts with the line feed.
    """
    seams = "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " "
    if seams or any(map(text.__contains__, _RARE)):
        words = _CUT.split(text)
    elif by_lines and "\n\n\n" not in text and text[:1] != "\n" and text[-1:] != "\n":
        words = text.replace("\n", " \n").split(" ")
    else:
        words = text.split(" ")
    if words[0]:
        words[0] = "  " + words[0]
        return words
    return words[1:]
