"""Benchmark decontamination by CGK embeddings and bit-sampling LSH.

Texts and items are compared as letters and digits in lower case with one blank between words.
The CGK random walk reads such a character sequence and writes a longer one: at each
step it writes the character it stands on and moves on or stays by a random bit of (step, character).
Two sequences of small edit distance walk together, so their embeddings have a small Hamming distance.
Over a whole item the walks would part for good after a few edits, so the walk starts anew
at every character, of items and of documents: an item-sized window is embedded as the
sequence of its parts. A repetition of the sampling takes the same few places of each part
as one key, and an equal key gives an alignment of the item with the text around.

The length and the number of the walks follow from the target recall. A walk that reads ``c`` characters
meets an equal key with the probability (1 - e)^c or more, ``e`` being the limit of edits, and an item is met if one of its
walks is. All walks over a text are hashed together from their last step back, and keys are made of those
whose hash an item has. Walks that overlap are edited together, so ``_OVERLAP`` of them count as one that is not. Each item takes
the cheapest setting of ``SETTINGS`` that so reaches the target, or the last if none does.
Its alignments are then bounded from below: pieces of 64 characters have their least edits in the text
around counted by bit vectors, many pieces at once, and an alignment whose pieces have more edits together than the item may have
cannot be a hit. For the others the edit distance of the whole item to the text around is computed
exactly, and only hits within the allowed share of edits are reported. Items of fewer than ``MIN_CHARS``
characters are looked for unedited, as whole words.

Documents are read once, in a map without a shuffle. Items go to the tasks in blocks of
bounded bytes; a larger benchmark takes several passes, each the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import batch_of, map_arrow, mix, slices, text_codes

MAX_EDITS = 0.2
# of items edited at random at the limit itself; fewer edits are found more surely
TARGET_RECALL = 0.9
# shorter items are looked for unedited: a few characters with edits are found in any text
MIN_CHARS = 24
BLOCK_BYTES = 4 << 20
# steps of a walk, an even number, and how many walks from each character, cheapest first
SETTINGS = ((34, 1), (34, 2), (26, 2), (20, 2), (20, 4))
_LONGEST = max(steps for steps, _ in SETTINGS)
# walks from neighbouring characters that tell as much as one by itself, by measured recall
_OVERLAP = 1.5
SAMPLES = 12
# a walk has to read this share of its steps, else its key says little
MIN_READ = 0.4
# so many characters are sampled within the steps named
_EARLY = ((4, 7), (7, 13))
# bits of the filters of walks and of keys
_WALK_BITS, _KEY_BITS = 20, 20
# walks of items up to which 16 bits of a walk's hash tell enough
_FEW_WALKS = 4096
# alignments within so many characters are one place
_BAND = 16
# characters of a piece: one machine word
_PIECE = 64
# pieces whose bit vectors are held at once
_ROWS = 2048
# characters of joined texts whose keys are looked up at once; arrays of so many stay in a processor's cache
_SEGMENT = 1 << 16
# from here on scripts are taken to be written without blanks
_UNSPACED = 0x0E00

# letters and digits in lower case, 0 for all else; beyond the basic plane all code points are themselves
_FOLD = np.zeros(1 << 16, np.uint32)
for _c in range(1 << 16):
    if chr(_c).isalnum():
        _low = chr(_c).lower()
        _FOLD[_c] = ord(_low) if len(_low) == 1 else _c


def normalise(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters and digits in lower case with one blank (32) behind each word, and the source place of each."""
    folded = _FOLD[codes] if not len(codes) or codes.max() < 1 << 16 else np.where(codes < 1 << 16, _FOLD[np.minimum(codes, (1 << 16) - 1)], codes)
    inside = folded != 0
    kept = inside.copy()
    kept[1:] |= inside[:-1]
    places = np.flatnonzero(kept)
    out = folded[places]
    out[out == 0] = 32
    return out, places


def normal_codes(text: str) -> np.ndarray:
    """Code points of the words with one blank between them, in lower case."""
    out, _ = normalise(text_codes(text))
    return out[:-1] if len(out) and out[-1] == 32 else out


def symbols(codes: np.ndarray) -> np.ndarray:
    """One byte for each code point; Latin ones have one each."""
    return np.where(codes < 256, codes, (codes * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def paired(held: np.ndarray) -> np.ndarray:
    """Each symbol and the one behind it in 16 bits: what two steps of a walk can read."""
    wide = held.astype(np.uint16)
    wide[:-1] |= wide[1:] << 8
    return wide


@cache
def _bits(steps: int, walk: int) -> np.ndarray:
    """The random bit of each (step, symbol) of a walk."""
    cells = np.arange(steps * 256, dtype=np.uint64) + np.uint64((997 * walk + 1) << 20)
    return (mix(cells) >> np.uint64(63)).astype(np.uint8).reshape(steps, 256)


@cache
def sampled_places(steps: int, walk: int) -> frozenset[int]:
    """The places of the embedding that a repetition samples, the last among them."""
    rng = np.random.default_rng(1000 * steps + walk)
    chosen, begin = [steps - 1], 0
    for count, end in (*_EARLY, (SAMPLES, steps)):
        wanted = min(count - len(chosen) + 1, SAMPLES - len(chosen))
        chosen.extend(rng.choice(np.arange(begin, min(end, steps - 1)), size=wanted, replace=False).tolist())
        begin = end
    return frozenset(chosen)


@cache
def _single_steps(steps: int, walk: int, width: int) -> tuple[tuple[np.ndarray, tuple[tuple[int, np.unsignedinteger | None], ...]], ...]:
    """Runs of ``width`` steps at most, last first: their random bits by symbol, the last on top, and each step with its factor if sampled."""
    unsigned = np.dtype(f"u{width // 8}").type
    bits, places = _bits(steps, walk), sampled_places(steps, walk)
    cells = np.arange(steps, dtype=np.uint64) + np.uint64((997 * walk + steps) << 20)
    factors = (mix(cells) >> np.uint64(64 - width)).astype(unsigned) | unsigned(1)
    found = []
    for end in range(steps, 0, -width):
        run = range(end - 1, max(0, end - width) - 1, -1)
        words = np.zeros(256, unsigned)
        for back, step in enumerate(run):
            words |= bits[step].astype(unsigned) << unsigned(width - 1 - back)
        found.append((words, tuple((step, factors[step] if step in places else None) for step in run)))
    return tuple(found)


def walk_hashes(held: np.ndarray, size: int, steps: int, walk: int, width: int = 32) -> np.ndarray:
    """``width`` bits of what the walk from each of the first ``size`` symbols samples; ``held`` goes on for ``steps`` symbols or more.

    Walks are followed from their last step back, all at once: what a walk samples from a step on is what it samples
    there, and what it samples from the next step on, here or at the next symbol.
    """
    n, unsigned, signed = size + steps, f"u{width // 8}", f"i{width // 8}"
    held = held[:n]
    wide, total = held.astype(unsigned), np.zeros(n + 1, unsigned)
    other, moved = np.empty(n, unsigned), np.empty(n, signed)
    for words, run in _single_steps(steps, walk, width):
        coming = words[held].view(signed)
        for step, factor in run:
            # a walk has moved by as many symbols as steps at most
            here = slice(size + step)
            np.right_shift(coming[here], width - 1, out=moved[here])
            np.bitwise_xor(total[1 : size + step + 1], total[here], out=other[here])
            other[here] &= moved[here].view(unsigned)
            total[here] ^= other[here]
            if factor is not None:
                np.multiply(wide[here], factor, out=other[here])
                total[here] += other[here]
            coming[here] <<= 1
    return total[:size]


@cache
def _double_steps(steps: int, walk: int) -> tuple[tuple[int, np.ndarray | None, np.ndarray], ...]:
    """For each two steps: how many places are sampled, and by the pair of symbols what they write and how far they move."""
    bits, places = _bits(steps, walk), sampled_places(steps, walk)
    pair = np.arange(1 << 16)
    first, second = pair & 255, pair >> 8
    found = []
    for step in range(0, steps, 2):
        moved = bits[step][first]
        then = np.where(moved, second, first)
        written = (step in places) * first + ((step + 1 in places) * then << 8)
        count = (step in places) + (step + 1 in places)
        found.append((count, written.astype(np.uint64) if count else None, moved.astype(np.int32) + bits[step + 1][then]))
    return tuple(found)


def part_keys(pairs: np.ndarray, starts: np.ndarray, steps: int, walk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``starts, keys, ends`` of the walks from ``starts`` over ``pairs`` of symbols, padded by ``steps`` or more."""
    at, key = starts.copy(), np.full(len(starts), steps * 131 + walk, np.uint64)
    for count, writes, moves in _double_steps(steps, walk):
        pair = pairs[at]
        if count:
            key *= np.uint64(0x9E3779B97F4A7C15)
            key += writes[pair]
        at += moves[pair]
    read = np.flatnonzero(at - starts >= MIN_READ * steps)
    return starts[read], mix(key[read]), at[read]


class WalkFilter:
    """Hashes of the walks of items: by their upper bits, and what passes by the lower ones."""

    def __init__(self, hashes: np.ndarray, width: int):
        self.shift, self.low = max(0, width - _WALK_BITS), (1 << min(width, _WALK_BITS)) - 1
        self.upper, self.lower = np.zeros(self.low + 1, bool), np.zeros(self.low + 1, bool)
        self.upper[hashes >> self.shift] = True
        self.lower[hashes & self.low] = True

    def passing(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be among those of the items."""
        found = np.flatnonzero(self.upper[hashes >> self.shift if self.shift else hashes])
        return found[self.lower[hashes[found] & self.low]] if self.shift else found


def piece_edits(held: np.ndarray, pieces: list[np.ndarray], begins: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The least edit distance of each piece (64 symbols at most) to any part of ``columns`` symbols of ``held`` from ``begins``."""
    rows, lengths = np.arange(len(pieces)), np.array([len(p) for p in pieces])
    # a piece ends at the top bit; the bits below its first symbol are equal to all
    below = (_PIECE - lengths).astype(np.uint64)
    up = ~np.uint64(0) << below
    equal = np.repeat(~up, 256).reshape(-1, 256)
    padded = np.zeros((len(pieces), _PIECE), np.uint8)
    for row, piece in enumerate(pieces):
        padded[row, : len(piece)] = piece
    for j in range(int(lengths.max())):
        inside = rows[lengths > j]
        equal[inside, padded[inside, j]] |= np.uint64(1) << (below[inside] + np.uint64(j))
    equal, first = equal.ravel(), rows * 256
    width = int(columns.max())
    texts = held[np.minimum(begins + np.arange(width)[:, None], len(held) - 1)]
    one, end = np.uint64(1), np.uint64(_PIECE - 1)
    down = np.zeros(len(pieces), np.uint64)
    score, best = lengths.astype(np.uint64), lengths.astype(np.uint64)
    across, rise = np.empty_like(up), np.empty_like(up)
    for symbol in texts:
        match = equal[first + symbol]
        np.bitwise_and(match, up, out=across)
        across += up
        across ^= up
        across |= match
        np.bitwise_or(across, up, out=rise)
        np.invert(rise, out=rise)
        rise |= down
        up &= across
        score += rise >> end
        score -= up >> end
        # columns behind the end of a row's own only lower its bound
        np.minimum(best, score, out=best)
        rise <<= one
        match |= down
        np.bitwise_and(rise, match, out=down)
        match |= rise
        np.invert(match, out=match)
        up <<= one
        up |= match
    return best.astype(np.int64)


def edit_span(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """The least edit distance of ``item`` to a part of ``text``, and where that part lies."""
    n = len(text)
    column = np.arange(n + 1)
    row, begins = np.zeros(n + 1, np.int64), column.copy()
    for i, code in enumerate(item, 1):
        diagonal = row[:-1] + (text != code)
        up = row[1:] + 1
        take = diagonal <= up
        best = np.concatenate(([i], np.where(take, diagonal, up)))
        source = np.concatenate(([0], np.where(take, begins[:-1], begins[1:])))
        # moves to the right: the least of best[j'] + (j - j') over j' <= j
        reach = np.minimum.accumulate(best - column)
        first = np.maximum.accumulate(np.where(best - column == reach, column, 0))
        # the last place where the running minimum was set
        row, begins = reach + column, source[first]
    end = int(np.argmin(row))
    return int(row[end]), int(begins[end]), end


def unedited_at(item: np.ndarray, text: np.ndarray) -> int:
    """Where ``item`` stands in ``text`` first, unedited; -1 if it does not."""
    wanted, held, size = item.tobytes(), text.tobytes(), item.itemsize
    at = held.find(wanted)
    while at % size and at > 0:
        at = held.find(wanted, at + 1)
    return at // size


def least_edits(item: np.ndarray, text: np.ndarray) -> int:
    """The least edit distance of ``item`` to any part of ``text``, by bit vectors over the item."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    masks: dict[int, int] = {}
    for i, code in enumerate(item.tolist()):
        masks[code] = masks.get(code, 0) | 1 << i
    up, down, score = full, 0, m
    best = m
    for code in text.tolist():
        equal = masks.get(code, 0)
        across = (((equal & up) + up) ^ up) | equal
        rise = down | ~(across | up) & full
        fall = up & across
        score += (1 if rise & top else 0) - (1 if fall & top else 0)
        best = min(best, score)
        rise = rise << 1 & full
        across = equal | down
        up = (fall << 1 & full) | ~(across | rise) & full
        down = rise & across
    return best


def _bands(item: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each item in each band of places, by item and place."""
    order = np.lexsort((place, item))
    item, place = item[order], place[order]
    fresh = np.ones(len(item), bool)
    fresh[1:] = (item[1:] != item[:-1]) | (place[1:] // _BAND != place[:-1] // _BAND)
    return item[fresh], place[fresh]


class ItemIndex:
    """Sorted keys of the parts of a block of items, by length of walk, and the items to be found unedited."""

    def __init__(self, items: list[tuple[int, str]], max_edits: float = MAX_EDITS, target: float = TARGET_RECALL):
        self.max_edits = max_edits
        self.ids = [item_id for item_id, _ in items]
        self.codes = [normal_codes(text) for _, text in items]
        self.symbols = [symbols(c) for c in self.codes]
        self.longest = max((len(c) for c in self.codes), default=0)
        lengths = np.array([len(c) for c in self.codes], np.int64)
        # all items in one array, with room for a walk between them
        begins = np.concatenate(([0], np.cumsum(lengths + _LONGEST)))
        held = np.zeros(int(begins[-1]) + 1, np.uint8)
        for begin, one in zip(begins, self.symbols, strict=False):
            held[begin : begin + len(one)] = one
        pairs = paired(held)
        waiting = lengths >= MIN_CHARS
        starts = np.concatenate([*(np.arange(begins[n], begins[n] + lengths[n]) for n in np.flatnonzero(waiting)), np.zeros(0, np.int64)])
        owner = np.repeat(np.flatnonzero(waiting), lengths[waiting])
        ends = begins[:-1] + lengths
        # items of each table
        taken: dict[tuple[int, int], np.ndarray] = {}
        for steps, walks in SETTINGS:
            met = np.zeros(len(items))
            for walk in range(walks):
                kept, _, last = part_keys(pairs, starts, steps, walk)
                mine = owner[np.searchsorted(starts, kept)]
                inside = last < ends[mine]
                met += np.bincount(mine[inside], (1 - max_edits) ** (last - kept)[inside], len(items))
            chosen = waiting & ((1 - np.exp(-met / _OVERLAP) >= target) | ((steps, walks) == SETTINGS[-1]))
            waiting &= ~chosen
            for walk in range(walks):
                taken[steps, walk] = taken.get((steps, walk), False) | chosen
        self.tables = []
        for (steps, walk), chosen in taken.items():
            if chosen.any():
                self._add_table(held, pairs, starts[chosen[owner]], owner[chosen[owner]], begins, ends, steps, walk)
        exact: dict[str, list[int]] = {}
        for number, codes in enumerate(self.codes):
            if 0 < len(codes) < MIN_CHARS:
                exact.setdefault(codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), []).append(number)
        self.exact = ahocorasick.Automaton()
        for text, numbers in exact.items():
            self.exact.add_word(text, (text, tuple(numbers)))
        if exact:
            self.exact.make_automaton()

    def _add_table(
        self, held: np.ndarray, pairs: np.ndarray, starts: np.ndarray, owner: np.ndarray, begins: np.ndarray, ends: np.ndarray, steps: int, walk: int
    ) -> None:
        """The keys of the walks that end inside their item."""
        kept, keys, last = part_keys(pairs, starts, steps, walk)
        mine = owner[np.searchsorted(starts, kept)]
        inside = last < ends[mine]
        kept, keys, mine = kept[inside], keys[inside], mine[inside]
        width = 16 if len(kept) <= _FEW_WALKS else 32
        whole = np.zeros(1 << _KEY_BITS, bool)
        hashes = walk_hashes(held, len(held) - steps, steps, walk, width)[kept]
        walked = WalkFilter(hashes, width)
        whole[keys >> np.uint64(64 - _KEY_BITS)] = True
        order = np.argsort(keys, kind="stable")
        known, first = np.unique(keys[order], return_index=True)
        self.tables.append((steps, walk, width, walked, whole, known, np.append(first, len(keys)), mine[order], (kept - begins[mine])[order]))

    def candidates(self, codes: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``item number, place`` where the item would begin in normalised ``codes``, by item and place.

        ``held`` has the symbols, padded by the longest walk. One place is given for each band of places.
        """
        pairs = paired(held)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for begin in range(0, len(codes), _SEGMENT):
            size = min(_SEGMENT, len(codes) - begin)
            for table in self.tables:
                steps, walk, width, walked, *_ = table
                # walks that may sample what one of an item does
                starts = walked.passing(walk_hashes(held[begin:], size, steps, walk, width)) + begin
                found.append(_bands(*self._matches(pairs, starts, table)))
        return _bands(*(np.concatenate(f) for f in zip(*found, strict=True)))

    def _matches(self, pairs: np.ndarray, starts: np.ndarray, table: tuple) -> tuple[np.ndarray, np.ndarray]:
        """``item, place`` of the items whose keys are equal in one repetition."""
        steps, walk, _, _, whole, known, first, owners, offsets = table
        starts, keys, _ = part_keys(pairs, starts, steps, walk)
        if not len(known):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        likely = np.flatnonzero(whole[keys >> np.uint64(64 - _KEY_BITS)])
        starts, keys = starts[likely], keys[likely]
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        equal = np.flatnonzero(known[at] == keys)
        starts, at = starts[equal], at[equal]
        counts = first[at + 1] - first[at]
        total = int(counts.sum())
        slot = np.repeat(first[at], counts) + np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        return owners[slot], np.repeat(starts, counts) - offsets[slot]

    def possible(self, held: np.ndarray, item: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether the pieces of an item at a place have no more edits together than the item may have."""
        allowed = np.array([int(self.max_edits * len(c)) for c in self.codes], np.int64)[item]
        pieces = np.array([-(-len(c) // _PIECE) for c in self.codes], np.int64)[item]
        total, alive = np.zeros(len(item), np.int64), np.arange(len(item))
        # a piece a round: most alignments are ruled out before their last one
        for turn in range(int(pieces.max(initial=0))):
            alive = alive[(total[alive] <= allowed[alive])]
            due = alive[turn < pieces[alive]]
            for first in range(0, len(due), _ROWS):
                rows = due[first : first + _ROWS]
                texts, begins, columns = [], [], []
                for number, at, slack, n in zip(item[rows].tolist(), place[rows].tolist(), (allowed[rows] + _BAND).tolist(), pieces[rows].tolist(), strict=True):
                    whole = self.symbols[number]
                    a, b = turn * len(whole) // n, (turn + 1) * len(whole) // n
                    texts.append(whole[a:b])
                    begins.append(max(0, at + a - slack))
                    columns.append(at + b + slack - begins[-1])
                total[rows] += piece_edits(held, texts, np.array(begins), np.array(columns))
        return total <= allowed

    def unedited(self, codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``item number, start, end`` of short items that stand in ``codes`` as whole words."""
        if not len(self.exact):
            return
        text = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        for last, (word, numbers) in self.exact.iter(text):
            start, end = last + 1 - len(word), last + 1
            free = (start == 0 or text[start - 1] == " " or ord(word[0]) >= _UNSPACED) and (
                end == len(text) or text[end] == " " or ord(word[-1]) >= _UNSPACED
            )
            if free:
                yield from ((n, start, end) for n in numbers)


def hits(texts: list[str], index: ItemIndex, max_edits: float) -> list[tuple[int, int, int, int, int]]:
    """``text number, item id, start, end, edits`` of the items found in texts, best place of each."""
    codes, places = normalise(text_codes("\n".join(texts)))
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    # where each text begins among the normalised characters
    firsts = np.searchsorted(places, begins)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}

    def keep(text: int, number: int, edits: int, start: int, end: int) -> None:
        shift = int(begins[text])
        found = (edits, int(places[start]) - shift, int(places[end - 1]) + 1 - shift)
        best[text, number] = min(best.get((text, number), found), found)

    if index.tables and len(codes):
        held = np.concatenate((symbols(codes), np.zeros(_LONGEST, np.uint8)))
        item_at, place_at = index.candidates(codes, held)
        possible = index.possible(held, item_at, place_at)
        for number, place in zip(item_at[possible].tolist(), place_at[possible].tolist(), strict=True):
            item = index.codes[number]
            allowed = int(max_edits * len(item))
            slack = allowed + _BAND
            begin, stop = max(0, place - slack), min(len(codes), place + len(item) + slack)
            for text in range(int(np.searchsorted(firsts, begin, side="right")) - 1, len(texts)):
                a, b = max(begin, int(firsts[text])), min(stop, int(firsts[text + 1]))
                if a >= stop:
                    break
                if b - a < len(item) - allowed or best.get((text, number), (1,))[0] == 0:
                    continue
                around = codes[a:b]
                start = unedited_at(item, around)
                if start >= 0:
                    keep(text, number, 0, a + start, a + start + len(item))
                    continue
                if least_edits(item, around) > allowed:
                    continue
                edits, start, end = edit_span(item, around)
                if end > start:
                    keep(text, number, edits, a + start, a + end)
    for number, start, end in index.unedited(codes):
        text = int(np.searchsorted(firsts, start, side="right")) - 1
        if end <= firsts[text + 1]:
            keep(text, number, 0, start, end)
    return sorted((t, index.ids[n], start, end, edits) for (t, n), (edits, start, end) in best.items())


def _blocks(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of about ``BLOCK_BYTES``, each read by itself."""
    items = benchmark.where(F.col(id_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("item_id"), F.col(text_column).cast("string").alias("text")
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // BLOCK_BYTES))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block) if blocks > 1 else items
        yield [(r.item_id, r.text) for r in part.distinct().orderBy("item_id", "text").collect()]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    max_edits: float = MAX_EDITS,
    target_recall: float = TARGET_RECALL,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, item_id, start_char, end_char, edits``: the items that a document holds.

    A hit is a part of the text whose edit distance to the item, in characters, is at most
    ``max_edits`` of the item's length; case, punctuation and white space do not count. The best place
    of each item is given, in code points of the original text. Items of fewer than ``MIN_CHARS`` letters, digits
    and blanks between words are looked for unedited, as whole words; null and empty texts
    and items give no hits, nor do tables without rows. Repeated documents give their hits
    as often; rows without an id are reported with a null id.

    Of parts within the limit, about the share ``target_recall`` or more is found if edits are spread at random. Every character of
    a document begins a walk, and every one of an item.
    """
    out = pa.schema([(n, pa.int64()) for n in (id_column, "item_id", "start_char", "end_char", "edits")])
    schema = ", ".join(f"`{n}` long" for n in out.names)
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    spark, passes = docs.sparkSession, None
    for items in _blocks(benchmark, "item_id", "text"):
        shared = spark.sparkContext.broadcast(items)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(shared.value, max_edits, target_recall)
            for batch in slices(batches):
                ids, held = batch["id"].to_pylist(), [t or "" for t in batch["text"].to_pylist()]
                rows = [(ids[text], *hit) for text, *hit in hits(held, index, max_edits)] if any(held) else []
                if rows:
                    yield batch_of(out, list(zip(*rows, strict=True)))

        found = map_arrow(texts, find, schema)
        passes = found if passes is None else passes.union(found)
    return passes


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns stay.

    Rows without an id stay.
    """
    ids = contaminated(docs, benchmark, id_column=id_column, **options).select(id_column).distinct()
    return docs.join(ids, id_column, "left_anti").select(*docs.columns)
