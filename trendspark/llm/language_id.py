"""Language identification by interpolated Kneser-Ney character models.

Counts of four-character sequences are gathered from all labelled texts, one model a
language. Lower orders use continuation counts, one absolute discount an order. For each
order the union of the sequences of all languages is one sorted array of 64-bit keys with
a row of log probabilities, one for each language, so a character costs one binary search;
what no language has seen backs off through sorted context arrays. The language of
least cross-entropy by character is chosen.

Texts are read as letters in lower case; everything else is one blank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import batch_of, map_arrow, slices, text_codes
from trendspark.staging import Scratch

ORDER = 4
UNKNOWN = "und"
# most sequences of four characters that a language's model holds, a bound on what is broadcast
MAX_SEQUENCES = 400_000
# characters that count as independent evidence in the score
EVIDENCE = 40
_BLANK, _START, _PRIVATE = 32, 1, 0xE000
_BITS = np.uint64(16)

_FOLD = np.full(1 << 16, _BLANK, np.uint16)
for _c in range(1 << 16):
    if chr(_c).isalpha():
        _low = chr(_c).lower()
        _FOLD[_c] = ord(_low) if len(_low) == 1 else _c
_FOLD[0] = _START


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, each led by start marks; where each text begins; its letters."""
    joined = "".join("\0" * (ORDER - 1) + t.replace("\0", " ") for t in texts)
    codes = text_codes(joined)
    folded = _FOLD[np.minimum(codes, 0xFFFF)]
    high = np.flatnonzero(codes > 0xFFFF)
    if len(high):
        # letters beyond the basic plane are a symbol for each 256 code points, of the private use area
        kinds, which = np.unique(codes[high], return_inverse=True)
        symbols_of = [_PRIVATE + (int(c) >> 8) if chr(c).isalpha() else _BLANK for c in kinds]
        folded[high] = np.array(symbols_of, np.uint16)[which]
    twice = np.zeros(len(folded), bool)
    twice[1:] = (folded[1:] == _BLANK) & (folded[:-1] == _BLANK)
    folded = folded[~twice]
    begins = np.flatnonzero(folded == _START)[:: ORDER - 1]
    letters = np.add.reduceat((folded > _BLANK).astype(np.int64), begins) if len(begins) else np.zeros(0, np.int64)
    return folded, begins, letters


def sequences(folded: np.ndarray) -> np.ndarray:
    """The ``ORDER`` symbols that end at each place, packed; a start mark at the end counts as none."""
    wide = folded.astype(np.uint64)
    packed = wide.copy()
    for back in range(1, ORDER):
        packed[back:] |= wide[:-back] << (_BITS * np.uint64(back))
    return packed


def _ends_in_symbol(folded: np.ndarray) -> np.ndarray:
    return folded != _START


@dataclass
class LanguageModel:
    """Sorted arrays of each order, highest first, and the limits of rejection."""

    languages: list[str]
    keys: list[np.ndarray] = field(default_factory=list)
    log_probabilities: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    log_weights: list[np.ndarray] = field(default_factory=list)
    unseen: float = 0.0
    means: np.ndarray | None = None
    spreads: np.ndarray | None = None

    def score(self, packed: np.ndarray) -> np.ndarray:
        """Log probability of each sequence's last symbol, by language."""
        total = np.zeros((len(packed), len(self.languages)), np.float32)
        left, keys = np.arange(len(packed)), packed
        for level in range(ORDER):
            known = self.keys[level]
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = known[at] == keys
            if level == 0 and hit.all():
                return self.log_probabilities[0][at]
            total[left[hit]] += self.log_probabilities[level][at[hit]]
            left, keys = left[~hit], keys[~hit]
            if not len(left):
                return total
            if level < ORDER - 1:
                context = keys >> _BITS
                at = np.minimum(np.searchsorted(self.contexts[level], context), len(self.contexts[level]) - 1)
                seen = self.contexts[level][at] == context
                total[left[seen]] += self.log_weights[level][at[seen]]
                keys = keys & ((np.uint64(1) << (_BITS * np.uint64(ORDER - 1 - level))) - np.uint64(1))
        total[left] += self.unseen
        return total

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy (nats a character) and number of characters of each text."""
        n = len(texts)
        if not n or not self.languages:
            return [UNKNOWN] * n, np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
        folded, begins, letters = symbols(texts)
        scored = _ends_in_symbol(folded)
        places = np.flatnonzero(scored)
        values = np.zeros((len(folded), len(self.languages)), np.float32)
        values[places] = self.score(sequences(folded)[places])
        sums = np.add.reduceat(values, begins, axis=0, dtype=np.float64)
        counts = np.add.reduceat(scored.astype(np.int64), begins)
        entropies = -sums / np.maximum(counts, 1)[:, None]
        best = np.argmin(entropies, axis=1)
        least = entropies[np.arange(n), best]
        odds = np.exp(-(entropies - least[:, None]) * np.minimum(counts, EVIDENCE)[:, None]).sum(axis=1)
        names = [self.languages[b] if l else UNKNOWN for b, l in zip(best, letters, strict=True)]
        return names, np.where(letters > 0, 1 / odds, 0.0), least, counts

    def rejects(self, name: str, score: float, entropy: float, n: int) -> bool:
        """No letters, no language clearly ahead, or text less like its language than any labelled one."""
        if name == UNKNOWN or score < 0.5:
            return True
        if self.means is None:
            return False
        i = self.languages.index(name)
        return bool(entropy > self.means[i] + max(1.0, 8 * self.spreads[i] / max(n, 1) ** 0.5))


def _discount(ones: int, twos: int) -> float:
    return ones / (ones + 2 * twos) if ones and twos else 0.75


@dataclass
class Level:
    """Sequences of one order that a language's model holds, sorted.

    ``totals`` are the sums of the counts in each sequence's context, over all sequences
    that were seen, held or not; so is the discount.
    """

    keys: np.ndarray
    numbers: np.ndarray
    totals: np.ndarray
    discount: float


def build_model(languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]]) -> LanguageModel:
    """The model that holds all of each language's packed sequences (any order), by their counts."""
    levels: list[list[Level]] = [[] for _ in range(ORDER)]
    for keys, numbers in counts:
        order = np.argsort(keys)
        keys, numbers = keys[order], numbers[order]
        for level in range(ORDER):
            if level:
                mask = (np.uint64(1) << (_BITS * np.uint64(ORDER - level))) - np.uint64(1)
                keys, numbers = np.unique(keys & mask, return_counts=True)
            _, which = np.unique(keys >> _BITS, return_inverse=True)
            discount = _discount(int((numbers == 1).sum()), int((numbers == 2).sum()))
            levels[level].append(Level(keys, numbers, np.bincount(which, numbers)[which], discount))
    return assemble(languages, levels)


def assemble(languages: list[str], levels: list[list[Level]]) -> LanguageModel:
    """The model from the levels of each language, highest order first.

    The suffix of a sequence is held in the next level. What a context has beyond the
    sequences that are held is left to the next level, so probabilities add up to one.
    """
    model = LanguageModel(languages)
    if not languages:
        return model
    alphabet = len(np.unique(np.concatenate([x.keys for x in levels[-1]]))) + 1
    model.unseen = float(np.log(1 / alphabet))
    lower_keys, lower = None, None
    for level in range(ORDER - 1, -1, -1):
        union = np.unique(np.concatenate([x.keys for x in levels[level]]))
        contexts = np.unique(union >> _BITS)
        table = np.zeros((len(union), len(languages)))
        weights = np.ones((len(contexts), len(languages)))
        below = np.full((len(union), len(languages)), 1 / alphabet)
        if lower is not None:
            mask = (np.uint64(1) << (_BITS * np.uint64(ORDER - 1 - level))) - np.uint64(1)
            below = lower[np.searchsorted(lower_keys, union & mask)]
        for i, own in enumerate(levels[level]):
            share = np.zeros(len(union))
            share[np.searchsorted(union, own.keys)] = np.maximum(own.numbers - own.discount, 0) / own.totals
            at = np.searchsorted(contexts, union >> _BITS)
            weights[:, i] = np.maximum(1 - np.bincount(at, share, len(contexts)), 1e-9)
            table[:, i] = share + weights[at, i] * below[:, i]
        lower_keys, lower = union, table
        model.keys.insert(0, union)
        model.log_probabilities.insert(0, np.log(table).astype(np.float32))
        model.contexts.insert(0, contexts)
        model.log_weights.insert(0, np.log(weights).astype(np.float32))
    return model


def _count(labelled: DataFrame) -> DataFrame:
    """``lang, sequence, n`` of each task: few rows a task, summed by the caller."""
    out = pa.schema([("lang", pa.string()), ("sequence", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merge(parts: list) -> tuple[np.ndarray, np.ndarray]:
            keys, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(which, np.concatenate([n for _, n in parts])).astype(np.int64)

        def rows(lang: str) -> pa.RecordBatch:
            keys, numbers = merge(held.pop(lang))
            return batch_of(out, [[lang] * len(keys), keys.view(np.int64), numbers])

        for batch in slices(batches):
            langs = np.array(batch["lang"].to_pylist(), object)
            texts = np.array([t or "" for t in batch["text"].to_pylist()], object)
            for lang in dict.fromkeys(langs.tolist()):
                folded, _, _ = symbols(texts[langs == lang].tolist())
                packed = sequences(folded)[_ends_in_symbol(folded)]
                if not len(packed):
                    continue
                parts = held.setdefault(lang, [])
                parts.append(np.unique(packed, return_counts=True))
                if sum(len(k) for k, _ in parts) > 1 << 20:
                    held[lang] = [merge(parts)]
                    if len(held[lang][0][0]) > 1 << 19:
                        yield rows(lang)
        for lang in list(held):
            yield rows(lang)

    return map_arrow(labelled.select("lang", "text"), count, "lang string, sequence long, n long")


def _held(counts: DataFrame, sizes: dict[str, int], most: int) -> DataFrame:
    """The ``most`` most frequent sequences of each language, about; equal counts by a hash."""
    chosen = F.lit(True)
    for lang in (x for x, n in sizes.items() if n > most):
        own = counts.where(F.col("lang") == lang)
        least = own.approxQuantile("n", [1 - most / sizes[lang]], 0.001)[0]
        above, level = own.agg(F.count_if(F.col("n") > least), F.count_if(F.col("n") == least)).first()
        # the share of the sequences at the limit that there is room for
        room = int((1 << 20) * max(0, most - above) / max(1, level))
        ties = (F.col("n") == least) & (F.pmod(F.xxhash64("sequence"), F.lit(1 << 20)) < room)
        chosen = F.when(F.col("lang") == lang, (F.col("n") > least) | ties).otherwise(chosen)
    return counts.where(chosen).select("lang", "sequence")


def _levels(counts: DataFrame, held: DataFrame, languages: list[str], scratch: Scratch) -> list[list[Level]]:
    """Counts of the held sequences and of their suffixes.

    Context totals, continuation counts and discounts are those of all sequences.
    """
    levels = []
    for level in range(ORDER):
        if level:
            suffix = F.col("sequence").bitwiseAND(F.lit((1 << 16 * (ORDER - level)) - 1)).alias("sequence")
            counts = scratch.stage(counts.select("lang", suffix).groupBy("lang", "sequence").agg(F.count("*").alias("n")), "counts")
            held = held.select("lang", suffix).distinct()
        context = F.shiftrightunsigned("sequence", 16).alias("context")
        totals = counts.groupBy("lang", context).agg(F.sum("n").alias("total"))
        rows = counts.join(held, ["lang", "sequence"]).withColumn("context", context).join(totals, ["lang", "context"])
        # as many rows as languages, then at most the bound of sequences of each
        rare = counts.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect()
        discounts = {r["lang"]: _discount(r["ones"], r["twos"]) for r in rare}
        found = rows.select(F.array_position(F.lit(languages), F.col("lang")).cast("int").alias("at"), "sequence", "n", "total").toArrow()
        at, keys, numbers, sums = (found[c].to_numpy() for c in ("at", "sequence", "n", "total"))
        keys, order = keys.view(np.uint64), np.lexsort((keys.view(np.uint64), at))
        cuts = np.searchsorted(at[order], np.arange(1, len(languages) + 2))
        parts = [order[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        levels.append([Level(keys[p], numbers[p], sums[p], discounts[x]) for p, x in zip(parts, languages, strict=True)])
    return levels


def train(labelled: DataFrame, max_sequences: int = MAX_SEQUENCES) -> LanguageModel:
    """The model of the rows ``lang, text``.

    Counts, continuation counts, context totals and discounts cover every labelled row. The model
    holds at most about ``max_sequences`` sequences of each language, the most frequent, and
    their suffixes; this bounds what reaches the driver and the tasks. Others are scored by lower orders.
    Rejection is calibrated on every labelled row, too, by a second pass over their texts:
    the mean cross-entropy of each language and its spread by text length.
    Rows without a language or a text are left out; without rows the model is empty.
    """
    rows = labelled.where("lang is not null and text is not null").select("lang", "text")
    spark = rows.sparkSession
    with Scratch(spark, "language-model") as scratch:
        counts = scratch.stage(_count(rows).groupBy("lang", "sequence").agg(F.sum("n").alias("n")), "counts")
        # as many rows as there are languages
        sizes = {r["lang"]: r["count"] for r in counts.groupBy("lang").count().collect()}
        languages = sorted(sizes)
        model = assemble(languages, _levels(counts, _held(counts, sizes, max_sequences), languages, scratch) if languages else [])
    if languages:
        _calibrate(model, rows)
    return model


def _calibrate(model: LanguageModel, rows: DataFrame) -> None:
    shared = rows.sparkSession.sparkContext.broadcast(model)
    out = pa.schema([("lang", pa.string()), ("entropy", pa.float64()), ("n", pa.int64())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, _, entropies, counts = shared.value.predict(batch["text"].to_pylist())
            yield batch_of(out, [names, entropies, counts])

    measured = map_arrow(rows.select("text"), measure, "lang string, entropy double, n long").where("n > 0")
    sums = measured.groupBy("lang").agg(
        F.count("*").alias("rows"), F.sum("n").alias("n"), F.sum(F.expr("entropy * n")).alias("first"), F.sum(F.expr("entropy * entropy * n")).alias("second")
    )
    # as many rows as languages
    found = {r["lang"]: np.array(r[1:], float) for r in sums.collect()}
    whole = sum(found.values(), np.zeros(4))
    model.means, model.spreads = np.zeros(len(model.languages)), np.zeros(len(model.languages))
    for i, name in enumerate(model.languages):
        count, n, first, second = found.get(name, whole)
        model.means[i] = first / n if n else np.inf
        model.spreads[i] = np.sqrt(max(0.0, second - first * first / n) / count) if n else 0.0


def identify(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, cross_entropy, rejected`` of every row, from the text alone.

    ``und`` with score 0 for a null text or one without a letter. The score is the share of the chosen language
    among all, at the evidence of at most 40 characters. Repeated rows come back as often
    as they occur; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("cross_entropy", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            names, scores, entropies, counts = model.predict([t or "" for t in batch["text"].to_pylist()])
            gone = [model.rejects(*x) for x in zip(names, scores, entropies, counts, strict=True)]
            yield batch_of(out, [batch["id"], names, scores, entropies, gone])

    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return map_arrow(texts, run, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")


def keep_identified(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """``docs`` without the rows whose language is rejected; all columns stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            found = model.predict([t or "" for t in batch[text_column].to_pylist()])
            kept = pa.array([not model.rejects(*x) for x in zip(*found, strict=True)], pa.bool_())
            yield batch.filter(kept)

    return map_arrow(docs, run, docs.schema)
