"""Filter audit, BPE transducer and ranked search against brute force, on small hand-made tables."""

import codecs
import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from trendspark.llm import bpe_transducer as bpe
from trendspark.llm import filter_audit, lexical_search

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# columns whose names the operators use inside
COLUMNS = "doc_id long, text string, lang string, digest string, mask int, n long, id string, salt int, ids string, terms string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, p, "x", 1, 2, "y", 3, "z", "t") for i, t, p in rows], COLUMNS)


# --- filter audit -----------------------------------------------------------------


def fails(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        f for f, failed in zip(
            "ABCD",
            (len(found) < 100, 100 * len(set(found)) < 80 * len(found),
             100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search(r"[#$%&*|]", text))), strict=True,
        ) if failed
    }


def brute_audit(rows, labels):
    docs = []
    for i, text, part in rows:
        copy = i is not None and any(j is not None and j < i and (u or "") == (text or "") for j, u, _ in rows)
        docs.append((part or "", fails(text or "") | ({"E"} if copy else set()), i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = {}
    for order in permutations("ABCDE"):
        for part in {p for p, _, _ in docs}:
            held = [(f, i) for p, f, i in docs if p == part]
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [(f, i) for f, i in held if letter in f and not f & before]
                out[part, "".join(order), step] = [
                    sum(not f & (before | {letter}) for f, _ in held), len(here),
                    sum(letter in f and bool(f & before) for f, _ in held), sum(f == {letter} for f, _ in held),
                    sum(i in good for _, i in here), sum(i in toxic for _, i in here),
                ]
    total = Counter()
    for (part, order, step), values in out.items():
        total[part, order[step - 1]] += values[1]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, rows, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit_filters(documents(spark, rows), known).collect()
    keyed = {(r.part, r.filter_order, r.step): (*(r[m] for m in filter_audit.MEASURES), r.shapley) for r in found}
    assert len(keyed) == len(found)
    return keyed


def test_audit_equals_brute_force(spark):
    draw = random.Random(3)
    texts = [None, "", " \t\n", "A B C", "x" * 5000, "#", " word joined", "É" * 12 + "A"]
    for k in range(60):
        pool = [f"w{draw.randrange(draw.choice((30, 900)))}" for _ in range(draw.choice((20, 99, 100, 101, 300)))]
        texts.append(" ".join(w.upper() if draw.random() < 0.2 * (k % 3) else w for w in pool) + draw.choice(("", "", " |", " &")))
    rows = [(draw.randrange(40), draw.choice(texts), draw.choice(("en", "de", "", None))) for _ in range(160)]
    # one text holds a third of the rows, some rows are repeated, some have no id
    rows += [(100 + i, texts[20], "en") for i in range(80)] + [(7, texts[20], "de")] * 3
    rows += [(None, texts[20], "en")] * 5 + [(None, None, None), (None, "", "fr")]
    labels = [(i, draw.choice((0, 1, None)), draw.choice((0, 1, None))) for i in range(0, 180, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    expected = brute_audit(rows, labels)
    assert audited(spark, rows, labels) == expected
    assert len(expected) == 600 * len({p or "" for _, _, p in rows})


def test_audit_of_no_rows_and_no_labels(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}
    assert set(audited(spark, [(1, "one", "en")], [])) == {("en", "".join(o), s) for o in permutations("ABCDE") for s in range(1, 6)}


# --- byte-level BPE ---------------------------------------------------------------


@pytest.fixture(scope="module")
def tokens():
    return bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def encoder(tokens):
    return bpe.Encoder(tokens, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def public(tokens):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={}
    )


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("ab 's\n\u00a0\x1cé1.", max_size=40)))
def test_encoding_equals_the_public_library_on_any_text(encoder, public, text):
    assert ids_of(encoder.encode(text)) == public.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 5000, " " * 700 + "x", "\n\n \r\n\t a", "漢字かな" * 200, "it's we'LL 12345678901234567890", "🙂🙃" * 50, "<|endoftext|>"])
def test_encoding_of_runs_and_scripts(encoder, public, text):
    assert ids_of(encoder.encode(text)) == public.encode_ordinary(text)


def test_encoding_of_joined_tokens(encoder, public, tokens):
    draw = random.Random(1)
    for _ in range(3000):
        text = b"".join(draw.choice(tokens) for _ in range(draw.randrange(1, 6))).decode("utf-8", "ignore")
        assert ids_of(encoder.encode(text)) == public.encode_ordinary(text)


def test_machine_equals_the_definition_on_a_small_vocabulary():
    draw = random.Random(2)
    for _ in range(30):
        # merges in any order, so that a part may have a higher rank than the whole
        found = {bytes((b,)) for b in range(256)}
        letters = [t for t in found if t in (b"a", b"b", b"c")]
        for _ in range(14):
            made = draw.choice(letters) + draw.choice(letters)
            if made not in found and len(made) < 9:
                found.add(made)
                letters.append(made)
        many = [t for t in found if len(t) > 1]
        draw.shuffle(many)
        table = [bytes((b,)) for b in range(256)] + many
        ranks = {t: i for i, t in enumerate(table)}
        machine = bpe.Transducer(table)
        for _ in range(120):
            unit = bytes(draw.choice(b"abc") for _ in range(draw.randrange(1, 24)))
            whole = [ranks[unit]] if unit in ranks else bpe.merge(unit, ranks)
            assert ids_of(machine.encode_unit(unit)) == whole


def test_tokens_are_written_after_bounded_lookahead(encoder, tokens):
    """What is held back is never longer than the longest token."""
    longest = max(map(len, tokens))
    state, unit = encoder.transducer.start, ("abcabd" * 40 + "undoubtedly" * 9).encode()
    for byte in unit:
        step = encoder.transducer._step(state, byte)
        state = step[0] if isinstance(step, tuple) else step
        assert all(sum(len(tokens[t]) for t in held) <= longest for held, _, _ in state.possible)


def test_tables_begin_anew_beyond_their_bounds(tokens, public, monkeypatch):
    for name in ("MAX_STATES", "MAX_PAIRS", "MAX_UNITS"):
        monkeypatch.setattr(bpe, name, 5)
    small = bpe.Encoder(tokens, public_tokenizers.PATTERN)
    draw = random.Random(5)
    for _ in range(200):
        text = " ".join("".join(draw.choices("etaoinshr", k=draw.randrange(1, 12))) for _ in range(8))
        assert ids_of(small.encode(text)) == public.encode_ordinary(text)


def test_a_vocabulary_needs_every_byte():
    with pytest.raises(ValueError, match="every byte"):
        bpe.Transducer([b"a", b"b", b"ab"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.binary(max_size=6), max_size=8))
def test_utf8_stream_equals_decoding_at_once(chunks):
    stream = bpe.Utf8Stream()
    assert "".join(map(stream.feed, chunks)) + stream.close() == b"".join(chunks).decode("utf-8", "replace")


def test_utf8_stream_gives_whole_characters_early():
    for character in "aéह漢🙂":
        stream, machine = bpe.Utf8Stream(), codecs.getincrementaldecoder("utf-8")()
        for byte in character.encode():
            assert stream.feed(bytes((byte,))) == machine.decode(bytes((byte,)))


def test_stream_of_ids(encoder, tokens):
    text = "漢字 and 🙂 or naïve\n" * 40
    ids = np.frombuffer(encoder.encode(text), "<u4")
    for chunk in (1, 2, 7, 10_000):
        assert "".join(bpe.decode_stream(ids, tokens, chunk)) == text
    with pytest.raises(ValueError):
        list(bpe.decode_stream(np.array([len(tokens)], "<u4"), tokens))


def test_encoded_documents(spark, public):
    texts = [None, "", "  ", "plain words here", "漢字", "x" * 30_000, "plain words here", "\u0000 odd ﻿"]
    rows = [(i if i != 4 else None, t, None) for i, t in enumerate(texts)] + [(3, "plain words here", "en")]
    encoded = bpe.encode_documents(documents(spark, rows), RANKS, public_tokenizers.PATTERN)
    found = bpe.decode_documents(encoded, RANKS).collect()
    expected = [(i, public.encode_ordinary(t or ""), t or "") for i, t, _ in rows]
    key = repr
    assert sorted(((r.doc_id, ids_of(r.ids), r.text) for r in found), key=key) == sorted(expected, key=key)
    both = bpe.round_trip(documents(spark, rows), RANKS, public_tokenizers.PATTERN)
    assert sorted(map(tuple, both.collect()), key=key) == sorted(map(tuple, found), key=key)
    none = bpe.encode_documents(documents(spark, []), RANKS, public_tokenizers.PATTERN)
    assert bpe.decode_documents(none, RANKS).collect() == []


# --- ranked search ----------------------------------------------------------------


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_search(rows, items, k=10):
    docs = [(i, words_of(t)) for i, t, _ in rows]
    docs = [(i, w, Counter(w)) for i, w in docs if w]
    n, total = len(docs), sum(len(w) for _, w, _ in docs)
    holding = Counter(t for _, _, c in docs for t in c)
    out = {}
    for item, text in items:
        asked = Counter(words_of(text))
        found = []
        for doc, w, counts in docs:
            m = 25 + (75 * len(w) * n) // total
            score = sum(
                q * math.floor(1000 * math.log((2 * n + 2) / (2 * holding[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t, q in asked.items() if t in counts
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out[item] = [(doc, -minus) for minus, _, _, doc in sorted(found, key=lambda f: f[:3])[:k]]
    return {item: best for item, best in out.items() if best}


def searched(spark, rows, items, **options):
    queries = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, item string")
    found = {}
    for r in sorted(lexical_search.search(documents(spark, rows), queries, **options).collect(), key=lambda r: (r.item_id, r.rank)):
        held = found.setdefault(r.item_id, [])
        assert r.rank == len(held) + 1
        held.append((r.doc_id, r.score))
    return found


def corpus(seed=4, n=300):
    draw = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    rows = [(1000 - i, " ".join(draw.choices(vocabulary, weights, k=draw.choice((3, 10, 60)))), "en") for i in range(n)]
    rows += [(None, rows[0][1], None), (5, None, "en"), (6, "", "en"), (7, " ...! ", "en"), (8, "T0 Ünïcode 漢字 t0_t1", "en")]
    rows += [(2000 + i, rows[1][1], "en") for i in range(150)] + [rows[2]] * 3
    rows.append((9, "t3 " * 20_000, "en"))
    items = [(k, " ".join(draw.choices(vocabulary, weights, k=12))) for k in range(25)]
    return rows, items + [(90, "T0 T0 t5"), (91, "ünïcode 漢字"), (92, "nothing here"), (93, None), (94, ""), (95, rows[1][1]), (95, rows[1][1]), (None, "t1")]


@pytest.mark.parametrize("k", [1, 10, 400])
def test_search_equals_brute_force(spark, k):
    rows, items = corpus()
    assert searched(spark, rows, items, k=k) == brute_search(rows, [i for i in items if i[0] is not None], k)


def test_search_over_many_blocks_and_passes(spark, monkeypatch):
    rows, items = corpus(6, 120)
    monkeypatch.setattr(lexical_search, "PASS_BYTES", 400)
    held = documents(spark, rows).repartition(3)
    queries = spark.createDataFrame(items, "item_id long, text string")
    found = lexical_search.search(held, queries).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.item_id, r.rank)):
        got.setdefault(r.item_id, []).append((r.doc_id, r.score))
    assert got == brute_search(rows, [i for i in items if i[0] is not None])


def test_search_without_rows(spark):
    rows, items = corpus(7, 10)
    assert searched(spark, [], items) == {} == searched(spark, rows, [])
    assert searched(spark, [(1, None, "en"), (2, "", "en")], items) == {}
    with pytest.raises(ValueError):
        lexical_search.search(documents(spark, rows), documents(spark, []).selectExpr("id AS item_id", "text"), k=0)


def test_best_positions_stop_before_the_lists_end():
    """A block with a clear winner is left after few accesses, with the same best as a full sum."""
    rng = np.random.default_rng(8)
    terms, docs = np.divmod(rng.choice(20 * 5000, size=40_000, replace=False), 5000)
    impacts = rng.pareto(2.0, len(terms)).__mul__(1000).astype(np.int64) + 1
    winner = docs == docs[0]
    impacts[winner] += 1_000_000
    block = lexical_search.Block(terms.astype(np.int64), docs.astype(np.int64), impacts)
    names, repeats = np.arange(20), rng.integers(1, 4, 20)
    found, scores, accesses = lexical_search.search_block(block, names, repeats, 1, 0)
    whole = np.zeros(5000, np.int64)
    np.add.at(whole, docs, impacts * repeats[terms])
    assert found[scores.argmax()] == whole.argmax() and scores.max() == whole.max()
    assert accesses < 20 * 5000 / 2
    # nothing can reach the least score that is asked for
    assert lexical_search.search_block(block, names, repeats, 1, int(whole.max()) + 10**9)[2] == 0


def test_places_seen_by_direct_access_raise_the_best_position():
    seen = np.array([1, 1, 0, 1, 1, 1, 1, 0], bool)
    best = lexical_search.best_positions(seen, np.array([0, 3]), np.array([3, 8]), np.zeros(2, np.int64))
    assert best.tolist() == [2, 4]
