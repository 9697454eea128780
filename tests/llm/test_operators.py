"""The training-data operators against brute force, on small hand-made tables."""

import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trendspark.llm import chat, decontaminate, fingerprint, language_id, licenses, line_dedup, near_dedup, packing, pii, token_store
from trendspark.llm.common import join_counted, map_arrow
from trendspark.llm.components import connected_components
from trendspark.llm.ordered import bucket_of
from trendspark.llm.token_ids import _RARE, Encoder
from trendspark.staging import Scratch, new_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id string, value int, bucket int"


def table(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", None, "x", 1, 2) for i, t in rows], COLUMNS)


def words(n, seed, vocabulary=400):
    draw = random.Random(seed)
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


def odd_rows():
    base = words(120, 1)
    changed = base[:60] + ["other"] + base[61:]
    return [
        (1, None), (2, ""), (3, "   "), (4, "one two"), (5, "ONE Two"), (6, " ".join(base)), (7, " ".join(changed)),
        (8, " ".join(base)), (8, " ".join(base)), (None, " ".join(base)), (9, " ".join(words(120, 2))),
        (10, "x" * 30_000), (11, " ".join(words(6000, 3))),
    ]


def brute_components(rows, most, whole):
    def shingles(text):
        found = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (a, s) in enumerate(sets):
        for b, t in sets[:x]:
            if s and t and whole * len(s & t) >= most * len(s | t):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in parent}, {i: len(s) for i, s in sets}


def test_near_duplicates_equal_brute_force(spark):
    rows = odd_rows()
    # a chain of near copies, a star of copies whose ends are not linked, and a large group
    base = words(200, 5)
    for k in range(40):
        draw = random.Random(k)
        copy = list(base)
        for _ in range(draw.choice((1, 2, 3, 4))):
            copy[draw.randrange(200)] = f"n{k}_{draw.randrange(99)}"
        rows.append((100 + k, " ".join(copy)))
    components, sizes = brute_components(rows, 85, 100)
    found = near_dedup.near_duplicates(table(spark, rows), (85, 100)).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.component_id, r.n_shingles) == (components[r.doc_id], sizes[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)
    kept = near_dedup.drop_near_duplicates(table(spark, rows), threshold=(85, 100))
    assert kept.columns == table(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(components.values()))


def test_blocks_find_links_that_no_pivot_shows(spark):
    """Links across components come from the block comparison, too."""
    base = words(200, 6)
    rows = [(k, " ".join(base[: 200 - 9 * k] + words(9 * k, 50 + k))) for k in range(12)]
    components, _ = brute_components(rows, 85, 100)
    found = near_dedup.near_duplicates(table(spark, rows), (85, 100)).collect()
    assert {r.doc_id: r.component_id for r in found} == components


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 60).selectExpr("id AS a", "id - 1 AS b")
    with Scratch(spark, "t") as scratch:
        assert {r.component for r in connected_components(links, scratch).collect()} == {0}
        assert connected_components(links.where("a < 0"), scratch).isEmpty()


def test_empty_tables(spark):
    none = table(spark, [])
    assert near_dedup.near_duplicates(none).count() == 0
    assert fingerprint.compare_with_next(none).count() == 0
    assert line_dedup.repeated_passages(none).count() == 0
    assert pii.personal_data(none).count() == 0
    assert packing.pack_documents(none, TOKENIZER).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(none, items).count() == 0
    assert language_id.identify(none, language_id.train(none.selectExpr("doc_id key", "lang", "text"))).count() == 0
    assert licenses.scan_licenses(none.selectExpr("source path", "text")).count() == 0
    path = new_path(spark, "none")
    token_store.write_token_ids(none, path, TOKENIZER)
    assert token_store.read_token_ids(spark, path).count() == 0
    segments = chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert chat.read_back(segments, chat.expand_examples(segments)).count() == 0


def test_fingerprints(spark):
    rows = [(5, "abc " * 500), (1, None), (3, "".join(words(900, 4))), (9, "é" * 7), (7, "abc " * 500)]
    found = {r.doc_id: r for r in fingerprint.compare_with_next(table(spark, rows)).collect()}
    texts = {i: t or "" for i, t in rows}
    order = sorted(texts)
    for i, after in zip(order, order[1:] + order[:1], strict=True):
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[after][:half]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprint.digest(texts[i]), fingerprint.digest(edited))
        assert r.near_next == fingerprint.likeness(r.fingerprint, fingerprint.digest(texts[after]))
    assert found[5].fingerprint == found[7].fingerprint and fingerprint.likeness(found[5].fingerprint, found[7].fingerprint) == 1
    assert fingerprint.compare_with_next(table(spark, [(4, "only")])).first().near_next == 1


def test_encoder_equals_the_tokenizer():
    encoder, draw = Encoder(TOKENIZER), random.Random(7)
    parts = [" ", "  ", "\n", "\t", "a", "1", "'s", "é", ".", "<|endoftext|>", "\u00a0", "日", "\x1c", "\u200b", "ll", "<|", "\U0001f600", "²", "\r"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        assert encoder.encode(text, 2)[:-1].tolist() == encoder.encode_whole(text).tolist(), repr(text)


def test_many_texts_at_once_equal_the_tokenizer():
    encoder, draw = Encoder(TOKENIZER), random.Random(8)
    parts = [" ", " ", "\n", "\n\n", "a", "The", "'s", "é", ".", ",", "<|endoftext|>", "日", "1", " b", "x.\nY", ".\n", "\t", "\r", "²", "ʰ"]
    texts = [None, "", *("".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(3000))]
    found = list(encoder.encode_texts(texts, 2))
    assert len(found) == len(texts)
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == [*encoder.encode_whole(text or "").tolist(), 2], repr(text)


def test_pieces_that_come_again_are_learned_twice_at_most(monkeypatch):
    encoder, learned = Encoder(TOKENIZER), []
    monkeypatch.setattr(Encoder, "_learn", lambda self, missing, learn=Encoder._learn: learned.append(missing) or learn(self, missing))
    text = "The sea, the land.\nThe end, the sea, and (so) on."
    for _ in range(4):
        assert encoder.encode(text, 0)[:-1].tolist() == encoder.encode_whole(text).tolist()
    assert len(learned) == 2


def test_known_words_with_a_mark_and_pieces_of_the_older_table_are_not_learned(monkeypatch):
    encoder, learned = Encoder(TOKENIZER), []
    monkeypatch.setattr(Encoder, "_learn", lambda self, missing, learn=Encoder._learn: learned.extend(missing) or learn(self, missing))
    for full in (False, True):
        if full:
            monkeypatch.setattr("trendspark.llm.token_ids.MAX_PIECES", 1)
        for text in ("on sea and élan", "on sea, and. élan; sea?", "on and. élan"):
            assert encoder.encode(text, 0)[:-1].tolist() == encoder.encode_whole(text).tolist()
        assert not {"sea,", "and.", "élan;", "sea?"}.intersection(learned)
        encoder.encode("on full table", 0)
    assert sorted(learned) == ["  on", "and", "full", "sea", "table", "élan"]


def test_latin_letters_go_to_the_model_and_others_to_the_whole_tokenizer(monkeypatch):
    draw, split = random.Random(11), []
    encode_units = Encoder._encode_units
    monkeypatch.setattr(Encoder, "_encode_units", lambda self, units: split.extend(units) or encode_units(self, units))
    latin, others = "abdehinorstAEOTéèüßñÿªµ", "λяжשؤ日本한ʰœĀ"
    texts = [
        " ".join("".join(draw.choices(draw.choice((latin, latin, latin + others)), k=draw.randint(1, 9))) for _ in range(draw.randint(1, 40)))
        for _ in range(300)
    ]
    encoder = Encoder(TOKENIZER)
    for text, ids in zip(texts, encoder.encode_texts(texts, 2), strict=True):
        assert ids.tolist() == [*encoder.encode_whole(text).tolist(), 2], repr(text)
    assert split and all(set(unit) & set(others) for unit in split)


def test_white_space_that_is_no_seam_is_known_in_full():
    spaces = {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()}
    assert spaces == {" ", "\n", *_RARE} and all(re.match(r"\s", c) for c in spaces)


def test_other_tasks_give_back_the_encoders_of_their_worker(spark):
    def held(batches):
        import sys

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [int("_trendspark_encoders" in sys.modules)]})

    def fill(batches):
        from trendspark.llm.token_ids import shared_encoder

        shared_encoder(TOKENIZER)
        yield from held(batches)

    rows = spark.range(1).coalesce(1)
    for _ in range(3):
        assert map_arrow(rows, fill, "n long", encodes=True).first().n == 1
        assert map_arrow(rows, held, "n long").first().n == 0


def test_tasks_give_back_the_memory_of_their_arrays():
    class Table:
        class sparkSession:  # noqa: N801
            class conf:  # noqa: N801
                get = staticmethod(lambda _: "1")

        def mapInArrow(self, function, _schema):  # noqa: N802
            return list(function(iter([])))

    def resident():
        return int(re.search(r"Anonymous: +(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

    kept, took = [], []

    def fill(_batches):
        # arrays of a text's size come from the heap; the one that stays is above all others
        arrays = [np.ones(100_000, np.uint8) for _ in range(1_500)]
        kept.append(arrays[-1])
        took.append(resident())
        yield None

    for encodes in (False, True):
        map_arrow(Table(), fill, "n long", encodes=encodes)
        assert resident() < took[-1] - 100


def expected_ids(rows, end):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    order = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    return [(i, np.array([*tokenizer.encode(t, add_special_tokens=False).ids, end], "<u4")) for i, t in order]


def test_token_store_round_trip(spark):
    rows = odd_rows()
    path = new_path(spark, "ids")
    token_store.write_token_ids(table(spark, rows), path, TOKENIZER)
    found = sorted(tuple(r) for r in token_store.read_token_ids(spark, path).collect() if r.doc_id is not None)
    start, expected = 0, []
    for i, ids in expected_ids(rows, 2):
        if i is not None:
            expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == sorted(expected)


@pytest.mark.parametrize("lengths", [[1], [1] * 300, [70_000, 1, 5], list(range(1, 200))])
def test_elias_fano_block(lengths):
    ids = np.arange(sum(lengths), dtype=np.uint32) % 70_000
    block = token_store.Block(token_store.encode_block(np.arange(len(lengths)), np.array(lengths), ids))
    ends = np.cumsum(lengths)
    assert block.ends().tolist() == ends.tolist() == [block.end(i) for i in range(block.n)]
    assert block.document(len(lengths) - 1).tolist() == ids[ends[-1] - lengths[-1] :].tolist()


def test_packing_is_whole_and_tight(spark):
    rows = odd_rows()
    found = packing.pack_documents(table(spark, rows), TOKENIZER).collect()
    ids = {i: x for i, x in expected_ids(rows, 0)}
    for r in found:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert sum(r.length for r in found) == sum(len(x) for _, x in expected_ids(rows, 0))
    for number in {r.sequence_id for r in found}:
        at = 0
        for r in sorted((r for r in found if r.sequence_id == number), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_best_fit_takes_the_tightest_window():
    draw = random.Random(9)
    lengths = np.array([draw.randint(1, 64) for _ in range(400)])
    numbers, offsets = packing.best_fit_decreasing(lengths, 64)
    room: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):
        fit = [r for r in room if r >= lengths[i]]
        before = 64 - offsets[i]
        assert before == (min(fit) if fit else 64)
        if fit:
            room.remove(min(fit))
        room.append(before - lengths[i])
    assert numbers.max() + 1 == len(room)


def test_two_texts_of_one_id_are_two_documents(spark):
    base, other = " ".join(words(150, 21)), " ".join(words(150, 22))
    near = base.replace(" ", " x ", 1)
    rows = [(1, base), (1, other), (1, base), (2, near), (3, other), (3, " ".join(words(90, 23))), (4, base), (0, " ".join(words(70, 24))), (0, near)]
    found = near_dedup.near_duplicates(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(
        (i, len(near_dedup.shingle_set(t, 5)), 0 if t in (base, near) else 1 if t == other else i) for i, t in rows
    )
    kept = near_dedup.drop_near_duplicates(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(1, other), rows[5], rows[7], (0, near)])


def test_symbols_beyond_the_basic_plane():
    model = language_id.LanguageModel(["en"])
    _, _, letters = language_id.symbols(["\U0001f600\U0001f601", "\U00010330\U00010331", "a\U0001f600"])
    assert letters.tolist() == [0, 2, 1]
    assert model is not None


def brute_passages(rows):
    """Runs of repeated sentences, by dictionaries of normalised texts."""
    seen, texts = {}, sorted({(i, t) for i, t in rows if i is not None and t is not None})
    for i, t in texts:
        for n, (_, _, normal) in enumerate(line_dedup.cut_units(t)):
            seen.setdefault(normal, []).append((i, n))
    found = []
    for i, t in texts:
        run = []
        for n, (start, end, normal) in enumerate([*line_dedup.cut_units(t), (0, 0, None)]):
            first = min(seen.get(normal, [(i, n)]))
            if first != (i, n):
                run.append((start, end, first[0]))
            elif run:
                found.append((i, run[0][0], run[-1][1], len(run), run[0][2]))
                run = []
    return sorted(found)


def test_units_tile_their_lines():
    draw = random.Random(1)
    for _ in range(500):
        text = "".join(draw.choice("ab .!?\n\té3") for _ in range(draw.randrange(60)))
        at, lines = 0, text.split("\n")
        for line in lines:
            assert "".join(m[0] for m in re.finditer(line_dedup.SENTENCE, line)) == line
        for start, end, normal in line_dedup.cut_units(text):
            assert start >= at and line_dedup.normalise(text[start:end]) == normal and "\n" not in text[start:end]
            at = end
    assert [u[2] for u in line_dedup.cut_units("Version 3.5 is out. It works!  Really?\n\n ok")] == [
        "version 3.5 is out.", "it works!", "really?", "ok"
    ]


def test_repeated_passages_equal_brute_force(spark):
    same = "this line has words"
    passage = "One sentence of a passage. Another one of it! And a third, the last of all."
    rows = [
        (2, f"{same}\nshort\nown line of document two"), (1, f"first\n  THIS line\thas words \n{same}"), (3, None), (4, ""), (5, "short"),
        (6, f"Before it there was this. {passage} After it came that."), (7, f"Something else. {passage} Something new."),
        (8, "漢字の行\n" * 3), (9, "x" * 20_000), (10, "x" * 20_000), (None, passage), (11, "... ! ?"), (11, "... ! ?"),
        # two texts of one id, of which one repeats nothing
        (12, f"{same} and more of it here that is new\nshort"), (12, "totally different text that repeats nothing at all"),
        (13, ". ".join(f"s{k % 7}" for k in range(400))), *((20 + k, "everywhere the same.") for k in range(300)),
    ]
    found = line_dedup.repeated_passages(table(spark, rows)).collect()
    got = sorted((r.doc_id, r.start_char, r.end_char, r.n_units, r.kept_doc_id) for r in found)
    assert got == brute_passages(rows)
    (run,) = [r for r in found if r.doc_id == 7]
    assert rows[6][1][run.start_char : run.end_char].strip() == passage and (run.n_units, run.n_words) == (3, 16)
    cut = sorted((r.doc_id or 0, r.text or "") for r in line_dedup.drop_repeated_passages(table(spark, rows)).collect())
    assert len(cut) == len(rows)
    by_id = dict(cut)
    assert by_id[1] == "first\n  THIS line\thas words \n" and by_id[2] == "short\nown line of document two" and by_id[5] == ""
    assert by_id[7] == "Something else. Something new." and by_id[8] == "漢字の行\n" and by_id[10] == ""
    assert (12, "totally different text that repeats nothing at all") in cut
    assert (12, f"{same} and more of it here that is new\n") in cut


def test_large_groups_of_units_are_joined_by_broadcast(spark):
    rows = spark.range(4000).selectExpr("id", "if(id % 2 = 0, 'hot', concat('k', id % 900)) AS key")
    groups = rows.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    found = join_counted(rows, groups, "key", "n")
    assert "Union" in found._jdf.queryExecution().toString()
    plain = rows.join(groups, "key")
    assert found.count() == 4000 and found.exceptAll(plain).count() == 0


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "a<|end|>\\<|b|>"), (1, 1, "assistant", "\\|>x<|\n"), (1, 2, "assistant", None), (2, None, None, "q"), (None, 0, "user", "z"), (3, 600, "assistant", "late"), (3, 0, "user", "early")]
    segments = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = {r.conv_id: r for r in chat.read_back(segments, chat.expand_examples(segments)).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert found[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (found[conv].n_turns, found[conv].loss_chars, found[conv].loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    examples = chat.expand_examples(segments).where("conv_id = 1").orderBy("turn").collect()
    texts = chat.example_texts(segments).where("conv_id = 1").orderBy("turn").collect()
    assert len(examples) == len(texts) == 2
    for e, t in zip(examples, texts, strict=True):
        assert len(t.prompt) == e.loss_start and len(t.prompt + t.reply) == e.example_end and t.reply.endswith(chat.END)


def test_plain_personal_data_equals_brute_force():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    draw = random.Random(3)
    for _ in range(20_000):
        text = "".join(draw.choice("aA1@@..-_%+ 0123()é9") for _ in range(draw.randint(0, 40)))
        found = [("email", *m.span()) for m in email.finditer(text)]
        found += [("ip", *m.span()) for m in ip.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
        found += [("card", *m.span()) for m in card.finditer(text) if 12 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and pii._luhn(d)]
        found += [("phone", *m.span()) for m in phone.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        assert pii.plain_spans(text) and sorted(pii.find_spans(text)[0]) == sorted(found) or not found


@pytest.mark.parametrize(
    "text, kind, hidden",
    [
        ("write to john [at] example [dot] com!", "email", "john [at] example [dot] com"),
        ("jane dot doe at mail dot example dot org", "email", "jane dot doe at mail dot example dot org"),
        ("see аlice@exаmple.com", "email", "аlice@exаmple.com"),
        ("+one two three four five six seven eight nine zero", "phone", "+one two three four five six seven eight nine zero"),
        ("four one one one one one one one one one one one one one one one", "card", None),
        ("１９２.168.1.1 is it", "ip", "１９２.168.1.1"),
        ("ask john [at] example dot com now", "email", "john [at] example dot com"),
        ("ask john at example [dot] com now", "email", "john at example [dot] com"),
        ("john@example dot com", "email", "john@example dot com"),
        ("jane dot doe (at) example.com", "email", "jane dot doe (at) example.com"),
        ("jаne at mail (dot) example dot org", "email", "jаne at mail (dot) example dot org"),
        ("host 192 dot 168 dot 1 dot 1 is up", "ip", "192 dot 168 dot 1 dot 1"),
        ("one nine two dot one six eight dot one dot one", "ip", None),
        ("10[.]0 dot zero (dot) 1", "ip", None),
    ],
)
def test_disguised_personal_data(text, kind, hidden):
    plain, found = pii.find_spans(text)
    assert not plain and [(k, text[a:b]) for k, a, b in found] == [(kind, hidden or text)]
    assert (hidden or text) not in pii.mask(text)


def test_mixed_disguises_need_a_disguise():
    for text in ("meet john at example.com today", "look at the dot com", "a polka dot at the dot com crash", "stay at home dot"):
        assert pii.find_spans(text) == ([], [])
    text = "a@b.org dot by dot"
    assert [(k, text[a:b]) for k, a, b in pii.find_spans(text)[1]] == [("email", "a@b.org")]


def test_long_texts_null_ids_and_repeated_rows_of_personal_data(spark):
    lead = "plain words and more of them. " * 100_000
    text = f"{lead}john [at] example dot com"
    rows = [(None, text, "x"), (1, text, "x"), (1, text, "x"), (2, "", None), (3, None, None)]
    found = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    expected = f"email:{len(lead)}:{len(text)}"
    assert sorted((str(r.doc_id), r.n_email, r.spans) for r in found) == sorted(
        [("None", 1, expected), ("1", 1, expected), ("1", 1, expected), ("2", 0, ""), ("3", 0, "")]
    )


def test_prose_is_left_alone(spark):
    for text in ("look at example.com", "I am at home (at) noon", "one two three go", "", None, "meet at the dot com"):
        assert pii.find_spans(text) == ([], [])
    masked = pii.mask_personal_data(table(spark, [(1, "a@b.co x"), (2, None), (3, "clean")])).collect()
    assert [r.text for r in masked] == ["[EMAIL] x", None, "clean"]


def test_edit_distance_equals_dynamic_programming():
    draw = random.Random(1)
    for _ in range(500):
        item = np.array([draw.randint(0, 3) for _ in range(draw.randint(1, 9))])
        text = np.array([draw.randint(0, 3) for _ in range(draw.randint(1, 14))])
        row = [0] * (len(text) + 1)
        for i, code in enumerate(item, 1):
            last, row = row, [i]
            for j, other in enumerate(text, 1):
                row.append(min(last[j - 1] + (code != other), last[j] + 1, row[-1] + 1))
        assert decontaminate.least_edits(item, text) == min(row) == decontaminate.edit_span(item, text)[0]


def test_contaminated_documents(spark):
    items = [(k, " ".join(words(30, 900 + k, 5000))) for k in range(20)] + [(98, None), (99, "too short")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows, expected = [(900, None), (901, ""), (902, " ".join(words(4000, 77, 5000)))], set()
    for k, text in items[:20]:
        changed = text.split()
        changed[10] = "changed"
        del changed[20]
        lead = " ".join(words(300, k, 5000))
        rows.append((k, f"{lead} {' '.join(changed).upper()}, and more"))
        expected.add((k, k))
    found = decontaminate.contaminated(table(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected
    for r in found:
        text = dict(rows)[r.doc_id]
        assert text[r.start_char : r.end_char].lower().split()[0] == items[r.item_id][1].split()[0]
    kept = decontaminate.drop_contaminated(table(spark, rows), benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == [900, 901, 902]


def _edited(draw, text, share, kinds):
    """``text`` with a share of its characters (of its words for ``w``) substituted, inserted or deleted."""
    parts = text.split() if kinds == "w" else list(text)
    for i in draw.sample(range(len(parts)), int(share * len(parts))):
        kind, new = draw.choice(kinds), "".join(draw.choice("abcdefghij") for _ in range(5 if kinds == "w" else 1))
        parts[i] = {"s": new, "w": new, "i": parts[i] + new, "d": ""}[kind]
    return (" " if kinds == "w" else "").join(parts)


@pytest.mark.parametrize("n_words", [6, 14, 40])
@pytest.mark.parametrize(("kinds", "share"), [("s", 0.05), ("s", 0.1), ("s", 0.18), ("sid", 0.1), ("sid", 0.18), ("w", 0.1)])
def test_search_reaches_its_target_recall(n_words, kinds, share):
    draw = random.Random(n_words)
    items = [(k, " ".join(words(n_words, 50 + k, 3000))) for k in range(60)]
    index = decontaminate.ItemIndex(items)
    found = there = 0
    for k, text in items:
        lead, rest = " ".join(words(30, 700 + k, 3000)), " ".join(words(30, 800 + k, 3000))
        whole = f"{lead} {_edited(draw, text, share, kinds)} {rest}"
        item = decontaminate.normal_codes(text)
        # brute force: the least edit distance to any part of the text
        if decontaminate.least_edits(item, decontaminate.normal_codes(whole)) <= int(0.2 * len(item)):
            there += 1
            found += any(hit[1] == k for hit in decontaminate.hits([whole], index, 0.2))
    assert there > 20 and found >= (0.9 if share < 0.15 else decontaminate.TARGET_RECALL) * there


def test_search_looks_at_every_character():
    draw = random.Random(3)
    items = [(k, " ".join("".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)) for _ in range(14))) for k in range(60)]
    index = decontaminate.ItemIndex(items)
    found = 0
    for k, text in items:
        # no word of the item begins a word here: blanks have moved by five characters
        whole = "lead " + "zz" + re.sub(r" (\w{5})", r"\1 ", text)
        item = decontaminate.normal_codes(text)
        assert decontaminate.least_edits(item, decontaminate.normal_codes(whole)) <= int(0.2 * len(item))
        found += any(hit[1] == k for hit in decontaminate.hits([whole], index, 0.2))
    assert found >= 0.9 * len(items)


def test_walk_hashes_differ_where_keys_do():
    held = np.concatenate((np.random.default_rng(5).integers(97, 101, 3000), np.zeros(34, np.int64))).astype(np.uint8)
    pairs = decontaminate.paired(held)
    for steps, walk in ((34, 0), (34, 1), (26, 1), (20, 3)):
        starts, keys, _ = decontaminate.part_keys(pairs, np.arange(3000), steps, walk)
        hashes = decontaminate.walk_hashes(held, 3000, steps, walk)[starts]
        found = len(np.unique(keys))
        assert 20 < found == len(np.unique(hashes)) == len(np.unique(np.stack((keys, hashes.astype(np.uint64))), axis=1).T)
        short = decontaminate.walk_hashes(held, 3000, steps, walk, 16)[starts]
        assert len(np.unique(np.stack((keys, short.astype(np.uint64))), axis=1).T) == found
        for width, values in ((32, hashes), (16, short)):
            known = decontaminate.WalkFilter(values[::7], width)
            assert set(range(0, len(values), 7)) <= set(known.passing(values).tolist())


def test_unedited_items_are_found_at_whole_characters():
    text = np.array([1, 1 << 8, 1 << 16, 256, 1, 2], np.uint32)
    assert decontaminate.unedited_at(text[3:5], text) == 3 and decontaminate.unedited_at(text[:1], text) == 0
    # these bytes stand between two characters
    assert decontaminate.unedited_at(np.array([1 << 24], np.uint32), text) == -1
    assert decontaminate.unedited_at(np.array([256, 7], np.uint32), text) == -1


def test_piece_edits_equal_dynamic_programming():
    draw = np.random.default_rng(5)
    held = draw.integers(0, 4, 400).astype(np.uint8)
    pieces = [draw.integers(0, 4, n).astype(np.uint8) for n in (1, 5, 33, 63, 64)]
    begins, columns = np.array([0, 7, 100, 250, 399]), np.array([90, 90, 90, 90, 90])
    found = decontaminate.piece_edits(held, pieces, begins, columns)
    for piece, begin, edits in zip(pieces[:4], begins[:4], found[:4], strict=True):
        assert edits == decontaminate.least_edits(piece, held[begin : begin + 90])


def test_short_unspaced_and_repetitive_items(spark):
    chinese = "".join(chr(0x4E00 + (k * 7919) % 5000) for k in range(60))
    items = [(1, "Tiny item"), (2, chinese), (3, "echo " * 40), (4, chr(0x4E01) * 3), (5, "..."), (6, ""), (None, "no id at all but words enough to be found")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [
        (1, "Such a TINY, item stands here", "x"),
        (2, "tiny items and untiny item do not", "x"),
        (3, "前" * 30 + chinese[:20] + "变" + chinese[21:] + "后" * 30, "x"),
        (4, "echo " * 20000, "x"),
        (None, "tiny item", "x"),
        (5, "a tiny item", "x"), (5, "a tiny item", "x"),
        (6, "中" + chr(0x4E01) * 3 + "中", "x"),
        (7, None, None), (8, "", ""), (9, "no id at all but words enough to be found", ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    found = [(r.doc_id, r.item_id, r.edits) for r in decontaminate.contaminated(docs, benchmark).collect()]
    expected = [(1, 1, 0), (3, 2, 1), (4, 3, 0), (None, 1, 0), (5, 1, 0), (5, 1, 0), (6, 4, 0)]
    assert sorted(found, key=str) == sorted(expected, key=str)
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id) == [2, 7, 8, 9]


def test_kneser_ney_probabilities_sum_to_one():
    texts = ["the cat sat on the mat and the dog ran", "a cat and a dog"]
    folded, _, _ = language_id.symbols(texts)
    keys, counts = np.unique(language_id.sequences(folded)[folded != 1], return_counts=True)
    model = language_id.build_model(["x"], [(keys, counts)])
    letters = np.array([*range(97, 123), 32], np.uint64)
    seen = np.isin(letters, np.unique(keys & np.uint64(0xFFFF)))
    for context in ("the", "zzz", "cat", " a "):
        packed = np.uint64(0)
        for c in context:
            packed = packed << np.uint64(16) | np.uint64(ord(c))
        total = float(np.exp(model.score((packed << np.uint64(16)) | letters[seen]).astype(np.float64)).sum())
        assert 0.9 < total <= 1.0001


def test_language_counts_cover_all_rows_whatever_the_model_holds(spark):
    texts = {"a": [" ".join(words(80, i)) + " über" for i in range(8)], "b": ["the cat sat on the mat", "a " * 9, "zebra", ""]}
    rows = spark.createDataFrame([(i, x, t) for x in texts for i, t in enumerate(texts[x])], "key long, lang string, text string")
    whole = []
    for x in sorted(texts):
        folded, _, _ = language_id.symbols(texts[x])
        whole.append(np.unique(language_id.sequences(folded)[folded != 1], return_counts=True))
    expected, found = language_id.build_model(["a", "b"], whole), language_id.train(rows)
    for level in range(language_id.ORDER):
        assert np.array_equal(found.keys[level], expected.keys[level]) and np.array_equal(found.contexts[level], expected.contexts[level])
        assert np.allclose(found.log_probabilities[level], expected.log_probabilities[level])
        assert np.allclose(found.log_weights[level], expected.log_weights[level], atol=1e-4)
    # all counts of "zebra" tie: a smaller model still holds some sequences and adds up to one
    small = language_id.train(rows, max_sequences=12)
    assert 0 < len(small.keys[0]) <= 40 and len(small.keys[0]) < len(expected.keys[0])
    letters = small.keys[-1]
    for context in ("the", "w12", "bra", "qqq"):
        packed = np.uint64(0)
        for c in context:
            packed = packed << np.uint64(16) | np.uint64(ord(c))
        total = np.exp(small.score((packed << np.uint64(16)) | letters).astype(np.float64)).sum(axis=0)
        assert (total > 0.8).all() and (total <= 1.0001).all()


def test_language_identification_on_held_out_rows(spark, sf_dir):
    from trendspark.llm.queries import op8_language_id

    found = op8_language_id(spark, sf_dir).where("held_out").join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    labelled = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id key", "lang", "text")
    model = language_id.train(labelled)
    odd = language_id.identify(table(spark, [(1, None), (2, ""), (3, "123 !!"), (4, "qxzj vwkq zzxq jjqw " * 40)]), model)
    assert [(r.lang_pred, r.score, r.rejected) for r in odd.where("doc_id < 4").collect()] == [("und", 0.0, True)] * 3
    assert odd.where("doc_id = 4").first().rejected
    kept = language_id.keep_identified(spark.read.parquet(f"{sf_dir}/documents.parquet"), model).count()
    assert kept > 0.99 * labelled.count()


def _two_languages():
    draw, letters = random.Random(4), {"a": "abcdefgh", "b": "opqrstuv"}
    return [(k, "ab"[k % 2], " ".join("".join(draw.choices(letters["ab"[k % 2]], k=4)) for _ in range(k % 5 + 2))) for k in range(6000)]


def _assert_calibrated(model, texts):
    names, _, entropies, counts = model.predict(texts)
    for i, lang in enumerate(model.languages):
        own = np.array(names) == lang
        n, entropy = counts[own], entropies[own]
        mean = (entropy * n).sum() / n.sum()
        assert model.means[i] == pytest.approx(mean, rel=1e-9)
        assert model.spreads[i] == pytest.approx(np.sqrt(((entropy - mean) ** 2 * n).sum() / own.sum()), rel=1e-5)


def test_rejection_is_calibrated_on_every_row(spark):
    rows = _two_languages()
    _assert_calibrated(language_id.train(spark.createDataFrame(rows, "key long, lang string, text string")), [r[2] for r in rows])


def test_pipeline_calibrates_on_every_row(spark, monkeypatch):
    import corpus_pipeline

    rows, train, models = _two_languages(), language_id.train, []
    monkeypatch.setattr(language_id, "train", lambda labelled: models.append(train(labelled)) or models[-1])
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert corpus_pipeline.identify_language(spark, docs, "").columns == docs.columns
    _assert_calibrated(models[0], [r[2] for r in rows])


def test_licenses_are_inherited_from_the_nearest_directory(spark):
    files = [("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.py", "x"), ("a/b/y.py", None), ("a/b/LICENSE", "Licensed under the Apache License, Version 2.0"),
             ("z/q.py", "text"), ("own.py", "Licensed under CC BY-NC 4.0.\n" + " ".join(words(50, 1))), (None, "x"), ("a/b/y.py", None)]
    found = {r.path: (r.license, r.origin, r.from_path, r.levels) for r in licenses.scan_licenses(spark.createDataFrame(files, "path string, text string")).collect()}
    assert found == {
        "a/LICENSE": ("MIT", "file", "a/LICENSE", 0), "a/b/LICENSE": ("Apache-2.0", "file", "a/b/LICENSE", 0),
        "a/b/c/x.py": ("Apache-2.0", "inherited", "a/b/LICENSE", 1), "a/b/y.py": ("Apache-2.0", "inherited", "a/b/LICENSE", 0),
        "z/q.py": (None, "none", None, None), "own.py": ("CC-BY-NC-4.0", "header", "own.py", 0),
    }


def test_pipeline_stages_take_effect(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, docs, sf_dir)
        assert after.columns == columns
        path = new_path(spark, name)
        after.write.parquet(path)
        docs = spark.read.parquet(path)
    rows = docs.collect()
    components, _ = brute_components([(r.doc_id, r.text) for r in rows], 80, 100)
    assert all(i == c for i, c in components.items())
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert not any(i in r.text for r in rows for i in items)
    assert not any(pii.find_spans(r.text)[1] for r in rows)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in rows}


def test_buckets_count_the_bounds_at_or_below(spark):
    keys = [None, -(1 << 63), -5, 0, 3, 4, 7, 8, 9, (1 << 63) - 1]
    for bounds in ([], [3], [0, 3], [-5, 0, 4, 7, 8], list(range(-50, 60, 2)), [-(1 << 63) + 1, 9]):
        rows = spark.createDataFrame([(k,) for k in keys], "id long").select("id", bucket_of("id", bounds).alias("b")).collect()
        assert [r.b for r in rows] == [0 if r.id is None else sum(b <= r.id for b in bounds) for r in rows]
