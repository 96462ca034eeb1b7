import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loomdex.llm import packing
from loomdex.llm.queries import word_bpe_path
from tests.llm.helpers import documents, words


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(word_bpe_path())


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abÀéΣſ'st1, \t\n\u00a0\u0301<|>endoftext", max_size=60))
def test_chunks_give_the_tokenizers_ids(text):
    chunked = packing.PieceTokenizer(word_bpe_path(), remembered=3)
    assert np.frombuffer(chunked.encode(text), "<u4").tolist() == chunked.tokenizer.encode(text, add_special_tokens=False).ids


PLAIN = "".join(map(chr, [*range(0x20, 0x7F), *range(0xA0, 0x180), *range(0x400, 0x460)]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=PLAIN, max_size=12) | st.text(max_size=6) | st.sampled_from(["it's", "'LL", "İ", "\x1c", "\u2028", "e\u0301"]), max_size=8))
def test_plain_and_other_letters_give_the_tokenizers_ids(parts):
    text = " ".join(parts)
    cut = packing.PieceTokenizer(word_bpe_path())
    assert np.frombuffer(cut.encode(text), "<u4").tolist() == cut.tokenizer.encode(text, add_special_tokens=False).ids


def test_every_plain_letter_and_its_neighbours(tokenizer):
    cut = packing.PieceTokenizer(word_bpe_path())
    for c in PLAIN:
        for text in (c, f"a{c}", f"{c}a", f"1{c}!", f"'{c}s", f"{c}{c}"):
            assert np.frombuffer(cut.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_texts_are_cut_at_spaces_only(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 50)
    text = " ".join(words(3, 300)) + " <|endoftext|> it's"
    got = np.frombuffer(packing.PieceTokenizer(word_bpe_path(), remembered=20).encode(text), "<u4").tolist()
    assert got == tokenizer.encode(text, add_special_tokens=False).ids


def plain_best_fit(lengths, window):
    """Remaining room of each window, one item after another into the tightest."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, r in enumerate(rooms) if r >= length]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(window - length)
    return sorted(rooms)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_moves_are_best_fit_decreasing(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    used = defaultdict(list)
    for m in packing.best_fit_decreasing(counts, 40):
        for i in range(m.count):
            used[m.window_id + i // m.per_window].append((m.offset + i % m.per_window * m.length, m.length))
    assert sorted(n for w in used.values() for _, n in w) == sorted(lengths)
    rooms = []
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        rooms.append(40 - at)
    assert sorted(rooms) == plain_best_fit(lengths, 40)
    assert sorted(used) == list(range(len(used)))


def test_every_id_lies_in_one_piece(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "RANK_BLOCK", 3)
    rows = [(i, " ".join(words(i, n))) for i, n in enumerate((0, 1, 5, 5, 5, 700, 90, 31))]
    rows += [(20, None), (21, ""), (None, "no id"), (5, "same id"), (6, rows[6][1]), *[(40 + i, "copied text") for i in range(12)]]
    docs = documents(spark, rows, "1 as start", "2 as sequence_id")
    got = packing.pack(docs, word_bpe_path(), window=64).collect()
    want = defaultdict(int)
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID], "<u4")
        for at in range(0, len(ids), 64):
            want[(doc_id, at, len(ids[at:at + 64]), zlib.crc32(ids[at:at + 64].tobytes()), len(ids))] += 1
    found = defaultdict(int)
    for r in got:
        found[(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)] += 1
    assert found == want
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(documents(spark, []), word_bpe_path()).count() == 0
