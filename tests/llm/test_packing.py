import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lakemart.llm import packing
from lakemart.llm.queries import tokenizer

FILE = tokenizer("byte_bpe_50k.json")
ODD = ["", " ", "a  b", "\nab cd", " ab", "ab ", "a \nb", "a\t\n b  ", "it's I'LL <|endoftext|> x", "ééß ÀÖ×÷ øþ  12 34a", "²³¼ x", "漢字 かな", "\x1c a", "µª º", "... !!! ??a", " '"]


def brute_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(3)
    for _ in range(200):
        capacity = rng.choice([1, 5, 16, 37, 64])
        lengths = [rng.randint(1, capacity if rng.random() < 0.7 else max(1, capacity // 5)) for _ in range(rng.randint(0, 120))]
        plan = packing.best_fit_decreasing(Counter(lengths), capacity)
        filled = defaultdict(list)
        for length, n in Counter(lengths).items():
            bins, offsets = plan.place(np.full(n, length), np.arange(n))
            for b, o in zip(bins.tolist(), offsets.tolist(), strict=True):
                filled[b].append((o, length))
        for pieces in filled.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
        assert sorted(capacity - sum(n for _, n in p) for p in filled.values()) == brute_best_fit(lengths, capacity)


def test_a_piece_that_does_not_fit():
    with pytest.raises(ValueError):
        packing.best_fit_decreasing({9: 1}, 8)


def test_ids_equal_the_tokenizers():
    library = Tokenizer.from_file(FILE)
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "a", "é", "'s", "'", "1", "23", "$", "#x", "ß", "Ω", "’", "\t", "The", " the", "²", "º", "Ł", "!", "<|endoftext|>"]
    for text in ODD + ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000)]:
        ids = np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert packing.encoder(FILE).encode(text) == ids, text


def test_pack_texts(stored, documents):
    library = Tokenizer.from_file(FILE)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (50, None), (None, "no id"), (60, "word " * 300), (61, "x1 " * 64)]
    capacity = 64
    packed = packing.pack(stored(rows), FILE, capacity=capacity, with_ids=True)
    got = packed.collect()
    by_doc = defaultdict(list)
    for r in got:
        assert r.length <= capacity and r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
        by_doc[r.doc_id].append(r)
    for doc_id, text in rows:
        want = library.encode(text or "", add_special_tokens=False).ids + [0]
        mine = sorted(by_doc[doc_id], key=lambda r: r.piece)
        if doc_id == 50:
            assert [(r.piece, r.start, r.length) for r in mine] == [(0, 0, 1)] * 2
            continue
        assert np.frombuffer(b"".join(r.ids for r in mine), dtype="<u4").tolist() == want
        assert all(r.length == capacity for r in mine[1:]) and [r.piece for r in mine] == list(range(len(mine)))
        assert [r.start for r in mine] == [sum(x.length for x in mine[:i]) for i in range(len(mine))]
    rooms = [capacity - sum(r.length for r in got if r.sequence_id == s) for s in {r.sequence_id for r in got}]
    assert sorted(rooms) == brute_best_fit([r.length for r in got], capacity)
    joined = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in got:
        assert joined[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids
    assert packing.pack(documents([]), FILE).count() == 0


def test_equal_lengths_in_many_partitions(stored):
    got = packing.pack(stored([(i, "one") for i in range(500)], 7), FILE, capacity=7).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 500
    assert len({r.sequence_id for r in got}) == -(-500 // 3)
