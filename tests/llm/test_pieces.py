import hashlib
import random
import zlib

import numpy as np
import pytest
import sentencepiece

from lakemart.llm import pieces
from lakemart.llm.queries import tokenizer

FILE = tokenizer("piece_bpe_32k.model")
PARTS = [
    " ", "  ", "    ", "\n", "a", "é", "é", "'s", "1", "23", "▁", "ß", "Ω", "\t", "The", " the", "²", "½", "ﬁ", "Ａ", "①", "　", " ",
    "漢字", "한글", "🙂", "‍", "​", "<s>", "<0x41>", "</s>", "don't", "\x00", "�", "ffi", "tion", " of", "ing", "가",
]


def texts(seed, n, longest=14):
    rng = random.Random(seed)
    return ["", " ", "  ", "▁", " ▁ a", "a ", " a"] + ["".join(rng.choices(PARTS, k=rng.randint(1, longest))) for _ in range(n)]


def renormalised(rule, trim, dummy):
    """The model's bytes with another normaliser's settings."""
    spec = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    own = next(v for n, v in pieces.fields(spec) if n == 3)
    chars = dict(pieces.fields(own)).get(2, b"")

    def field(number, kind, value):
        def varint(x):
            out = bytearray()
            while x > 127:
                out.append(x & 127 | 128)
                x >>= 7
            return bytes([*out, x])
        return varint(number << 3 | kind) + (varint(value) if kind == 0 else varint(len(value)) + value)

    with open(FILE, "rb") as f:
        kept = b"".join(field(n, 2, v) for n, v in pieces.fields(f.read()) if n != 3)
    return kept + field(3, 2, field(2, 2, chars) + field(3, 0, dummy) + field(4, 0, trim))


def same(model, library, text):
    """Ids, source spans and decoded text are the library's."""
    units, places = model.encode(text)
    ids = [int(i) for u in units for i in u[1].split()]
    proto = [dict(pieces.fields(v)) for n, v in pieces.fields(library.encode(text, out_type="serialized_proto")) if n == 2]
    assert ids == [p.get(2, 0) for p in proto], text
    assert list(zip(places[:-1].tolist(), places[1:].tolist(), strict=True)) == [(p.get(4, 0), p.get(5, 0)) for p in proto], text
    assert model.decode([*ids, 2]) == library.decode([*ids, 2]), text


def test_equal_to_the_library():
    model, library = pieces.model(FILE), sentencepiece.SentencePieceProcessor(model_file=FILE)
    for text in texts(1, 4000):
        same(model, library, text)


@pytest.mark.parametrize("rule,trim,dummy", [("nfkc", 0, 1), ("nmt_nfkc", 1, 1), ("nmt_nfkc_cf", 1, 0), ("identity", 1, 1), ("nfkc_cf", 0, 0)])
def test_compiled_maps(rule, trim, dummy):
    data = renormalised(rule, trim, dummy)
    model, library = pieces.Model(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in texts(2, 1200):
        same(model, library, text)


def test_decodes_any_ids():
    model, library = pieces.model(FILE), sentencepiece.SentencePieceProcessor(model_file=FILE)
    rng = random.Random(3)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(0, 3), 28705, 259]) for _ in range(rng.randint(0, 9))]
        assert model.decode(ids) == library.decode(ids), ids


def test_one_long_word_and_forgetting(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    with open(FILE, "rb") as f:
        model = pieces.Model(f.read())
    library = sentencepiece.SentencePieceProcessor(model_file=FILE)
    for text in ["a" * 300_000, " " * 20_000 + "b", "one two three four five one two " * 20]:
        units, places = model.encode(text)
        assert [int(i) for u in units for i in u[1].split()] == library.encode(text) and places[-1] == len(text)
    assert len(model.units) <= 3


def test_frames(spark, stored, documents):
    rows = [(1, "Hello  WORLD"), (1, "Hello  WORLD"), (None, "x é"), (2, None), (3, ""), (4, "long " * 20_000), (5, " ▁ 漢字")]
    library = sentencepiece.SentencePieceProcessor(model_file=FILE)

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_eos=True)
        places = pieces.model(FILE).encode(t)[1].astype("<i8").tobytes()
        want.append((i, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)), zlib.crc32(places)))
    got = pieces.digests(stored(rows), FILE).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    encoded = pieces.decode(pieces.encode(stored(rows), FILE), FILE).collect()
    assert sorted(((r.doc_id, r.decoded) for r in encoded), key=repr) == sorted(((i, (t or "").replace("▁", " ")) for i, t in rows), key=repr)
    for r in encoded:
        assert r.starts[1:] == r.ends[:-1] and len(r.ids) == len(r.starts)
    clash = spark.createDataFrame([(1, "a b", "x", 7)], "doc_id long, text string, found string, n_tokens long")
    assert pieces.digests(clash, FILE).first().n_tokens == 3
    assert pieces.digests(documents([]), FILE).count() == 0 and np.array(pieces.encode(documents([]), FILE).collect()).size == 0


def test_words_between_signs_are_met_again():
    """Signs are cut off wherever no piece holds them with a letter: each word is merged once."""
    with open(FILE, "rb") as f:
        model = pieces.Model(f.read())
    library = sentencepiece.SentencePieceProcessor(model_file=FILE)
    text = "kernal. kernal, kernal!! kernal $$$ kernal? m² x². l'eau 3.14 1,5 €5 a-b\nKernal.\nkernal"
    same(model, library, text)
    model.units.clear()
    model.encode(" ".join(f"kernal{sign}kernal" for sign in (".", ",", "!!", ".\n", "$$$", "?", ";\n", "...")))
    assert {u for u in model.units if "kernal" in u} == {"▁kernal", "kernal"}
