import hashlib
import random
import time

from tokenizers import Tokenizer

from lakemart.llm import bpe
from lakemart.llm.queries import tokenizer

FILE = tokenizer("word_bpe_49k.json")
PARTS = [
    " ", "  ", "\n", "a", "é", "é", "'s", "'", "1", "23", "$", "#x", "ß", "Ω", "Σ", "ΑΣ", "’", "\t", "The", " the", "²", "º", "Ł", "ǅ", "İ", "!",
    "<|endoftext|>", "<|startoftext|>", "\x1c", "\x85", "　", "漢字", "한글", "한", "🙂", "‍", "​", "I'LL", "don't", "ﬁ", "\x00",
]


def library(text):
    t = Tokenizer.from_file(FILE) if not hasattr(library, "t") else library.t
    library.t = t
    ids = t.encode(text, add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), t.decode(ids, skip_special_tokens=False)


def test_cuts_are_where_no_token_goes_across():
    coder = bpe.coder(FILE)
    assert coder.cut("hello") == ["hello"]
    rng = random.Random(4)
    letters = list(bpe._LETTER.values())
    cut_words = 0
    for _ in range(300):
        word = "".join(rng.choices(letters, k=rng.randint(1, 9)))
        fragments = coder.cut(word)
        assert "".join(fragments) == word
        cut_words += len(fragments) > 1
        joined = [i for k, f in enumerate(fragments) for i in coder.merged(f, k == len(fragments) - 1)]
        assert joined == coder.merged(word, True)
    assert cut_words > 100


def test_equal_to_the_library():
    rng = random.Random(2)
    for text in ["", " "] + ["".join(rng.choices(PARTS, k=rng.randint(1, 12))) for _ in range(4000)]:
        assert bpe.coder(FILE).encode(text) == library(text), text


def test_long_words_merge_alike():
    coder, rng = bpe.coder(FILE), random.Random(6)
    for letters in ["ab", "aeinst", "".join(map(chr, range(97, 123))), "0é"]:
        for n in (bpe.SCANNED - 1, bpe.SCANNED, bpe.SCANNED + 1, 400, 3_000):
            word = "".join(rng.choices(letters, k=n))
            assert coder.encode(word) == library(word)
            assert (word in coder) == (n <= bpe.LONGEST_REMEMBERED)


def test_a_word_of_a_million_letters():
    word, start = "a" * 1_000_000, time.monotonic()
    found = bpe.coder(FILE).encode(word)
    assert time.monotonic() - start < 10
    assert found == library(word)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    coder = bpe.WordBpe(FILE)
    text = "several words that are more than three, and some twice: words words that"
    assert coder.encode(text) == library(text)


def test_frames(stored, documents):
    rows = [(1, "Hello  WORLD"), (1, "Hello  WORLD"), (None, "x"), (2, None), (3, ""), (4, "long " * 20_000)]
    texts = [t or "" for _, t in rows]
    got = bpe.digests(stored(rows), FILE).collect()
    want = [(i, n, hashlib.sha256(a.encode()).hexdigest(), hashlib.sha256(d.encode()).hexdigest()) for (i, _), (n, a, d) in zip(rows, map(library, texts), strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    pairs = bpe.decode(bpe.encode(stored(rows), FILE), FILE).collect()
    assert sorted(((r.doc_id, " ".join(map(str, r.ids)), r.decoded) for r in pairs), key=repr) == sorted(
        ((i, a, d) for (i, _), (_, a, d) in zip(rows, map(library, texts), strict=True)), key=repr
    )
    assert bpe.digests(documents([]), FILE).count() == 0
