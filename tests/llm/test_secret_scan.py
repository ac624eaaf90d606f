import hashlib
import random
import re

from lakemart.llm import secret_scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
KINDS = ["assign", "access", "hex", "bare"]


def base_spans(text):
    out = [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    return out + [("hex", *m.span(), m[0]) for m in HEX.finditer(text) if len(m[0]) >= 32]


def bare_spans(text):
    runs = ((*m.span(), m[0]) for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text))
    return [("bare", s, e, v) for s, e, v in runs if re.search("[0-9]", v) and re.search("[A-Za-z]", v) and len(set(v)) >= secret_scan.LEAST_CHARACTERS]


def written(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e, _ in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))))


def holders(rows):
    """value -> {text: the first of its owners}: copies of a text are one."""
    held = {}
    for _, t, _, owner in rows:
        for *_, v in base_spans(t or "") + bare_spans(t or ""):
            texts = held.setdefault(v, {})
            texts[t] = min(texts.get(t, owner or ""), owner or "")
    return held


def brute(rows):
    held = holders(rows)
    owners = {v: set(texts.values()) for v, texts in held.items()}
    out = []
    for i, t, _, _ in rows:
        base = base_spans(t or "")
        bare = [
            x for x in bare_spans(t or "")
            if len(owners[x[3]]) < secret_scan.EXAMPLE_OWNERS and not any(s < x[2] and e > x[1] for _, s, e, _ in base)
        ]
        every = base + bare
        live = sum(len(owners[x[3]]) < secret_scan.EXAMPLE_OWNERS for x in every)
        counts = [sum(k == x[0] for x in base) for k in KINDS[:3]]
        widest = max((len(held[x[3]]) for x in every), default=0)
        out.append((i, *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(every), live, len(every) - live, widest))
    return sorted(out, key=repr)


KEY = "AKIA" + "ABCDEFGH12345678"
EXAMPLE = "0123456789abcdef" * 2
OWN = "Zx9-Qw8_Er7tYu6iOp5a"
TEXTS = [
    'é token = "abcdefgh1" and PASSWORD: \'short\' password=longenough', "token: secret: abcdefghij", "api_key=api-key=Secret=abcdefgh", f"{KEY} and X{KEY}Z and AKIA1234",
    EXAMPLE, EXAMPLE + "g" + EXAMPLE + "é", "a" * 31, f"see {OWN} here", f"token={OWN}", "deadbeef" * 4 + "token=12345678", "AKIAAKIA" + "A" * 12, None, "", "passwd=" * 50,
    "token=x " * 2000 + "token=abcdefgh9", "apikey : \"a.b=c/d+e_f-g\"", "ſecret=abcdefgh1 toKen=abcdefgh1",
]


def test_against_plain_python(stored):
    rng = random.Random(3)
    parts = ["token", "Secret", "api_key", "apikey", "=", ":", " ", '"', "'", "abcdefgh", KEY, EXAMPLE, OWN, "é", "x", "AKIA", "0f", "a1B2c3D4e5F6g7H8i9J0k", "/", "\n"]
    texts = TEXTS + ["".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(300)]
    rows = [(i, t, "en", rng.choice(["a", "b", "c", "d", None])) for i, t in enumerate(texts)] + [(None, TEXTS[0], "en", "a"), (0, TEXTS[0], "en", "b")]
    got = secret_scan.report(stored(rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_redaction_leaves_examples(stored, documents):
    rows = [(i, f"é {EXAMPLE} x{i}", "en", f"s{i}") for i in range(4)] + [(9, f"a {OWN} b token={OWN}c z", "en", "s1"), (10, None, "en", "s"), (11, "plain", "en", None)]
    got = secret_scan.redact(stored(rows))
    texts = {r.doc_id: r.text for r in got.collect()}
    assert got.columns == stored(rows).columns
    assert all(texts[i] == rows[i][1] for i in range(4)) and texts[10] is None and texts[11] == "plain"
    assert texts[9] == "a [SECRET] b [SECRET] z"
    sized = secret_scan.redact(stored(rows), length_col="n_chars").collect()
    assert all(r.n_chars == len(r.text or "") for r in sized)
    assert secret_scan.report(documents([])).count() == 0
    assert secret_scan.redact(documents([])).count() == 0


def test_hot_secret(stored):
    rows = [(i, f"password={'same' * 3}" if i % 3 == 0 else f"password=own{i:08d}", "en", f"s{i % 7}") for i in range(900)]
    assert sorted((tuple(r) for r in secret_scan.report(stored(rows)).collect()), key=repr) == brute(rows)


def test_scan_split_anew_between_steps(stored, replanned):
    rows = [(i, f"{'x ' * i}password=own{i:08d}" if i % 4 else "plain", "en", f"s{i % 7}") for i in range(120)]
    docs = stored(rows, parts=6)
    replanned(secret_scan)
    assert sorted((tuple(r) for r in secret_scan.report(docs).collect()), key=repr) == brute(rows)


def test_repositories_of_every_value(stored):
    rows = [(i, f"password={'same' * 3} {i % 25}", "en", "hot") for i in range(50)] + [(60, "token=single12345", "en", "a"), (61, "token=shared12345 token=shared12345", "en", "a"), (62, "token=shared12345", "en", "b")]
    found = secret_scan.scan(secret_scan.store(secret_scan._rows(stored(rows), "doc_id", "text", "source"), "documents"))
    got = {(r.owner, r.owners, r.repositories) for r in found.where("kind = 'assign'").collect()}
    assert got == {("hot", 1, 25), ("a", 1, 1), ("a", 2, 2), ("b", 2, 2)}


def test_copies_of_a_text_make_no_owners(stored):
    """A bare key stays in the report, and is cut out, however often and by whomever its text is copied."""
    rows = [(i, f"see {OWN} here", "en", f"s{i}") for i in range(5)]
    assert {(r.spans, r.n_live, r.n_repositories) for r in secret_scan.report(stored(rows)).collect()} == {("bare:4:24", 1, 1)}
    assert {r.text for r in secret_scan.redact(stored(rows)).collect()} == {"see [SECRET] here"}
    # two owners' different texts: still live; those of three owners: an example
    two = [(i, f"see {OWN} here {i}", "en", f"s{i}") for i in range(2)]
    assert {r.n_live for r in secret_scan.report(stored(two)).collect()} == {1}
    three = [(i, f"see {OWN} here {i}", "en", f"s{i}") for i in range(3)]
    assert {(r.spans, r.n_live) for r in secret_scan.report(stored(three)).collect()} == {("", 0)}


def test_many_cuts_are_not_broadcast(stored, monkeypatch):
    rows = [(i, f"token=abcdefgh{i} " * 5, "en", "s") for i in range(4)]
    want = sorted(r.text for r in secret_scan.redact(stored(rows)).collect())
    monkeypatch.setattr(secret_scan, "BROADCAST_ROWS", 20)  # 4 rows, 20 cuts
    assert sorted(r.text for r in secret_scan.redact(stored(rows)).collect()) == want
