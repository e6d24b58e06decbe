from __future__ import annotations

import re

from orelode.llm import zstd_secrets

KEY = "kQ9x" + "7Zp2LmVt" + "c4Rw8YbN" + "s1Hd6Fgj"
TEXTS = [
    "",
    'password = "hunter22hunter" and PASSWD:abc12345, secret:short',
    "token=secret=abcdefgh password: token:abcdefghijk api_key='x' apikey = \"A1b2C3d4E5\"",
    "AKIA" + "ABCDEFGHIJKL" + " AKIAABC xAKIA" + "0" * 30,
    "é" * 5 + " " + "0123456789abcdef" * 2 + " " + "deadbeef" * 3 + "A" + "f" * 40,
    "token = " + "a1b2" * 10,
    f"the session cookie was {KEY} yesterday",
    f"nothing sensitive here {KEY} at all",
    "see the authorization_configuration_parameters and authentication-token-provider-factory in key docs",
    "paſſword=abcdefghijk toKen=abcdefghijk",
]


def plain(text: str) -> list[tuple[int, int, int]]:
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    letters = re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", "password|passwd|secret|token|api_?key")
    assign = assign.replace("password|passwd|secret|token|api_?key", letters)
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_patterns(documents):
    rows = [*enumerate(TEXTS), (50, None), (1, TEXTS[1])]
    out = zstd_secrets.find_secrets(documents(rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        text = TEXTS[r.doc_id] if r.doc_id < 50 else ""
        base = [(s.start, zstd_secrets.KINDS.index(s.kind), s.end) for s in r.found if s.kind != "novel"]
        assert base == plain(text)


def test_novelty(documents):
    out = {r.doc_id: r.found for r in zstd_secrets.find_secrets(documents(list(enumerate(TEXTS)))).collect()}
    start = TEXTS[6].index(KEY)
    assert [(s.kind, s.start, s.end) for s in out[6]] == [("novel", start, start + len(KEY))]
    assert out[7] == [] and out[8] == []


def test_repeated_context_is_not_novel():
    scanner = zstd_secrets.Scanner()
    text = f"{KEY} key {KEY}"
    assert scanner.added(text, len(KEY) + 5, len(text)) < 0.3 < 0.7 < scanner.added(f"key {KEY}", 4, 4 + len(KEY))


def test_long_text_and_empty_table(documents):
    text = "word " * 200_000 + "password=abcdefgh"
    (row,) = zstd_secrets.find_secrets(documents([(None, text)])).collect()
    assert [(s.start, s.end) for s in row.found] == [(1_000_000, 1_000_017)]
    assert zstd_secrets.find_secrets(documents([])).collect() == []


def test_keys_of_one_case_and_repeated_keys_are_novel():
    scanner = zstd_secrets.Scanner()
    for key in ("qzjxkvwpgmtbyhrl", "QZJXKVWPGMTBYHRLDNCF", "kQxZpLmVtRwYbNsHd", KEY):
        text = f"the session cookie was {key} and the key is {key} again"
        first, second = text.index(key), text.rindex(key)
        assert scanner.novel(text, []) == [(first, 3, first + len(key)), (second, 3, second + len(key))]
    assert scanner.novel("the key " + "=" * 40 + " and the key " + "a" * 40, []) == []
