"""Periodic runs against trying every period at every place."""

from __future__ import annotations

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from orelode.llm import periodic_runs
from orelode.llm.periodic_runs import COVER, COVER_SIZE, Extensions
from orelode.llm.queries import QUERIES


def brute(words: list, least: int, times: int) -> list[tuple[int, int, int]]:
    """start, length, period, by start and period."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            begin = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - begin + q >= max(least, times * q) and i > begin:
                found.setdefault((begin, i - begin + q), q)
            i += 1
    return sorted([(s, n, q) for (s, n), q in found.items()], key=lambda r: (r[0], r[2]))


def expected(words: list[str], least: int = 24, times: int = 3) -> tuple[list, str]:
    runs = brute(words, least, times)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return runs, " ".join(w for i, w in enumerate(words) if i not in dropped)


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc: int | None, words: list[str]) -> list[str]:
    h = zlib.crc32(str(doc).encode())
    n, g = len(words), h // 10
    if doc is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def sequences(n: int) -> list[np.ndarray]:
    rng = np.random.default_rng(n)
    made = []
    for _ in range(n):
        w = rng.integers(0, rng.integers(1, 4), rng.integers(0, 300))
        for _ in range(rng.integers(0, 3)):
            if len(w) > 10:
                a = int(rng.integers(0, len(w)))
                p = int(rng.integers(1, (len(w) - a) // 3 + 2))
                w[a:] = [w[a + k % p] for k in range(len(w) - a)]
        made.append(w.astype(np.int64))
    return made


def test_every_difference_is_covered():
    assert {(a - b) % COVER_SIZE for a in COVER for b in COVER} == set(range(COVER_SIZE))


def test_extensions_are_the_common_prefixes():
    rng = np.random.default_rng(1)
    for w in sequences(60):
        if len(w) < 3:
            continue
        i = rng.integers(0, len(w) - 1, 40)
        j = np.array([rng.integers(a + 1, len(w) + 1) for a in i])
        prefix = lambda a, b: next((k for k in range(len(w) - b) if w[a + k] != w[b + k]), len(w) - b)
        assert Extensions(w).common(i, j).tolist() == [prefix(a, b) for a, b in zip(i, j, strict=True)]


@pytest.mark.parametrize(("least", "times"), [(24, 3), (1, 2), (7, 3), (6, 2)])
@pytest.mark.parametrize("pairs", [50, 1 << 20])
def test_runs_are_those_of_brute_force(least, times, pairs, monkeypatch):
    monkeypatch.setattr(periodic_runs, "_PAIRS", pairs)
    monkeypatch.setattr(periodic_runs, "_PERIODS", pairs)
    texts = sequences(25)
    doc, *rest = periodic_runs.runs_of(np.concatenate(texts), np.array(list(map(len, texts))), least, times)
    found = list(zip(doc.tolist(), *(c.tolist() for c in rest), strict=True))
    assert found == [(d, *run) for d, w in enumerate(texts) for run in brute(w.tolist(), least, times)]


def test_long_and_hostile_texts():
    for words in (np.zeros(200_000, np.int64), np.arange(200_000) % 66_000, np.array([0, 1] * 30_000 + [2] + [0, 1] * 30_000)):
        runs = periodic_runs.runs_of(words.astype(np.int64), np.array([len(words)]), 24, 3)
        assert len(runs[0]) in (1, 2)


TEXTS = [
    None, "", "  \n", "one", "a " * 23, "a " * 24, "x " + "b\tc\n" * 40 + "c", ("la " * 30 + "end. ") * 6, "A a " * 20, "é\u00a0é " * 24, "w\x1cx " * 30,
    "p q r s t u v w x y " * 3 + "p", " ".join(map(str, range(500))), "long words " + "z" * 300_000 + " y" * 50,
]


def test_find_runs(spark, documents):
    rows = [*enumerate(TEXTS), (7, TEXTS[7]), (7, TEXTS[7]), (None, TEXTS[8])]
    out = periodic_runs.find_runs(documents(rows), keep=["doc_id", "node"]).collect()
    found = sorted((r.doc_id if r.doc_id is not None else -1, r.node, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out)
    wanted = sorted((-1 if i is None else i, -1, len(words_of(t)), *expected(words_of(t))) for i, t in rows)
    assert found == wanted
    assert periodic_runs.find_runs(documents([])).collect() == []


def test_query(spark, tmp_path, documents):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["to", "be", "or", "not", "that"], rng.integers(0, 120))) for _ in range(150)]
    rows = [*enumerate([*texts, *TEXTS]), (None, texts[1]), (3, "other " * 30), (3, "other " * 30)]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    wanted = []
    for i, t in rows:
        runs, left = expected(planted(i, words_of(t)))
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        milli = 1000 * best[1] // best[2] if best else None
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, left)]
        wanted.append((i, len(runs), *(best or (None,) * 3), milli, *digests))
    assert sorted(map(tuple, out), key=str) == sorted(wanted, key=str)
    assert sum(r[1] > 0 for r in wanted) > 10
