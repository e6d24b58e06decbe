"""Repeated strings against counting every string, with and without splitting of large groups."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from orelode.llm import suffix_repeats


def expected(text: str | None, counts: Counter, length: int) -> tuple[int, list[tuple[int, int]], bytes]:
    data = (text or "").encode()
    hits = [(i, i + length) for i in range(len(data) - length + 1) if counts[data[i : i + length]] > 1]
    spans = suffix_repeats.merge(hits)
    covered = {j for a, b in spans for j in range(a, b)}
    return len(data), spans, bytes(b for j, b in enumerate(data) if j not in covered)


def corpus() -> list[str | None]:
    rng = random.Random(5)
    draw = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    passage = draw(700)
    texts = [None, "", "x", *(draw(rng.randint(0, 900)) for _ in range(30)), "x" * 1500, "ab" * 500]
    for _ in range(30):
        k = rng.randint(0, 300)
        texts.append(draw(rng.randint(0, 300)) + passage[k : k + rng.randint(150, 400)] + draw(rng.randint(0, 400)))
    texts += [texts[7]] * 3 + [texts[9] + draw(50) + texts[9]]
    return texts + [draw(250) + passage + draw(250) for _ in range(25)]


@pytest.mark.parametrize(("length", "group"), [(200, 2000), (200, 3), (64, 2000)])
def test_all_repeats_go(documents, monkeypatch, length, group):
    monkeypatch.setattr(suffix_repeats, "GROUP_STRETCHES", group)
    texts = corpus()
    counts = Counter(d[i : i + length] for t in texts for d in [(t or "").encode()] for i in range(len(d) - length + 1))
    out = suffix_repeats.without_repeats(documents(list(enumerate(texts))), length).collect()
    found = {r.doc_id: (r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in out}
    assert found == {i: expected(t, counts, length) for i, t in enumerate(texts)}


def test_repeated_rows_null_ids_and_empty_table(documents):
    text = "0123456789" * 3 + "".join(map(chr, range(200, 500)))
    out = suffix_repeats.without_repeats(documents([(None, text), (1, text), (1, text), (2, "short")])).collect()
    assert sorted((r.doc_id or 0, len(r.kept)) for r in out) == [(0, 0), (1, 0), (1, 0), (2, 5)]
    assert suffix_repeats.without_repeats(documents([])).collect() == []


def test_groups_hold_all_occurrences():
    texts = [b"__abcdefgh--", b"..abcdefgh++", b"??abcdXYZ!!", b"nothing here"]
    groups = sorted((n, sorted(m)) for n, m in suffix_repeats.maximal_repeats(texts, 4))
    assert groups == [(4, [(2, 2)]), (8, [(0, 2), (1, 2)])]


def test_intervals_are_nested():
    found = list(suffix_repeats.intervals(np.array([2, 4, 4, 0, 3])))
    assert found == [(1, 3, 4), (0, 3, 2), (4, 5, 3)]
