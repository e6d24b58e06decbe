"""Greedy string tiling against searching for the longest common run word by word."""

from __future__ import annotations

import random

import numpy as np

from orelode.llm import queries, string_tiling
from orelode.llm.pipeline import without_leaks

ITEM = "The quick brown fox, it seems, jumps over the lazy dog and then runs far away from all of us."


def plain_tiles(a: list[int], b: list[int], least: int) -> list[tuple[int, int, int]]:
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = (0, 0, 0)
        for j in range(len(b)):
            for i in range(len(a)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[2]:
                    best = (i, j, n)
        if best[2] < least:
            return out
        i, j, n = best
        free_a[i : i + n], free_b[j : j + n] = [False] * n, [False] * n
        out.append(best)


def test_tiles_are_the_longest_first():
    rng = random.Random(1)
    for _ in range(150):
        a, b = (rng.choices(range(1, 4), k=rng.randint(0, 40)) for _ in range(2))
        found = list(string_tiling.greedy_tiles(np.array(a, np.uint64), np.array(b, np.uint64), 3))
        assert found == plain_tiles(a, b, 3)


def leaks(spark, documents, rows, items, **options):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = string_tiling.find_leaks(documents(rows), benchmark, **options).collect()
    return sorted((r.doc_id, r.item_id, r.n_words, r.n_covered, r.n_tiles) for r in out)


def test_reordered_loud_and_partial_passages(spark, documents):
    words = ITEM.split()
    turned = " ".join(words[10:]) + " some other words " + " ".join(words[:10])
    rows = [
        (1, "before " + ITEM + " after"), (2, ITEM.upper().replace(" ", "!! ")), (3, turned),
        (4, " ".join(words[:9])), (5, None), (6, ""), (7, "nothing of it at all, really nothing"),
    ]
    found = leaks(spark, documents, rows, [(1, ITEM), (2, None), (3, "too few words"), (4, "")])
    assert found == [(1, 1, 20, 20, 1), (2, 1, 20, 20, 1), (3, 1, 20, 20, 2)]
    assert leaks(spark, documents, rows, [(1, ITEM)], coverage=0.4)[-1] == (4, 1, 20, 9, 1)


def test_periodic_and_long_texts(spark, documents):
    item = "ha " * 30
    assert leaks(spark, documents, [(1, "ha " * 50_000), (2, "ha " * 23)], [(1, item)]) == [(1, 1, 30, 30, 1)]


def test_case_beyond_ascii(spark, documents):
    item = "où était la forêt où le garçon rêvait"
    assert leaks(spark, documents, [(1, item.upper())], [(8, item)]) == [(1, 8, 8, 8, 1)]


def test_benchmark_in_several_parts(spark, documents, monkeypatch):
    rng = random.Random(4)
    items = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(20))) for i in range(30)]
    rows = [(i, f"intro {t} outro") for i, t in items] + [(i, t) for i, t in items[:3]]
    once = leaks(spark, documents, rows, items)
    monkeypatch.setattr(string_tiling, "PART_BYTES", 1000)
    assert leaks(spark, documents, rows, items) == once
    assert len(once) == 33


def test_clean_rows_stay(spark, documents):
    df = documents([(1, ITEM), (2, None), (3, "clean"), (3, "clean"), (None, "x " + ITEM)])
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    out = string_tiling.keep_clean(df, benchmark)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text or "") for r in out.collect()) == [(2, ""), (3, "clean"), (3, "clean")]
    assert string_tiling.keep_clean(df, benchmark.limit(0)).count() == 5
    assert string_tiling.keep_clean(documents([]), benchmark).count() == 0


def test_shuffled_sentences_and_most_of_an_item_are_leaks(spark, documents, tmp_path):
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(10**6)}"
    sentences = [" ".join(word() for _ in range(n)) + "." for n in (7, 3, 9, 4, 8, 4, 6)]
    item = " ".join(sentences)
    turned = " ".join(f"{s} {word()} {word()}" for s in (sentences[i] for i in (4, 1, 6, 3, 0, 5, 2)))
    part = " ".join([word(), *item.split()[: int(0.6 * 41)], word()])
    rows = [(1, turned), (2, part), (3, " ".join(item.split()[:12])), (4, item), (5, " ".join(word() for _ in range(90)))]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = queries.op6_string_tiling(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_covered) for r in found) == [(1, 30), (2, 24), (4, 41)]
    clean = without_leaks(spark, queries.table(spark, str(tmp_path), "documents"), str(tmp_path))
    assert sorted(r.doc_id for r in clean.collect()) == [3, 5]


def test_repeated_runs_of_an_item_count_as_often_as_they_stand(spark, documents):
    rng = random.Random(7)
    phrase = "round and round it goes "
    item = phrase * 24 + " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))
    assert leaks(spark, documents, [(1, phrase * 24), (2, phrase * 9)], [(1, item)]) == [(1, 1, 150, 120, 1)]
