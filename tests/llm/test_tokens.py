"""Token counts and token files against the library on whole texts, and exact round trips."""

from __future__ import annotations

import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from orelode.llm import ans_tokens, token_counts, tokenizing
from orelode.llm.arrays import utf8
from orelode.sources.storage import work_path

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = (
    "a Zq the don't 's ' é ñ Σ İ ß 中 の 👍 <|endoftext|> <|startoftext|> 1 99 ! - , . \x1c \x85 　 ́".split(" ")
    + [" ", "  ", "\n", "\r\n", "\t", " of", ". The"]
)


SCRIPTS = [
    "हिन्दी में लिखा हुआ पाठ, और एक वाक्य।", "한국어 문장 하나. 또 하나의 글", "ภาษาไทย ไม่มีช่องว่าง ระหว่างคำ", "中文没有空格，但是有标点。第二句、第三句", "نص عربي قصير، ثم آخر",
    "👍🏽 emoji 👩‍👩‍👧 😀 x", "QmFzZTY0IHRleHQgd2l0aG91dCBibGFua3M0Mg==", "Ελληνικά Σίσυφος ΣΑΣ τέλος", "a\u1680b c\u2003d e\u200bf g\u3000h i\ufeffj k\u180el m\u0301 \u0301n o\u00a0p",
    "fi ﬁ K Å e\u0301 =\u0338 <\u0338 don't 'tis x's <|endoftext|>9<|startoftext|>a1b2 (x)-[y]",
]


def texts(n: int) -> list[str | None]:
    rng = random.Random(3)
    made = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(n)]
    return [None, "", " ", "x" * 5000, "word " * 3000, *made, made[0], made[0]]


def library(path: str, values: list[str | None]) -> list[list[int]]:
    encoded = Tokenizer.from_file(path).encode_batch([v or "" for v in values], add_special_tokens=False)
    return [e.ids for e in encoded]


def test_counts_are_the_librarys(documents):
    values = texts(2000)
    out = token_counts.count_tokens(documents(list(enumerate(values))), BYTES, limit=30).collect()
    ids = library(BYTES, values)
    expected = {i: (len((v or "").encode()), len(t), len(t) > 30) for i, (v, t) in enumerate(zip(values, ids))}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in out} == expected


def mixed_scripts(n: int) -> list[str]:
    """Words of all scripts in any order, with one and more blanks between them."""
    rng = random.Random(5)
    words = [w for s in SCRIPTS for w in s.split(" ")]
    return [*SCRIPTS, *("".join(rng.choice(words) + rng.choice([" "] * 6 + ["", "  ", "\n", " \n", "\t"]) for _ in range(rng.randint(1, 60))) for _ in range(n))]


@pytest.mark.parametrize(("path", "uncased"), [(BYTES, False), (WORDS, True)])
@pytest.mark.parametrize("memo", [1 << 12, 1 << 16, tokenizing.MEMO_BYTES])
def test_pieces_of_all_scripts(path, uncased, memo, monkeypatch):
    monkeypatch.setattr(tokenizing, "MEMO_BYTES", memo)
    monkeypatch.setattr(tokenizing, "BLOCK_BYTES", 5000)
    values = [v or "" for v in [*mixed_scripts(300), *texts(300)]]
    expected = library(path, values)
    for _ in range(2):
        found = []
        for _, ids, offsets in tokenizing.encode_column(pa.array(values), path, uncased):
            found += [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]
        assert found == expected
    assert tokenizing.pieces_of(path).size <= 2 * memo


def test_memory_of_long_pieces_is_given_back():
    rng = random.Random(2)
    values = ["".join(chr(rng.randint(0x5000, 0x8FFF)) for _ in range(3000)) for _ in range(60)]
    tokenizing.count_column(pa.array(values), BYTES)
    pieces = tokenizing.pieces_of(BYTES)
    assert not any(len(p) > tokenizing.MEMO_PIECE for p in pieces.memo)
    assert pieces.pool.nbytes <= tokenizing.MEMO_BYTES


@pytest.mark.parametrize("text", [SCRIPTS[0], SCRIPTS[1], SCRIPTS[3], SCRIPTS[6]])
def test_long_texts_of_other_scripts_are_cut(text):
    data, offsets = utf8(pa.array([(text + " ") * 50]))
    assert len(tokenizing._cut(data, offsets, False)[1]) >= 100


def test_counts_of_an_empty_table(documents):
    assert token_counts.count_tokens(documents([]), BYTES).collect() == []


def test_file_round_trip(spark, documents):
    values = texts(600)
    rows = [*enumerate(values), (5, "again"), (5, "again"), (None, "no id")]
    path = work_path(spark, f"tokens-{uuid.uuid4().hex}")
    back = ans_tokens.round_trip(documents(rows), WORDS, 2, path).collect()
    own = sorted((-1 if i is None else i, np.array([*t, 2], "<u4").tobytes()) for (i, _), t in zip(rows, library(WORDS, [t for _, t in rows])))
    back.sort(key=lambda r: r.start)
    ids = [-1 if r.doc_id is None else r.doc_id for r in back]
    assert ids == sorted(ids)
    assert sorted((i, bytes(r.ids)) for i, r in zip(ids, back)) == own
    assert [r.start for r in back] == list(np.cumsum([0, *(r.n_tokens for r in back[:-1])]))
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.n_tokens * 4 == len(r.ids) for r in back)


def test_empty_file(spark, documents):
    path = work_path(spark, f"tokens-{uuid.uuid4().hex}")
    assert ans_tokens.round_trip(documents([]), WORDS, 2, path).collect() == []


def test_many_blocks_and_damage(spark, documents, monkeypatch):
    path = work_path(spark, f"tokens-{uuid.uuid4().hex}")
    documents_ = documents([(i, "some words of text " * (i % 50)) for i in range(300)], 2)
    monkeypatch.setattr(ans_tokens, "BLOCK_TOKENS", 500)
    ans_tokens.write(ans_tokens.staged_ids(documents_, WORDS, 2), path)
    rows = spark.read.parquet(f"{path}/blocks").toPandas()
    tokens, freq = ans_tokens._load_table(spark, path)
    row = rows.iloc[0].to_dict()
    whole = ans_tokens.decode_block(row, tokens, freq)
    assert zlib.crc32(whole.tobytes()) == row["ids_crc32"]
    row["words"] = b"\1" + row["words"][1:]
    with pytest.raises(ValueError, match="damaged"):
        list(ans_tokens._decoded_documents(row, 0, tokens, freq))


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 200_000])
def test_code_and_checkpoints(n):
    symbols = np.minimum(np.random.default_rng(n).zipf(1.3, n) - 1, 2999)
    freq = ans_tokens.scale(np.bincount(symbols, minlength=3000) + 1.0)
    assert freq.sum() == 1 << ans_tokens.SCALE_BITS and freq.min() >= 1
    first = np.cumsum(freq) - freq
    code, marks = ans_tokens.encode_block(symbols, freq, first)
    table = (freq.astype(np.uint64), first.astype(np.uint64), np.repeat(np.arange(3000), freq))
    for checkpoint in range(max(1, len(marks))):
        begin = checkpoint * ans_tokens.CHECKPOINT * ans_tokens.LANES
        found = ans_tokens.decode_from(code.astype(np.uint64), marks, n, *table, checkpoint)
        assert np.array_equal(found, symbols[begin:])
