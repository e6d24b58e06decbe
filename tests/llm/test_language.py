from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from orelode.llm import centroid_language

LETTERS = "abcdefghijklmnopqrstuvwxyz"
SYLLABLES = {"aa": "ka ro mi ten sal", "bb": "gloo frax wim bur tch", "cc": "né ouê lai tré ç"}


def rows(n: int, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang].split(), k=rng.randint(1, 4))) for _ in range(rng.randint(3, 40))]
        out.append((i, " ".join(words), lang))
    return out


def test_held_out_accuracy_and_rejection(documents):
    train = [*rows(300), (1000, None, "aa"), (1001, "12 34", "bb"), (1002, "kami", None)]
    model = centroid_language.fit(documents(train))
    assert sorted(set(model.languages)) == ["aa", "bb", "cc"] and model.limit > 0
    own = rows(200, seed=9)
    odd = [(500, None, None), (501, "", None), (502, "123 !?", None), (503, "щжю жющ юющжж", None)]
    out = {r.doc_id: r for r in centroid_language.predict(documents([*own, *odd]), model).collect()}
    assert sum(out[i].lang_pred == lang for i, _, lang in own) >= 198
    assert not any(out[i].rejected for i, _, _ in own)
    assert [(out[i].lang_pred, out[i].score, out[i].rejected) for i in (500, 501, 502)] == [("und", 0.0, True)] * 3
    assert out[503].rejected and out[503].lang_pred in SYLLABLES
    assert all(0 <= r.score <= 1 for r in out.values())


def test_scores_are_cosines_to_the_nearest_centroid(documents):
    model = centroid_language.fit(documents(rows(60)), dims=1 << 10)
    text = "kamiro tensal kaka"
    vector = centroid_language.normalised(centroid_language.counts(text, 1 << 10)[None], model.idf)[0]
    cosines = [float(np.dot(vector, c)) for c in model.centroids]
    r = centroid_language.predict(documents([(1, text)]), model).first()
    assert r.lang_pred == model.languages[int(np.argmax(cosines))] and abs(r.score - max(cosines)) < 1e-12


def test_long_texts_are_read_whole():
    text = "kami ro " * 70_000
    whole = centroid_language.counts(text, 1 << 10)
    assert abs(whole.sum() - 3 * len(text)) < 20
    assert np.abs(whole - centroid_language.counts(text[:8000], 1 << 10) * 70).max() < 80


def test_nothing_to_learn_from(documents):
    model = centroid_language.fit(documents([(1, "text", None), (2, None, "aa"), (3, "1", "bb")]))
    assert centroid_language.predict(documents([(1, "text")]), model).first().lang_pred == "und"
    assert centroid_language.keep_known(documents([(1, "text")]), model).count() == 0


def test_known_rows_stay_unchanged(documents):
    df = documents([*rows(100), (7, None), (None, "ka ro mi"), (None, "ka ro mi")])
    out = centroid_language.keep_known(df, centroid_language.fit(df))
    assert out.columns == df.columns and out.count() == 102
    assert out.where(F.col("doc_id").isNull()).count() == 2
    assert centroid_language.keep_known(documents([]), centroid_language.fit(df)).count() == 0


FOREIGN = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
    "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e "
    "devono agire gli uni verso gli altri in spirito di fratellanza.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı "
    "kardeşlik zihniyeti ile hareket etmelidirler.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem "
    "i powinni postępować wobec innych w duchu braterstwa.",
]


def test_latin_languages_and_random_letters_are_rejected(spark):
    rng = random.Random(4)
    noise = [" ".join("".join(rng.choices(a, k=rng.randint(2, 9))) for _ in range(40)) for a in (LETTERS, "asdfghjkl")]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    # One odd training text of each language sets no limit.
    odd = [(-i, t, lang) for i, (t, lang) in enumerate([("x", "en"), ("щж", "en"), ("qq", "de"), ("zzz zz", "fr")], 1)]
    model = centroid_language.fit(docs.unionByName(spark.createDataFrame(odd, docs.schema)))
    assert model.nearest([*FOREIGN, *noise])[2].all()
    rows = docs.where("lang is not null").toPandas()
    kept = ~model.nearest(rows["text"].tolist())[2]
    assert kept.mean() >= 0.995
    short = rows["text"].str.len() < 60
    assert short.sum() > 10 and kept[short].mean() >= 0.95


def test_a_language_of_copies_is_learned(documents):
    copies = [(i, t, lang) for _, t, lang in rows(30) for i in range(200 if lang == "bb" else 1)]
    model = centroid_language.fit(documents(copies), rows_per_language=20, centroids=40)
    assert model.languages.count("bb") == len({t for _, t, lang in copies if lang == "bb"})
    assert sorted(set(centroid_language.fit(documents(copies), rows_per_language=0).languages)) == ["aa", "bb", "cc"]
