from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from orelode.functions.text import class_code, number_or_zero, split_tokens, term_bucket
from orelode.operators import kmeans, naive_bayes, pca
from orelode.plans import queries
from orelode.sources import lines, storage

ACTIVITY = (
    "datetime,CellID,countrycode,smsin,smsout,callin,callout,internet",
    "2013-11-01 00:00:00,1,39,0.5,,1.0,2.0,3.5",
    "2013-11-01 00:00:00,2,39,,,,,",
)


def test_activity_blanks_are_zero(spark, write_lines):
    rows = lines.read_activity(spark, write_lines(*ACTIVITY)).collect()
    assert [tuple(r) for r in rows] == [(0.5, 0.0, 1.0, 2.0), (0.0, 0.0, 0.0, 0.0)]


def test_activity_needs_seven_fields_only(spark, write_lines):
    rows = lines.read_activity(spark, write_lines("h", "t,1,39,1,2,3,4")).collect()
    assert tuple(rows[0]) == (1.0, 2.0, 3.0, 4.0)


@pytest.mark.parametrize("bad", ["t,1,39,x,,1,2,3", "t,1,39,1,2,3", "t,1,39,1 2,,1,2,3"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_activity_raises(spark, write_lines, bad, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not 7 fields|bad smsin"):
            lines.read_activity(spark, write_lines("header", bad)).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_flowers(spark, write_lines):
    rows = ("5.0,3.4,1.5,0.2", "6.1,2.8,4.1,1.3", "6.6,3.0,5.6,2.1")
    names = ("Iris-setosa", "Iris-versicolor", "other")
    labelled = [f"{i},{r},{n}" for i, (r, n) in enumerate(zip(rows, names))]
    found = lines.read_labelled(spark, write_lines("Id,a,b,c,d,Species", *labelled)).collect()
    assert [r.label for r in found] == [1.0, 2.0, 3.0]
    assert tuple(found[0])[1:] == (5.0, 3.4, 1.5, 0.2)
    bare = [f"{i},{r}" for i, r in enumerate(rows)]
    for content in (labelled, bare):
        found = lines.read_unlabelled(spark, write_lines("Id,a,b,c,d,Species", *content)).collect()
        assert tuple(found[2]) == (6.6, 3.0, 5.6, 2.1)
    with pytest.raises(Exception, match="not 6 fields"):
        lines.read_labelled(spark, write_lines("Id", *bare)).collect()


def test_ratings_need_exactly_three_fields(spark, write_lines):
    found = lines.read_ratings(spark, write_lines("1,10,4.0", "1,11,2.5", "2,10,5.0"))
    assert found.dtypes == [("user", "int"), ("item", "int"), ("rating", "double")]
    assert [tuple(r) for r in found.collect()] == [(1, 10, 4.0), (1, 11, 2.5), (2, 10, 5.0)]
    for bad in ("1,2", "1,2,3,4", "a,2,3", "1.5,2,3"):
        with pytest.raises(Exception, match="not 3 fields|bad user"):
            lines.read_ratings(spark, write_lines(bad)).collect()
    assert tuple(lines.read_pairs(spark, write_lines("1,10")).first()) == (1, 10)


def test_matrix_of_any_width(spark, write_lines):
    found = lines.read_matrix(spark, write_lines("1 2 3.5", "4 5 6.0")).collect()
    assert [r.x for r in found] == [[1.0, 2.0, 3.5], [4.0, 5.0, 6.0]]
    with pytest.raises(Exception, match="not 3 numbers"):
        lines.read_matrix(spark, write_lines("1 2 3", "4 5")).collect()
    with pytest.raises(Exception, match="bad number"):
        lines.read_matrix(spark, write_lines("1 2 3", "4  5")).collect()
    with pytest.raises(ValueError, match="empty"):
        lines.read_matrix(spark, write_lines())


def test_header_look_alike_stays(spark):
    df = spark.createDataFrame([("Id,x",), ("Iris,1",), ("",), ("2,1",)], "value string")
    assert [r.value for r in lines.drop_header(df.coalesce(1)).collect()] == ["Iris,1", "", "2,1"]


def test_header_of_every_file_goes(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text(f"h,x\n{name},1\n")
    rows = lines.drop_header(lines.read_lines(spark, str(tmp_path))).collect()
    assert sorted(r.value for r in rows) == ["a,1", "b,1"]


def test_scalar_functions(spark):
    df = spark.createDataFrame([("", "Iris-setosa"), ("2.5", "Iris-versicolor"), ("-1", "x")], "t string, c string")
    found = df.select(number_or_zero(F.col("t")), class_code(F.col("c"))).collect()
    assert [tuple(r) for r in found] == [(0.0, 1.0), (2.5, 2.0), (-1.0, 3.0)]
    with pytest.raises(Exception, match="bad number"):
        df.select(number_or_zero(F.col("c"))).collect()


def test_tokens(spark):
    df = spark.createDataFrame([("a  b ",), ("  ",), ("",), ("x",)], "t string")
    kept = [r[0] for r in df.select(split_tokens(F.col("t"))).collect()]
    assert kept == [["a", "", "b", ""], ["", "", ""], [""], ["x"]]
    stripped = [r[0] for r in df.select(split_tokens(F.col("t"), True)).collect()]
    assert stripped == [["a", "", "b"], [], [""], ["x"]]


def test_buckets_match_the_rdd_hashing(spark):
    from pyspark.mllib.feature import HashingTF

    terms = ["", "a", "word", "räksmörgås", "日本", "x" * 37]
    df = spark.createDataFrame([(t,) for t in terms], "t string")
    jvm = spark.sparkContext._jvm.org.apache.spark.mllib.feature.HashingTF
    for buckets in (HashingTF().numFeatures, 29):
        expected = [jvm(buckets).indexOf(t) for t in terms]
        assert [r[0] for r in df.select(term_bucket(F.col("t"), buckets)).collect()] == expected
    with pytest.raises(ValueError):
        term_bucket(F.col("t"), -1)


def test_writers_refuse_an_existing_path(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 0.5)], "i int, s string, d double").coalesce(1)
    for fmt in storage.FORMATS:
        path = str(tmp_path / fmt)
        storage.write_result(df, path, fmt)
        with pytest.raises(AnalysisException):
            storage.write_result(df, path, fmt)
    text = [r.value for r in spark.read.text(str(tmp_path / "text")).collect()]
    assert text == ["(1,a,null)", "(2,b,0.5)"]
    with pytest.raises(ValueError, match="format"):
        storage.write_result(df, str(tmp_path / "x"), "xml")


def test_work_path_uses_the_shared_folder(spark):
    assert storage.work_path(spark, "t").startswith(spark.conf.get("spark.checkpoint.dir"))
    staged = storage.stage(spark.range(5), "t")
    assert sorted(r.id for r in staged.collect()) == [0, 1, 2, 3, 4]


def test_models_survive_saving(spark, tmp_path):
    third = 1.0 / 3.0
    for number, features in enumerate((["a", "b"], "x")):
        model = kmeans.KMeansModel(features, [[third, 2.0], [-0.1, 1e-300]])
        path = str(tmp_path / f"kmeans-{number}")
        storage.save_kmeans(spark, model, path)
        assert storage.load_kmeans(spark, path) == model
    for number, (labels, label_type) in enumerate(
        [([1.0, 2.5], "double"), (["n", "y"], "string"), ([3, 4], "int")]
    ):
        model = naive_bayes.NaiveBayesModel(["a"], labels, [third, 0.5], [[-1.5], [third]], label_type)
        path = str(tmp_path / f"bayes-{number}")
        storage.save_naive_bayes(spark, model, path)
        assert storage.load_naive_bayes(spark, path) == model
    model = pca.PcaModel("x", ["0", "1"], [[third, 0.5]], [0.75])
    storage.save_pca(spark, model, str(tmp_path / "pca"))
    assert storage.load_pca(spark, str(tmp_path / "pca")) == model


def test_lines_are_written_in_parallel_below_a_header_each(spark):
    values = spark.range(90).select(F.col("id").cast("string").alias("value")).repartition(3)
    path = queries._file(values, "header", "headed")
    place = F.monotonically_increasing_id().alias("place")
    read = spark.read.text(path).select("value", F.input_file_name().alias("file"), place)
    sizes = read.groupBy("file").agg(F.count("*"), F.min_by("value", "place")).drop("file").collect()
    assert len(sizes) == 4 and {first for _, first in sizes} == {"header"} and max(sizes)[0] < 60
    back = lines.drop_header(lines.read_lines(spark, path))
    assert sorted(int(r.value) for r in back.collect()) == list(range(90))
    empty = lines.read_lines(spark, queries._file(values.limit(0), "header", "headed"))
    assert lines.drop_header(empty).collect() == []


def test_line_numbers_do_not_depend_on_splits(spark, tmp_path):
    """Two files with lines of all lengths, empty ones among them, read in one and in many parts."""
    for name, n in (("a", 700), ("b", 300)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i} " * (i % 7) + "\n" for i in range(n)))
    expected = [f"{name}{i} " * (i % 7) for name, n in (("a", 700), ("b", 300)) for i in range(n)]
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    try:
        for size in ("128m", "1000b", "333b"):
            spark.conf.set(setting, size)
            rows = lines.read_documents(spark, str(tmp_path)).collect()
            assert [r.text for r in sorted(rows, key=lambda r: r.doc_id)] == expected
            assert sorted(r.doc_id for r in rows) == list(range(1000))
    finally:
        spark.conf.set(setting, before)
