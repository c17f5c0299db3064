"""Sources: image rows, target split, seeded point sets, round trips."""


import pytest
from pyspark.sql import functions as F

from orrery.sources import files as FS
from orrery.sources import images as IM
from orrery.sources import synthetic as SY


def test_pixel_rows_bgr_layout(spark):
    # 2 x 3 image, bytes B, G, R per pixel, row after row
    px = [(10, 20, 30), (40, 50, 60), (70, 80, 90), (1, 2, 3), (4, 5, 6), (7, 8, 9)]
    data = bytes(v for r, g, b in px for v in (b, g, r))
    df = spark.createDataFrame([(("img", 2, 3, 3, 16, bytearray(data)),)], f"image {IM.IMAGE_SCHEMA}")
    got = [(r["pixel"], r["y"], r["x"], r["r"], r["g"], r["b"]) for r in IM.pixel_rows(df).orderBy("pixel").collect()]
    want = [(i, i // 3, i % 3, *px[i]) for i in range(6)]
    assert got == want


def test_pixel_rows_grey(spark):
    df = spark.createDataFrame([(("g", 1, 2, 1, 0, bytearray([0, 255])),)], f"image {IM.IMAGE_SCHEMA}")
    got = [(r["r"], r["g"], r["b"]) for r in IM.pixel_rows(df).orderBy("pixel").collect()]
    assert got == [(0, 0, 0), (255, 255, 255)]


def test_image_round_trip(spark):
    df = spark.createDataFrame([(0, [1, 2, 3, 4], [5, 6, 7, 8], [9, 10, 11, 255])],
                               "id int, r array<int>, g array<int>, b array<int>")
    img = df.select(IM.image_from_channels(F.lit("x"), 2, 2, F.col("r"), F.col("g"), F.col("b")).alias("image"))
    got = [(r["r"], r["g"], r["b"]) for r in IM.pixel_rows(img).orderBy("pixel").collect()]
    assert got == [(1, 5, 9), (2, 6, 10), (3, 7, 11), (4, 8, 255)]


def test_split_target(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, "a")], "k long, x double, y double, t string")
    r = FS.split_target(df, -1, keep=1).first()
    assert (r["k"], list(r["features"]), r["target"]) == (1, [2.0, 3.0], "a")


def _keys(spark, n=4000):
    return spark.range(n).withColumnRenamed("id", "k")


def test_uniform_is_partition_independent(spark):
    a = _keys(spark).repartition(3).select("k", SY.uniform(F.col("k"), 5, 1).alias("u"))
    b = _keys(spark).repartition(7).select("k", SY.uniform(F.col("k"), 5, 1).alias("u"))
    assert a.join(b.withColumnRenamed("u", "u2"), "k").filter(F.col("u") != F.col("u2")).count() == 0
    s = a.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert s[0] >= 0 and s[1] < 1 and abs(s[2] - 0.5) < 0.03


def test_normal_moments(spark):
    z = _keys(spark, 20000).select(SY.normal(F.col("k"), 3, 1).alias("z"))
    m = z.agg(F.avg("z"), F.stddev_pop("z")).first()
    assert abs(m[0]) < 0.03 and abs(m[1] - 1) < 0.03


def test_blobs_circles_moons(spark):
    k = _keys(spark)
    b = SY.blobs(k, "k", 3, 2, 0.5, seed=1)
    per = b.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                 F.stddev_pop(F.col("x")[0]).alias("s")).collect()
    assert len(per) == 3 and all(abs(r["s"] - 0.5) < 0.05 for r in per)
    c = SY.circles(k, "k", 0.5, 0.0, seed=1).select(
        "label", F.sqrt(F.col("x")[0] ** 2 + F.col("x")[1] ** 2).alias("r"))
    radii = {r["label"]: (r["lo"], r["hi"]) for r in
             c.groupBy("label").agg(F.min("r").alias("lo"), F.max("r").alias("hi")).collect()}
    assert radii[0] == pytest.approx((1.0, 1.0)) and radii[1] == pytest.approx((0.5, 0.5))
    m = SY.moons(k, "k", 0.0, seed=1).filter(F.col("label") == 0).select(
        F.sqrt(F.col("x")[0] ** 2 + F.col("x")[1] ** 2).alias("r"), (F.col("x")[1] >= -1e-12).alias("up"))
    assert m.filter((F.abs(F.col("r") - 1) > 1e-9) | ~F.col("up")).count() == 0


def test_outlier_appended(spark):
    pts = SY.with_outlier(SY.blobs(_keys(spark, 10), "k", 2), [9.0, 9.0])
    assert pts.count() == 11
    assert pts.filter(F.col("id") == -1).first()["x"] == [9.0, 9.0]


def test_csv_append_and_json_round_trip(spark):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, 2.5)], "k long, s string, v double")
    p = FS.scratch_path(spark, "t")
    FS.write_csv(df.filter("k = 1"), p)
    FS.write_csv(df.filter("k = 2"), p, mode="append")
    back = FS.read_csv(spark, p, "k long, s string, v double").orderBy("k").collect()
    assert [tuple(r) for r in back] == [(1, "a", 1.5), (2, None, 2.5)]
    j = FS.scratch_path(spark, "j")
    FS.write_json(df.select(F.struct("k", "s").alias("key"), F.array("v", "v").alias("a")), j)
    got = FS.read_json(spark, j, "key struct<k:long,s:string>, a array<double>").orderBy("key.k").collect()
    assert got[1]["key"]["s"] is None and list(got[0]["a"]) == [1.5, 1.5]


def test_whole_files(spark):
    df = spark.createDataFrame([("7_1", "line one\nline two\n"), ("8_0", "")], "name string, text string")
    p = FS.write_file_per_key(df, FS.scratch_path(spark, "w"), "name", "text")
    got = {(r["a"], r["b"]): r["text"] for r in
           FS.read_whole_files(spark, p, r"name=(\d+)_(\d+)/", {"a": 1, "b": 2}).collect()}
    assert got == {("7", "1"): "line one\nline two\n", ("8", "0"): ""}


def test_stream_scoring_equals_batch(spark):
    import __spark_entry__ as E
    q = E.queries()
    from conftest import SF_SMALL
    batch = {r["vec_id"]: r["prediction"] for r in q["ml21_score_new_rows"](spark, SF_SMALL).collect()}
    stream = {r["vec_id"]: r["prediction"] for r in q["ml21_score_new_rows_stream"](spark, SF_SMALL).collect()}
    assert stream == batch and len(batch) > 0
