from pyspark.sql import functions as F

from tidemark.operators import sketches
from tidemark.sinks import manifest
from tidemark.session import hadoop_fs


def test_manifest_issues(spark, tmp_path):
    path = (tmp_path / "landing").as_uri()
    rows = spark.range(60).select("id", (F.col("id") % 6).alias("day"))
    rows.repartition(1).write.partitionBy("day").json(path)
    manifest.record(spark, path)
    assert manifest.recorded(spark, path).count() == 6 and manifest.issues(spark, path).count() == 0
    names = sorted(r.path for r in manifest.recorded(spark, path).collect())
    fs, first = hadoop_fs(spark, names[0])
    fs.delete(first, False)
    for name, text in ((names[1], b""), (names[2], b"{}")):
        fs, file = hadoop_fs(spark, name)
        out = fs.create(file, True)
        out.write(bytearray(text))
        out.close()
    rows.where("day = 3").repartition(1).write.mode("append").partitionBy("day").json(path)
    found = {r.path: r.issue for r in manifest.issues(spark, path).collect()}
    assert [found.pop(names[i]) for i in (0, 1, 2)] == ["lost", "lost", "changed"]
    assert list(found.values()) == ["unknown"]
    manifest.record(spark, path)
    assert manifest.recorded(spark, path).where("size > 2").count() == 7
    assert manifest.issues(spark, path).where("issue = 'unknown'").count() == 0


def test_sketches_unite(spark):
    rows = spark.range(200_000).select((F.col("id") % 40).alias("day"), (F.col("id") % 3).alias("k"), (F.col("id") % 50_000).alias("v"))
    days = sketches.distinct_sketches(rows, ["k", "day"], "v")
    for keys in ([], ["k"]):
        about = sketches.united(days, keys).select(*keys, sketches.estimate().alias("n")).collect()
        assert len(about) == (3 if keys else 1)
        assert all(abs(r.n - 50_000) <= 0.02 * 50_000 for r in about)
    odd = spark.createDataFrame([(1, None), (1, None), (2, 1.5), (2, 1.5), (None, 2.0)], "k int, v double")
    assert {(r.k, r.n) for r in sketches.distinct_sketches(odd, ["k"], "v").select("k", sketches.estimate().alias("n")).collect()} == {(1, 0), (2, 1), (None, 1)}
    assert sketches.united(sketches.distinct_sketches(odd.limit(0), ["k"], "v"), ["k"]).count() == 0
