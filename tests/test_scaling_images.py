from pyspark.sql import functions as F

from furiframe.operators import image as I


def test_image_workers_get_few_rows_at_a_time(spark):
    """The batch of an image operator must not follow the session's Arrow setting (10,000 rows by default)."""
    images = spark.range(3).select(F.col("id").cast("string").alias("origin"), F.lit(1).alias("height"), F.lit(30).alias("width"),
                                   F.lit(3).alias("nChannels"), F.unhex(F.repeat(F.lit("00"), F.lit(90))).alias("data"))
    for df in (I.content_boxes(images), I.crop_images(images), I.rgb_images(images), images.select(I.png_check("data"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan and "MapInPandas" not in plan
    assert {tuple(r) for r in I.crop_images(images).select("origin", "status", "left", "right", F.octet_length("rgb")).collect()} == {
        (str(i), "cropped", 0, 10, 30) for i in range(3)}
