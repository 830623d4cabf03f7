"""Hygiene goldens: order of steps, survivors + rejects = inputs."""

from furiframe.operators import clean


def _frames(spark):
    texts = spark.createDataFrame(
        [("a", 10), ("b", 0), ("c", 5), ("d", 7), ("t", 3)], "stem string, size long")
    images = spark.createDataFrame(
        [("a", 100, True), ("b", 100, True), ("c", 100, False), ("d", 0, True), ("o", 50, True)],
        "stem string, size long, valid boolean")
    return images, texts


def test_hygiene_goldens(spark):
    images, texts = _frames(spark)
    kept = clean.clean_empty(texts)
    assert sorted(r.stem for r in kept.collect()) == ["a", "c", "d", "t"]
    # image 'b' lost its (empty) text, 'o' never had one
    assert sorted(r.stem for r in clean.clean_orphans(images, kept).collect()) == ["b", "o"]
    # 'c' undecodable, 'd' zero bytes: both go with their texts; 't' (no image) stays
    assert sorted(r.stem for r in clean.clean_sync(images, kept).collect()) == ["a"]
    assert sorted(r.stem for r in clean.surviving_texts(images, kept).collect()) == ["a", "t"]
    assert sorted(r.stem for r in clean.surviving_texts(images, kept, two_way=True).collect()) == ["a"]


def test_rejects_and_summary_account_for_everything(spark):
    images, texts = _frames(spark)
    rej = {(r.stem, r.kind, r.reason) for r in clean.rejects(images, texts).collect()}
    assert rej == {("b", "text", "empty"), ("b", "image", "orphan"), ("o", "image", "orphan"),
                   ("c", "image", "corrupt"), ("d", "image", "corrupt"),
                   ("c", "text", "corrupt_image"), ("d", "text", "corrupt_image")}
    s = clean.clean_summary(images, texts).first().asDict()
    assert s == {"texts_total": 5, "images_total": 5, "texts_empty": 1, "images_orphaned": 2,
                 "images_corrupt": 2, "texts_dropped_with_image": 2, "images_kept": 1, "texts_kept": 2}
