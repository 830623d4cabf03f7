"""Image goldens on PNG fixtures written with stdlib zlib (via the tiny encoder)."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from furiframe.functions.png import encode_png
from furiframe.operators import image as I
from furiframe.sources import files

from .pngread import decode_png


def _box(h, w, c, x0, x1, y0, y1, ink=0, fill=255):
    a = np.full((h, w, c), fill, np.uint8)
    a[y0:y1, x0:x1, :3 if c >= 3 else 1] = ink
    if c == 4:
        a[:, :, 3] = 0  # fully transparent: alpha is ignored
    return a


@pytest.fixture(scope="module")
def image_dir():
    d = tempfile.mkdtemp(prefix="furiframe-img-")
    fixtures = {
        "rgb.png": encode_png(_box(20, 40, 3, 5, 10, 6, 9)),
        "rgba.png": encode_png(_box(20, 40, 4, 5, 10, 6, 9)),
        "gray.png": encode_png(_box(10, 30, 1, 2, 4, 1, 3, ink=200)[:, :, 0]),
        "white.png": encode_png(np.full((10, 40, 3), 255, np.uint8)),
        "edge.png": encode_png(_box(10, 40, 3, 30, 35, 2, 4)),
        "w20.png": encode_png(_box(10, 20, 3, 2, 4, 2, 4)),
        "w10.png": encode_png(_box(10, 10, 3, 2, 4, 2, 4)),
    }
    good = fixtures["rgb.png"]
    fixtures["truncated.png"] = good[: len(good) // 2]
    bad = bytearray(good)
    bad[29] ^= 0xFF  # IHDR CRC byte
    fixtures["badcrc.png"] = bytes(bad)
    fixtures["empty.png"] = b""
    for name, data in fixtures.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(data)
    with open(os.path.join(d, "note.txt"), "w") as f:
        f.write("not an image")
    return d


@pytest.fixture(scope="module")
def boxes(spark, image_dir):
    imgs = files.image_files(spark, image_dir)
    return {r["origin"].rsplit("/", 1)[-1]: r for r in I.content_boxes(imgs).collect()}


def test_content_boxes(boxes):
    assert (boxes["rgb.png"]["left"], boxes["rgb.png"]["upper"], boxes["rgb.png"]["right"],
            boxes["rgb.png"]["lower"]) == (3, 4, 12, 11)
    assert boxes["rgb.png"]["width"] == 20 and boxes["rgb.png"]["status"] == "cropped"
    assert (boxes["rgba.png"]["left"], boxes["rgba.png"]["lower"]) == (3, 11)
    g = boxes["gray.png"]
    assert (g["left"], g["upper"], g["right"], g["lower"]) == (0, 0, 6, 5)
    for blank in ("white.png", "edge.png", "w20.png"):
        assert boxes[blank]["status"] == "blank", blank
    assert boxes["w10.png"]["status"] == "error"
    assert boxes["truncated.png"]["status"] == "error"
    # The decoder tolerates a bad CRC; the structural check below catches it.
    assert boxes["badcrc.png"]["status"] == "cropped"
    assert "empty.png" not in boxes and "note.txt" not in boxes  # zero-byte files are not listed; glob


def test_crop_pixels(spark, image_dir):
    imgs = files.image_files(spark, image_dir).where(F.col("name") == "rgb.png")
    row = I.crop_images(imgs).first()
    px = decode_png(bytes(row["png"]))
    expected = _box(20, 40, 3, 5, 10, 6, 9)[4:11, 3:12]
    assert px.shape == (7, 9, 3) and np.array_equal(px, expected)


def test_invalid_and_rgb(spark, image_dir):
    imgs = files.image_files(spark, image_dir)
    bad = sorted(r["name"] for r in I.invalid_images(imgs).select("name").collect())
    assert bad == ["truncated.png"]
    checked = {r["name"]: r["p"] for r in files.binary_files(spark, image_dir, "*.png")
               .select("name", I.png_check("content").alias("p")).collect()}
    assert checked["badcrc.png"] == "bad CRC in IHDR" and checked["truncated.png"] == "truncated chunk"
    assert checked["rgb.png"] is None and "empty.png" not in checked
    rgb = {r["origin"].rsplit("/", 1)[-1]: r for r in I.rgb_images(imgs.where(F.col("image.height") > 0)).collect()}
    g = np.frombuffer(bytes(rgb["gray.png"]["rgb"]), np.uint8).reshape(10, 30, 3)
    assert g[1, 2].tolist() == [200, 200, 200] and g[0, 0].tolist() == [255, 255, 255]


def test_a_short_buffer_is_a_row_with_an_error(spark):
    df = spark.createDataFrame([("a", 2, 2, 3, bytearray(5)), ("b", 1, 1, 3, bytearray([1, 2, 3])), ("c", None, None, None, None)],
                               "origin string, height int, width int, nChannels int, data binary")
    got = {r["origin"]: r for r in I.rgb_images(df).collect()}
    assert got["a"]["rgb"] is None and got["a"]["error"] and got["c"]["error"] and got["c"]["height"] is None
    assert bytes(got["b"]["rgb"]) == bytes([3, 2, 1]) and got["b"]["error"] is None


def test_manifest_keeps_zero_byte_files(spark, image_dir):
    m = {r["name"]: r["size"] for r in files.file_manifest(spark, image_dir, "image", "*.png").collect()}
    assert m["empty.png"] == 0 and "note.txt" not in m and len(m) == 10


def test_payload(spark, image_dir):
    b = files.binary_files(spark, image_dir, "rgb.png")
    body = b.select(I.recognition_request("content", "m:1", "read").alias("j")).first()["j"]
    import base64
    import json
    d = json.loads(body)
    url = d["messages"][0]["content"][1]["image_url"]["url"]
    with open(os.path.join(image_dir, "rgb.png"), "rb") as f:
        assert url == "data:image/png;base64," + base64.b64encode(f.read()).decode()
    assert d["max_tokens"] == 8192 and d["temperature"] == 0.1 and d["model"] == "m:1"
    assert d["messages"][0]["content"][0] == {"type": "text", "text": "read"}


def test_png_roundtrip():
    a = np.random.default_rng(0).integers(0, 256, (7, 5, 4), dtype=np.uint8)
    assert np.array_equal(decode_png(encode_png(a)), a)
