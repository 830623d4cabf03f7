"""Image-table operators: content box, margin crop, RGB conversion, payloads.

Input is Spark's ``image`` struct flattened to columns
``origin, height, width, nChannels, data`` (BGR(A) bytes, as the ``image``
source gives them). Pixel work runs in row UDFs (numpy per image), whose
batches are few rows whatever the session's Arrow setting. Everything else
(margins, counts, payload strings) is Column expressions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furiframe.functions.png import encode_png, png_problem

# --- Fixed values ------------------------------------------------------------
SCROLLBAR_PX = 20   # cut from the right edge before looking for content
MARGIN_PX = 2       # margin kept around the content box
MAX_TOKENS = 8192   # recognition request settings
TEMPERATURE = 0.1
# -----------------------------------------------------------------------------

BOX_FIELDS = "width int, height int, left int, upper int, right int, lower int, status string, error string"
CROP_FIELDS = BOX_FIELDS + ", png binary, rgb binary"
RGB_FIELDS = "height int, width int, rgb binary, error string"


def _pixels(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8, count=height * width * channels).reshape(height, width, channels)


def luma(bgr: np.ndarray) -> np.ndarray:
    """8-bit gray of BGR(A) pixels, alpha ignored: (19595 R + 38470 G + 7471 B + 32768) >> 16."""
    if bgr.shape[2] < 3:
        return bgr[:, :, 0].astype(np.uint32)
    b, g, r = (bgr[:, :, i].astype(np.uint32) for i in range(3))
    return (19595 * r + 38470 * g + 7471 * b + 32768) >> 16


def content_box(bgr: np.ndarray) -> tuple[int, int, int, int] | None:
    """(left, upper, right, lower) of the non-white pixels, right/lower exclusive."""
    ink = luma(bgr) < 255
    cols, rows = np.flatnonzero(ink.any(axis=0)), np.flatnonzero(ink.any(axis=1))
    if cols.size == 0:
        return None
    return int(cols[0]), int(rows[0]), int(cols[-1]) + 1, int(rows[-1]) + 1


def to_rgb(bgr: np.ndarray) -> np.ndarray:
    """BGR(A) / gray -> RGB (alpha dropped, gray replicated)."""
    if bgr.shape[2] == 1:
        return np.repeat(bgr, 3, axis=2)
    return bgr[:, :, 2::-1]


def _rgba_order(bgr: np.ndarray) -> np.ndarray:
    if bgr.shape[2] == 4:
        return bgr[:, :, [2, 1, 0, 3]]
    if bgr.shape[2] == 3:
        return bgr[:, :, ::-1]
    return bgr


def _crop_row(h: int | None, w: int | None, c: int | None, data: bytes | None, cut: int, margin: int, encode: bool) -> tuple:
    width = height = png = rgb = error = None
    box: tuple = (None, None, None, None)
    try:
        if h is None or h < 0 or data is None:
            raise ValueError("undecodable image")
        if w - cut < 0:
            raise ValueError(f"image narrower than the {cut} px cut")
        img = _pixels(h, w, c, data)[:, : w - cut]
        height, width = img.shape[:2]
        found = content_box(img) if width > 0 else None
        status = "blank" if found is None else "cropped"
        if found is not None:
            l0, u0, r0, d0 = found
            l, u, r, d = box = max(0, l0 - margin), max(0, u0 - margin), min(width, r0 + margin), min(height, d0 + margin)
            if encode:
                png = encode_png(_rgba_order(img[u:d, l:r]))
                rgb = to_rgb(img[u:d, l:r]).tobytes()
    except Exception as e:  # noqa: BLE001 - a bad image is a row, never a failed job
        status, error = "error", str(e)
    return (width, height, *box, status, error, *((png, rgb) if encode else ()))


def _flat(images: DataFrame, image_col: str) -> DataFrame:
    if image_col in images.columns and "origin" not in images.columns:
        return images.select(f"{image_col}.origin", f"{image_col}.height", f"{image_col}.width",
                             f"{image_col}.nChannels", f"{image_col}.data")
    return images.select("origin", "height", "width", "nChannels", "data")


def _per_image(flat: DataFrame, run, fields: str) -> DataFrame:
    """``origin`` and the ``fields`` that ``run(height, width, nChannels, data)`` returns. A row UDF, not an Arrow one:
    its batches are 100 rows whatever the session's Arrow setting, so a worker holds few images at a time."""
    seen = F.udf(run, fields, useArrow=False)
    return flat.select("origin", seen("height", "width", "nChannels", "data").alias("_seen")).select("origin", "_seen.*")


def content_boxes(images: DataFrame, image_col: str = "image", cut: int = SCROLLBAR_PX,
                  margin: int = MARGIN_PX) -> DataFrame:
    """Crop box per image after the right-edge cut, with the margin added and
    clamped: ``origin, width, height, left, upper, right, lower, status, error``.
    ``status`` is 'cropped', 'blank' (all white) or 'error'."""
    return _per_image(_flat(images, image_col), lambda h, w, c, data: _crop_row(h, w, c, data, cut, margin, False), BOX_FIELDS)


def crop_images(images: DataFrame, image_col: str = "image", cut: int = SCROLLBAR_PX,
                margin: int = MARGIN_PX) -> DataFrame:
    """``content_boxes`` plus the cropped pixels, re-encoded as PNG (``png``) and as RGB bytes (``rgb``)."""
    return _per_image(_flat(images, image_col), lambda h, w, c, data: _crop_row(h, w, c, data, cut, margin, True), CROP_FIELDS)


def rgb_images(images: DataFrame, image_col: str = "image") -> DataFrame:
    """Force 3-channel RGB: ``origin, height, width, rgb, error`` (row-major bytes; a bad image is a row
    with an error)."""
    def run(h, w, c, data) -> tuple:
        rgb = error = None
        try:
            if h is None or h < 0 or data is None:
                raise ValueError("undecodable image")
            rgb = to_rgb(_pixels(h, w, c, data)).tobytes()
        except Exception as e:  # noqa: BLE001 - a bad image is a row, never a failed job
            error = str(e)
        return h, w, rgb, error

    return _per_image(_flat(images, image_col), run, RGB_FIELDS)


def crop_summary(boxes: DataFrame) -> DataFrame:
    """Processed / cropped / blank (skipped) / error counts in one aggregate."""
    st = F.col("status")
    return boxes.agg(F.count(F.lit(1)).alias("processed"), F.count_if(st == "cropped").alias("cropped"),
                     F.count_if(st == "blank").alias("skipped"), F.count_if(st == "error").alias("errors"))


def invalid_images(images: DataFrame, image_col: str = "image") -> DataFrame:
    """Rows the decoder rejected (the ``image`` source marks them with height -1)."""
    return images.where(F.col(f"{image_col}.height") < 0)


def png_check(content) -> Column:
    """Structural PNG verification (CRCs, chunk order) -> problem text or null.
    Stricter than the decoder, which tolerates bad CRCs. A row UDF: few files at a time in a worker."""
    c = F.col(content) if isinstance(content, str) else content
    return F.udf(lambda b: png_problem(bytes(b)) if b is not None else "zero-size file", "string", useArrow=False)(c)


def base64_text(content) -> Column:
    """Standard base64 without line breaks."""
    c = F.col(content) if isinstance(content, str) else content
    return F.replace(F.replace(F.base64(c), F.lit("\r\n"), F.lit("")), F.lit("\n"), F.lit(""))


def data_uri(content, mime: str = "image/png") -> Column:
    return F.concat(F.lit(f"data:{mime};base64,"), base64_text(content))


def recognition_request(content, model: str, prompt: str, max_tokens: int = MAX_TOKENS,
                        temperature: float = TEMPERATURE) -> Column:
    """Chat-completions request body: text part + image_url data URI part."""
    msg = F.struct(
        F.lit("user").alias("role"),
        F.array(
            F.struct(F.lit("text").alias("type"), F.lit(prompt).alias("text"),
                     F.lit(None).cast("struct<url:string>").alias("image_url")),
            F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"),
                     F.struct(data_uri(content).alias("url")).alias("image_url")),
        ).alias("content"))
    body = F.struct(F.lit(model).alias("model"), F.array(msg).alias("messages"),
                    F.lit(max_tokens).alias("max_tokens"), F.lit(temperature).alias("temperature"))
    return F.to_json(body)
