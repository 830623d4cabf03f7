"""Registered queries: image tables derived from ``documents``.

Stand-in for rendered pages (no renderer runs here): every document becomes
a 3-channel bitmap with one pixel per character -- white for a space, black
for a lower-case letter, a colour for a capital, and values next to the ink
threshold for the rest -- one pixel row per text line, a white
frame (3 px left, 2 rows top and bottom) and a white 20 px strip on the
right where a scroll bar would be. The pixels are built with Column
functions (``unhex`` of a hex string), so the image operators run on
table-derived data of realistic shape.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from furiframe.operators import image as I
from furiframe.operators.dataset import OCR_USER_PROMPT
from furiframe.plans import sqltext as S
from furiframe.plans.tables import table

LEFT, TOP, BOTTOM = 3, 2, 2
# Pixels in the byte order of the image source (blue, green, red). A comma is four levels of blue short of
# white, which the gray scale rounds back to white; a full stop is four levels of red short and everything
# else one level of green, which are ink. Swapped channels would change boxes and hashes.
WHITE, BLACK, CAPITAL, COMMA, STOP, OTHER = "FFFFFF", "000000", "0A64C8", "FBFFFF", "FFFFFB", "FFFEFF"
MODEL = "ocr:l"


def page_images(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n", -1).alias("lines"))
    width = F.array_max(F.transform("lines", lambda ln: F.length(ln))) + LEFT + I.SCROLLBAR_PX

    def pixel(c):
        return (F.when(c == " ", F.lit(WHITE)).when((c >= "a") & (c <= "z"), F.lit(BLACK))
                .when((c >= "A") & (c <= "Z"), F.lit(CAPITAL)).when(c == ",", F.lit(COMMA))
                .when(c == ".", F.lit(STOP)).otherwise(F.lit(OTHER)))

    def row(ln, w):
        body = F.array_join(F.transform(F.regexp_extract_all(ln, F.lit("(?s)."), F.lit(0)), pixel), "")
        return F.concat(F.repeat(F.lit(WHITE), F.lit(LEFT)), body,
                        F.repeat(F.lit(WHITE), w - LEFT - F.length(ln)))

    sized = docs.select("doc_id", "lines", width.alias("w"))
    white_row = F.repeat(F.lit(WHITE), F.col("w"))
    hexdata = F.concat(F.repeat(white_row, F.lit(TOP)),
                       F.array_join(F.transform("lines", lambda ln: row(ln, F.col("w"))), ""),
                       F.repeat(white_row, F.lit(BOTTOM)))
    return sized.select(
        F.concat(F.lit("pages/"), F.col("doc_id").cast("string"), F.lit(".png")).alias("origin"),
        (F.size("lines") + TOP + BOTTOM).cast("int").alias("height"),
        F.col("w").cast("int").alias("width"),
        F.lit(3).alias("nChannels"),
        F.unhex(hexdata).alias("data"))


def _doc_id(origin="origin"):
    return F.regexp_extract(F.col(origin), r"(\d+)\.png$", 1).cast("long").alias("doc_id")


def q_image_bbox(spark, sf_dir):
    boxes = I.content_boxes(page_images(spark, sf_dir))
    return boxes.select(_doc_id(), "width", "height", "left", "upper", "right", "lower", "status")


def q_image_crop(spark, sf_dir):
    crops = I.crop_images(page_images(spark, sf_dir))
    return crops.select(_doc_id(), (F.col("right") - F.col("left")).alias("crop_width"),
                        (F.col("lower") - F.col("upper")).alias("crop_height"),
                        (F.substr(F.hex("png"), F.lit(1), F.lit(16)) == F.lit("89504E470D0A1A0A")).alias("is_png"),
                        F.md5("rgb").alias("rgb_md5"))


def q_image_summary(spark, sf_dir):
    return I.crop_summary(I.content_boxes(page_images(spark, sf_dir)))


def q_image_rgb(spark, sf_dir):
    rgb = I.rgb_images(page_images(spark, sf_dir))
    return rgb.select(_doc_id(), F.octet_length("rgb").cast("long").alias("n_bytes"), F.md5("rgb").alias("rgb_md5"), "error")


def _damaged_pngs(spark, sf_dir):
    """The cropped pages as PNG bytes, damaged where the first hex digit of the id's hash is under 7.

    An image starts with 8 bytes of signature and 25 of IHDR, and ends with 12 of IEND.
    """
    crops = I.crop_images(page_images(spark, sf_dir)).select(_doc_id(), F.coalesce("png", F.lit(b"")).alias("png"))
    digit = F.substr(F.md5(F.col("doc_id").cast("string")), F.lit(1), F.lit(1))
    size = F.octet_length("png")

    def cut(start, n):
        return F.substr("png", F.lit(start), n if not isinstance(n, int) else F.lit(n))

    broken = (F.when((digit == "0") | (size == 0), F.lit(b""))
              .when(digit == "1", cut(2, size - 1))
              .when(digit == "2", cut(1, size - 13))
              .when(digit == "3", cut(1, size - 12))
              .when(digit == "4", F.concat(cut(1, 8), cut(34, size - 33)))
              .when(digit == "5", F.concat(cut(1, 33), cut(-12, 12)))
              .when(digit == "6", F.concat(cut(1, 24), F.lit(b"\x09"), cut(26, size - 25)))
              .otherwise(F.col("png")))
    return crops.select("doc_id", broken.alias("content"))


def q_png_problems(spark, sf_dir):
    return _damaged_pngs(spark, sf_dir).select("doc_id", I.png_check("content").alias("problem"))


def q_base64_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", I.base64_text(F.encode("text", "UTF-8")).alias("b64"))


def q_image_payload(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    body = I.recognition_request(F.encode("text", "UTF-8"), MODEL, OCR_USER_PROMPT + "\n")
    return docs.select("doc_id", body.alias("request"))


QUERIES = {
    "image_bbox": q_image_bbox,
    "image_crop": q_image_crop,
    "image_rgb": q_image_rgb,
    "image_summary": q_image_summary,
    "png_problems": q_png_problems,
    "base64_text": q_base64_text,
    "image_payload": q_image_payload,
}

_LINES = """
  SELECT doc_id, line, i FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
    FROM documents)"""
_BOX = f"""
  SELECT d.doc_id,
         CAST(max(length(line)) + {LEFT} AS INTEGER) AS width,
         CAST(count(*) + {TOP + BOTTOM} AS INTEGER) AS height,
         min(CASE WHEN length(rtrim(line, ' ,')) > 0 THEN length(line) - length(ltrim(line, ' ,')) END) + {LEFT} AS l0,
         max(CASE WHEN length(rtrim(line, ' ,')) > 0 THEN length(rtrim(line, ' ,')) END) + {LEFT} AS r0,
         min(CASE WHEN length(rtrim(line, ' ,')) > 0 THEN i END) + {TOP} AS u0,
         max(CASE WHEN length(rtrim(line, ' ,')) > 0 THEN i END) + {TOP} + 1 AS d0
  FROM ({_LINES}) d GROUP BY d.doc_id"""
_CLAMPED = f"""
  SELECT doc_id, width, height,
         CAST(greatest(0, l0 - 2) AS INTEGER) AS "left", CAST(greatest(0, u0 - 2) AS INTEGER) AS upper,
         CAST(least(width, r0 + 2) AS INTEGER) AS "right", CAST(least(height, d0 + 2) AS INTEGER) AS lower,
         CASE WHEN l0 IS NULL THEN 'blank' ELSE 'cropped' END AS status
  FROM ({_BOX})"""


# The pixels as hex rows in RGB order, white frame rows included, cut columns already off.
_GRID = f"""
  SELECT l.doc_id, i + {TOP} AS y,
         repeat('{WHITE}', {LEFT}) || array_to_string(list_transform(string_split(line, ''), lambda c: CASE
           WHEN c = '' THEN '' WHEN c = ' ' THEN 'FFFFFF' WHEN c BETWEEN 'a' AND 'z' THEN '000000'
           WHEN c BETWEEN 'A' AND 'Z' THEN 'C8640A' WHEN c = ',' THEN 'FFFFFB' WHEN c = '.' THEN 'FBFFFF' ELSE 'FFFEFF' END), '')
           || repeat('FFFFFF', b.width - {LEFT} - length(line)) AS px
  FROM ({_LINES}) l JOIN ({_BOX}) b ON b.doc_id = l.doc_id
  UNION ALL
  SELECT doc_id, unnest([0, 1, height - 2, height - 1]) AS y, repeat('FFFFFF', width) AS px FROM ({_BOX})"""
_CROP_PIXELS = f"""
  SELECT c.doc_id, md5(unhex(string_agg(substr(px, "left" * 6 + 1, ("right" - "left") * 6), '' ORDER BY y))) AS rgb_md5
  FROM ({_CLAMPED}) c JOIN ({_GRID}) g ON g.doc_id = c.doc_id AND y >= upper AND y < lower GROUP BY c.doc_id"""


def _request_sql() -> str:
    prompt = S.sql_lit(OCR_USER_PROMPT + "\n")
    return f"""
      SELECT doc_id, CAST(json_object(
        'model', '{MODEL}',
        'messages', json_array(json_object('role', 'user', 'content', json_array(
            json_object('type', 'text', 'text', {prompt}),
            json_object('type', 'image_url', 'image_url',
                        json_object('url', 'data:image/png;base64,' || to_base64(encode(text))))))),
        'max_tokens', 8192, 'temperature', 0.1) AS VARCHAR) AS request
      FROM documents"""


ORACLES = {
    "image_bbox": f"SELECT doc_id, width, height, \"left\", upper, \"right\", lower, status FROM ({_CLAMPED})",
    "image_crop": f"""SELECT c.doc_id, "right" - "left" AS crop_width, lower - upper AS crop_height,
                             CASE WHEN status = 'cropped' THEN true END AS is_png, rgb_md5
                      FROM ({_CLAMPED}) c LEFT JOIN ({_CROP_PIXELS}) p ON p.doc_id = c.doc_id""",
    "image_rgb": f"""
        SELECT b.doc_id, CAST((width + 20) * height * 3 AS BIGINT) AS n_bytes,
               md5(unhex(string_agg(px || repeat('FFFFFF', 20), '' ORDER BY y))) AS rgb_md5, CAST(NULL AS VARCHAR) AS error
        FROM ({_BOX}) b JOIN ({_GRID}) g ON g.doc_id = b.doc_id GROUP BY b.doc_id, width, height""",
    "png_problems": f"""
        SELECT doc_id, CASE WHEN status = 'blank' THEN 'zero-size file' ELSE
          CASE substr(md5(CAST(doc_id AS VARCHAR)), 1, 1)
            WHEN '0' THEN 'zero-size file' WHEN '1' THEN 'not a PNG signature' WHEN '2' THEN 'truncated chunk'
            WHEN '3' THEN 'missing IEND' WHEN '4' THEN 'IHDR is not the first chunk' WHEN '5' THEN 'no image data'
            WHEN '6' THEN 'bad CRC in IHDR' END END AS problem
        FROM ({_CLAMPED})""",
    "base64_text": "SELECT doc_id, to_base64(encode(text)) AS b64 FROM documents",
    "image_summary": f"""
        SELECT count(*) AS processed, count(*) FILTER (WHERE status = 'cropped') AS cropped,
               count(*) FILTER (WHERE status = 'blank') AS skipped, CAST(0 AS BIGINT) AS errors
        FROM ({_CLAMPED})""",
    "image_payload": _request_sql(),
}
