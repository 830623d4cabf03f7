"""Paired image/transcript datasets, deterministic split, conversation records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furiframe.functions.text import py_strip
from furiframe.operators.joins import hash32, hash_rank

# --- Fixed values (prompt texts of the recognition task) --------------------
OCR_USER_PROMPT = (
    "Recognize all the Japanese text in this image. For any kanji that has furigana "
    "above it, please format it in Markdown as `[漢字]{かんじ}`. Present the entire "
    "recognized text in this Markdown format. Return only the recognized text."
)
OCR_SYSTEM_MESSAGE = (
    "You are an expert OCR model specializing in recognizing Japanese text, "
    "including handling furigana annotations correctly."
)
SPLIT_SEED = 42
TEST_FRACTION = 0.1
# ---------------------------------------------------------------------------

PART = "struct<type:string,text:string,path:string>"
MESSAGE = f"struct<role:string,content:array<{PART}>>"
MESSAGES = f"array<{MESSAGE}>"


def pair_dataset(images: DataFrame, texts: DataFrame, key: str = "stem",
                 path_col: str = "path", text_col: str = "text",
                 on_missing: str = "skip", strip: bool = True) -> DataFrame:
    """Image x transcript by key -> ``(key, image_path, gt_answer)``; ``strip`` trims the transcript
    (the conversations with a system turn do, those of two turns do not).

    ``on_missing='skip'``: inner join (see ``pair_missing`` for the report);
    ``'error'``: left join and fail the job on the first image without text.
    """
    t = texts.select(key, (py_strip(text_col) if strip else F.col(text_col)).alias("gt_answer"))
    if on_missing == "skip":
        joined = images.join(t, key, "inner")
        return joined.select(key, F.col(path_col).alias("image_path"), "gt_answer")
    if on_missing != "error":
        raise ValueError("on_missing must be 'skip' or 'error'")
    joined = images.join(t, key, "left")
    checked = F.when(F.col("gt_answer").isNull(),
                     F.raise_error(F.concat(F.lit("missing transcript for "), F.col(key).cast("string")))
                     ).otherwise(F.col("gt_answer"))
    return joined.select(key, F.col(path_col).alias("image_path"), checked.alias("gt_answer"))


def pair_missing(images: DataFrame, texts: DataFrame, key: str = "stem") -> DataFrame:
    """Images whose transcript is missing (the skip-with-warning listing)."""
    return images.join(texts.select(key), key, "left_anti")


def split_hash(key, seed: int = SPLIT_SEED) -> Column:
    """Stable 32-bit bucket hash of ``seed:key`` (md5 based, engine independent)."""
    k = F.col(key) if isinstance(key, str) else key
    return hash32(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def split_train_test(df: DataFrame, key: str, test_fraction: float = TEST_FRACTION,
                     seed: int = SPLIT_SEED, exact: bool = False) -> DataFrame:
    """Adds ``split`` = 'test' for about ``test_fraction`` of the keys, else 'train'.

    A row's side depends only on its key and the seed: stable under
    repartitioning, retries and lost executors (unlike ``randomSplit``), and no
    shuffle at all. With ``exact`` the ceil(fraction * rows) rows with the
    smallest hashes are the test side (unique keys); ranks come from hash
    parts and their offsets, not from a global sort.
    """
    if exact:
        keyed = df.withColumn("_h", split_hash(key, seed))
        total = keyed.agg(F.count(F.lit(1)).alias("_total")).withColumn("_one", F.lit(1))  # one row: broadcast
        ranked = hash_rank(keyed, "_h", [key], "_rank").withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")
        test = F.col("_rank") < F.ceil(F.col("_total") * F.lit(test_fraction).cast("decimal(10,6)"))
        return ranked.withColumn("split", F.when(test, F.lit("test")).otherwise(F.lit("train"))).select(*df.columns, "split")
    cut = int(round(test_fraction * 10000))
    side = F.when(F.pmod(split_hash(key, seed), F.lit(10000)) < cut, F.lit("test")).otherwise(F.lit("train"))
    return df.withColumn("split", side)


def _part(type_: str, text=None, path=None) -> Column:
    return F.struct(F.lit(type_).alias("type"),
                    (text if text is not None else F.lit(None).cast("string")).alias("text"),
                    (path if path is not None else F.lit(None).cast("string")).alias("path"))


def _message(role: str, parts: list[Column]) -> Column:
    return F.struct(F.lit(role).alias("role"), F.array(*parts).alias("content"))


def build_conversation(pairs: DataFrame, prompt: str = OCR_USER_PROMPT,
                       system: str | None = None) -> DataFrame:
    """``(image_path, gt_answer)`` -> ``messages`` (user: image + prompt; assistant: text).

    With ``system`` a system turn comes first. ``to_json`` leaves null fields
    out, which gives the mixed part shapes of the JSONL records.
    """
    msgs = []
    if system is not None:
        msgs.append(_message("system", [_part("text", text=F.lit(system))]))
    msgs.append(_message("user", [_part("image", path=F.col("image_path")), _part("text", text=F.lit(prompt))]))
    msgs.append(_message("assistant", [_part("text", text=F.col("gt_answer"))]))
    others = [c for c in pairs.columns if c not in ("image_path", "gt_answer")]
    return pairs.select(*others, F.array(*msgs).alias("messages"))


def messages_json(df: DataFrame, col: str = "messages") -> Column:
    """One JSON Lines record ``{"messages": [...]}``."""
    return F.to_json(F.struct(F.col(col).alias("messages")))
