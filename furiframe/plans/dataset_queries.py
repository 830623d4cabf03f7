"""Registered queries: hygiene, pairing, split, conversations, chat, arrays.

Stand-ins on the driver tables: every ``documents`` row has a page image
(``cropped/<doc_id>.png``, size = text bytes; undecodable when the label says
``toxic = 1``); transcripts exist for labelled documents, their size is the
bytes of all phrases of the text (0 when there is none).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from furiframe.functions import arrays as A
from furiframe.operators import chat, clean, dataset, messages, sequences
from furiframe.operators.segment import budget_text
from furiframe.plans import sqltext as S
from furiframe.plans.tables import table
from furiframe.session import cut_lineage

DELIM = "."


def images(spark, sf_dir):
    # Sizes before the joins, here and below: a join that shuffles then moves numbers, not texts.
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").cast("long").alias("size"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("stem"),
        F.concat(F.lit("cropped/"), F.col("doc_id").cast("string"), F.lit(".png")).alias("path"),
        "size",
        (~F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("valid"))


def transcripts(spark, sf_dir):
    t = budget_text("text", DELIM)
    texts = table(spark, sf_dir, "documents").select("doc_id", t.alias("text"), F.octet_length(t).cast("long").alias("size"))
    labelled = texts.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return labelled.withColumnRenamed("doc_id", "stem")


def q_clean_empty(spark, sf_dir):
    return clean.clean_empty(transcripts(spark, sf_dir)).select("stem", "size")


def q_clean_orphans(spark, sf_dir):
    kept = clean.clean_empty(transcripts(spark, sf_dir))
    return clean.clean_orphans(images(spark, sf_dir), kept).select("stem")


def q_clean_sync(spark, sf_dir):
    kept = clean.clean_empty(transcripts(spark, sf_dir))
    return clean.clean_sync(images(spark, sf_dir), kept).select("stem", "size")


def q_clean_texts(spark, sf_dir):
    kept = clean.clean_empty(transcripts(spark, sf_dir))
    return clean.surviving_texts(images(spark, sf_dir), kept).select("stem", "size")


def q_clean_rejects(spark, sf_dir):
    return clean.rejects(images(spark, sf_dir), transcripts(spark, sf_dir))


def q_clean_summary(spark, sf_dir):
    return clean.clean_summary(images(spark, sf_dir), transcripts(spark, sf_dir))


def _pairs_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("stem"), "text")
    texts = docs.join(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("stem")), "stem", "left_semi")
    imgs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("stem"),
        F.concat(F.lit("cropped/"), F.col("doc_id").cast("string"), F.lit(".png")).alias("path"))
    return imgs, texts


def q_pair_dataset(spark, sf_dir, strip=True):
    imgs, texts = _pairs_source(spark, sf_dir)
    return dataset.pair_dataset(imgs, texts, "stem", strip=strip)


def q_pair_missing(spark, sf_dir):
    imgs, texts = _pairs_source(spark, sf_dir)
    return dataset.pair_missing(imgs, texts, "stem").select("stem", "path")


def q_split_train_test(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return dataset.split_train_test(docs, "doc_id")


def q_split_counts(spark, sf_dir):
    return q_split_train_test(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def q_split_exact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return dataset.split_train_test(docs, "doc_id", exact=True)


def q_build_conversation(spark, sf_dir):
    pairs = q_pair_dataset(spark, sf_dir, strip=False)
    conv = dataset.build_conversation(pairs)
    return conv.select("stem", dataset.messages_json(conv).alias("record"))


def q_build_conversation_sys(spark, sf_dir):
    pairs = q_pair_dataset(spark, sf_dir)
    conv = dataset.build_conversation(pairs, system=dataset.OCR_SYSTEM_MESSAGE)
    return conv.select("stem", dataset.messages_json(conv).alias("record"))


def _damaged_records(spark, sf_dir):
    """A JSON Lines record for every document, damaged where the first hex digit of its id's hash is under 6."""
    docs = table(spark, sf_dir, "documents")
    pairs = docs.select("doc_id", F.concat(F.lit("cropped/"), F.col("doc_id").cast("string"), F.lit(".png")).alias("image_path"),
                        F.col("text").alias("gt_answer"))
    conv = dataset.build_conversation(pairs)
    record, digit = dataset.messages_json(conv), F.substr(F.md5(F.col("doc_id").cast("string")), F.lit(1), F.lit(1))
    broken = (F.when(digit == "0", F.substr("r", F.lit(1), F.floor(F.length("r") / 2).cast("int")))
              .when(digit == "1", F.lit(" "))
              .when(digit == "2", F.lit('{"image": 1}'))
              .when(digit == "3", F.lit('{"messages": []}'))
              .when(digit == "4", F.replace("r", F.lit('{"messages":['), F.lit('{"messages":7,"rest":[')))
              .when(digit == "5", F.replace("r", F.lit('"role":"assistant",'), F.lit("")))
              .otherwise(F.col("r")))
    return conv.select("doc_id", record.alias("r")).select("doc_id", broken.alias("value"))


def q_message_records(spark, sf_dir):
    parsed = messages.parse_messages(_damaged_records(spark, sf_dir))
    answer = F.element_at("messages", -1)["content"][0]["text"]
    return parsed.select("doc_id", "problem", F.when(F.col("problem").isNull(), F.size("messages")).cast("long").alias("n_turns"),
                         F.md5(answer).alias("answer_md5"))


def q_chat_render(spark, sf_dir):
    return chat.chat_render(table(spark, sf_dir, "conversations"))


def q_prompt_lines(spark, sf_dir):
    return chat.prompt_lines(table(spark, sf_dir, "conversations"))


def _word_ids(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", "role",
                       F.transform(F.split("text", " "), lambda w: F.length(w)).alias("ids"))


def q_pad_truncate(spark, sf_dir):
    ids = _word_ids(spark, sf_dir)
    return ids.select("conv_id", "turn",
                      A.pad_truncate("ids", 128, 0).alias("input_ids"),
                      A.attention_mask("ids", 128).alias("attention_mask"),
                      A.pad_truncate("ids", 128, 0).alias("labels"))


def q_label_mask(spark, sf_dir):
    ids = _word_ids(spark, sf_dir)
    padded = A.pad_truncate("ids", F.size("ids") + 2, 0)
    return ids.select("conv_id", "turn", A.mask_value(padded, 0).alias("labels"),
                      A.unmask(A.mask_value(padded, 0), 0).alias("restored"))


def q_batch_collate(spark, sf_dir):
    ids = sequences.assign_batches(_word_ids(spark, sf_dir), ["conv_id", "turn"], 16)
    out = sequences.collate_batches(ids, "batch_id", "ids", 0)
    return out.select("batch_id", "conv_id", "turn", "input_ids", "attention_mask", "labels")


def q_drop_prompt(spark, sf_dir):
    ids = _word_ids(spark, sf_dir)
    pairs = chat.next_turn_pairs(ids.withColumn("text", F.col("ids")).drop("ids"))
    out = F.concat(F.col("first_text"), F.col("second_text"))
    return pairs.select("conv_id", "turn", A.drop_prefix(out, F.col("first_text")).alias("generated"))


def q_argmax(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", A.argmax("embedding").alias("argmax"))


def _vocab(spark, sf_dir):
    bench = table(spark, sf_dir, "benchmark")
    pieces = bench.select(F.explode(F.split("text", " ")).alias("piece"))
    # Encoding and decoding join it: built once and frozen.
    return cut_lineage(sequences.build_vocab(pieces, "piece"))


def q_decode_ids(spark, sf_dir):
    bench = table(spark, sf_dir, "benchmark").select("item_id", F.split("text", " ").alias("pieces"))
    vocab = _vocab(spark, sf_dir)
    enc = sequences.encode_pieces(bench, ["item_id"], "pieces", vocab)
    return sequences.decode_ids(enc, ["item_id"], "input_ids", vocab)


QUERIES = {
    "clean_empty": q_clean_empty,
    "clean_orphans": q_clean_orphans,
    "clean_sync": q_clean_sync,
    "clean_texts": q_clean_texts,
    "clean_rejects": q_clean_rejects,
    "clean_summary": q_clean_summary,
    "pair_dataset": q_pair_dataset,
    "pair_missing": q_pair_missing,
    "split_train_test": q_split_train_test,
    "split_counts": q_split_counts,
    "split_exact": q_split_exact,
    "build_conversation": q_build_conversation,
    "build_conversation_sys": q_build_conversation_sys,
    "message_records": q_message_records,
    "chat_render": q_chat_render,
    "prompt_lines": q_prompt_lines,
    "pad_truncate": q_pad_truncate,
    "label_mask": q_label_mask,
    "batch_collate": q_batch_collate,
    "drop_prompt": q_drop_prompt,
    "argmax": q_argmax,
    "decode_ids": q_decode_ids,
}

# ----------------------------------------------------------------------------- oracles
_PIECES = f"""
  SELECT doc_id, idx, {S.strip('part')} AS s
  FROM (SELECT doc_id,
               unnest(string_split(coalesce(text, ''), '{DELIM}')) AS part,
               generate_subscripts(string_split(coalesce(text, ''), '{DELIM}'), 1) AS idx
        FROM documents)"""
_BUDGET = f"SELECT doc_id, idx, s FROM ({_PIECES}) WHERE length(s) >= 2"
_TEXTS = f"""
  SELECT l.doc_id AS stem, coalesce(b.t, '') AS text, CAST(strlen(coalesce(b.t, '')) AS BIGINT) AS size
  FROM labels l
  LEFT JOIN (SELECT doc_id, string_agg(s || '{DELIM}', ' ' ORDER BY idx) AS t FROM ({_BUDGET}) GROUP BY doc_id) b
    ON b.doc_id = l.doc_id"""
_IMAGES = """
  SELECT d.doc_id AS stem, 'cropped/' || CAST(d.doc_id AS VARCHAR) || '.png' AS path,
         CAST(strlen(d.text) AS BIGINT) AS size, NOT coalesce(l.toxic = 1, false) AS valid
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
_KEPT = f"SELECT * FROM ({_TEXTS}) WHERE size > 0"
_CORRUPT = f"""
  SELECT stem FROM ({_IMAGES}) i WHERE stem IN (SELECT stem FROM ({_KEPT})) AND (size = 0 OR NOT valid)"""


_PAIRS = f"""
  SELECT d.doc_id AS stem, 'cropped/' || CAST(d.doc_id AS VARCHAR) || '.png' AS image_path,
         {S.strip('d.text')} AS gt_answer
  FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels)"""


_PAIRS_WHOLE = """
  SELECT doc_id AS stem, 'cropped/' || CAST(doc_id AS VARCHAR) || '.png' AS image_path, text AS gt_answer
  FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"""


def _conv_sql(system: str | None, pairs: str) -> str:
    user = (f"json_object('role', 'user', 'content', json_array("
            f"json_object('type', 'image', 'path', image_path), "
            f"json_object('type', 'text', 'text', {S.sql_lit(dataset.OCR_USER_PROMPT)})))")
    asst = "json_object('role', 'assistant', 'content', json_array(json_object('type', 'text', 'text', gt_answer)))"
    msgs = [user, asst]
    if system is not None:
        msgs.insert(0, f"json_object('role', 'system', 'content', json_array("
                       f"json_object('type', 'text', 'text', {S.sql_lit(system)})))")
    return f"SELECT stem, CAST(json_object('messages', json_array({', '.join(msgs)})) AS VARCHAR) AS record FROM ({pairs})"


_WORD_IDS = """
  SELECT conv_id, turn, role, list_transform(string_split(text, ' '), lambda w: CAST(length(w) AS INTEGER)) AS ids
  FROM conversations"""


def _pad(ids: str, n: str, pad: str = "0") -> str:
    return f"list_slice(list_concat({ids}, list_resize([{pad}], CAST({n} AS BIGINT), {pad})), 1, CAST({n} AS BIGINT))"


def _mask(ids: str, n: str) -> str:
    return (f"list_slice(list_concat(list_resize([1], len({ids}), 1), list_resize([0], CAST({n} AS BIGINT), 0)), "
            f"1, CAST({n} AS BIGINT))")


_VOCAB = """
  WITH v AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS piece FROM benchmark),
  r AS (SELECT piece, row_number() OVER (ORDER BY ('0x' || substr(md5(piece), 1, 8))::BIGINT, piece) - 1 AS rk FROM v)
  SELECT piece, CAST(rk AS INTEGER) AS token_id, rk < 3 AS special FROM r"""

ORACLES = {
    "clean_empty": f"SELECT stem, size FROM ({_KEPT})",
    "clean_orphans": f"SELECT stem FROM ({_IMAGES}) WHERE stem NOT IN (SELECT stem FROM ({_KEPT}))",
    "clean_sync": f"""SELECT stem, size FROM ({_IMAGES})
                      WHERE stem IN (SELECT stem FROM ({_KEPT})) AND size > 0 AND valid""",
    "clean_texts": f"SELECT stem, size FROM ({_KEPT}) WHERE stem NOT IN ({_CORRUPT})",
    "clean_rejects": f"""
        SELECT stem, 'text' AS kind, 'empty' AS reason FROM ({_TEXTS}) WHERE size <= 0
        UNION ALL SELECT stem, 'image', 'orphan' FROM ({_IMAGES}) WHERE stem NOT IN (SELECT stem FROM ({_KEPT}))
        UNION ALL SELECT stem, 'image', 'corrupt' FROM ({_CORRUPT})
        UNION ALL SELECT stem, 'text', 'corrupt_image' FROM ({_KEPT}) WHERE stem IN ({_CORRUPT})""",
    "clean_summary": f"""
        SELECT (SELECT count(*) FROM ({_TEXTS})) AS texts_total,
               (SELECT count(*) FROM ({_IMAGES})) AS images_total,
               (SELECT count(*) FROM ({_TEXTS}) WHERE size <= 0) AS texts_empty,
               (SELECT count(*) FROM ({_IMAGES}) WHERE stem NOT IN (SELECT stem FROM ({_KEPT}))) AS images_orphaned,
               (SELECT count(*) FROM ({_CORRUPT})) AS images_corrupt,
               (SELECT count(*) FROM ({_KEPT}) WHERE stem IN ({_CORRUPT})) AS texts_dropped_with_image,
               (SELECT count(*) FROM ({_IMAGES}) WHERE stem IN (SELECT stem FROM ({_KEPT})) AND size > 0 AND valid)
                 AS images_kept,
               (SELECT count(*) FROM ({_KEPT}) WHERE stem NOT IN ({_CORRUPT})) AS texts_kept""",
    "pair_dataset": _PAIRS,
    "pair_missing": """
        SELECT doc_id AS stem, 'cropped/' || CAST(doc_id AS VARCHAR) || '.png' AS path
        FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "split_train_test": """
        SELECT doc_id, CASE WHEN (('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT) % 10000 < 1000
                            THEN 'test' ELSE 'train' END AS split
        FROM documents""",
    "split_exact": """
        SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY ('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT,
                                                    doc_id) <= ceil(count(*) OVER () * 0.1) THEN 'test' ELSE 'train' END AS split
        FROM documents""",
    "split_counts": """
        SELECT split, count(*) AS n FROM (
          SELECT CASE WHEN (('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT) % 10000 < 1000
                      THEN 'test' ELSE 'train' END AS split FROM documents) GROUP BY split""",
    "build_conversation": _conv_sql(None, _PAIRS_WHOLE),
    "build_conversation_sys": _conv_sql(dataset.OCR_SYSTEM_MESSAGE, _PAIRS),
    "message_records": """
        SELECT doc_id, problem, CASE WHEN problem IS NULL THEN 2::BIGINT END AS n_turns,
               CASE WHEN problem IS NULL THEN md5(text) END AS answer_md5
        FROM (SELECT doc_id, text, CASE substr(md5(CAST(doc_id AS VARCHAR)), 1, 1)
                WHEN '0' THEN 'damaged record' WHEN '1' THEN 'empty line' WHEN '2' THEN 'no messages'
                WHEN '3' THEN 'no turns' WHEN '4' THEN 'damaged record' WHEN '5' THEN 'turn without role or content'
              END AS problem FROM documents)""",
    "chat_render": """
        SELECT conv_id, count(*) AS n_turns,
               string_agg('<start_of_turn>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<end_of_turn>' || chr(10), '' ORDER BY turn)
                 AS rendered
        FROM conversations GROUP BY conv_id""",
    "prompt_lines": """
        SELECT u.conv_id, u.turn, 'User: ' || u.text || chr(10) || 'Assistant: ' || a.text AS line
        FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
        WHERE u.role = 'user' AND a.role = 'assistant'""",
    "pad_truncate": f"""
        SELECT conv_id, turn, {_pad('ids', '128')} AS input_ids, {_mask('ids', '128')} AS attention_mask,
               {_pad('ids', '128')} AS labels
        FROM ({_WORD_IDS})""",
    "label_mask": f"""
        SELECT conv_id, turn, list_transform(list_concat(ids, [0, 0]), lambda x: CASE WHEN x = 0 THEN -100 ELSE x END) AS labels,
               list_concat(ids, [0, 0]) AS restored
        FROM ({_WORD_IDS})""",
    "batch_collate": f"""
        SELECT batch_id, conv_id, turn, {_pad('ids', 'm')} AS input_ids, {_mask('ids', 'm')} AS attention_mask,
               list_transform({_pad('ids', 'm')}, lambda x: CASE WHEN x = 0 THEN -100 ELSE x END) AS labels
        FROM (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS m
              FROM (SELECT *, CAST((row_number() OVER (ORDER BY conv_id, turn) - 1) // 16 AS BIGINT) AS batch_id
                    FROM ({_WORD_IDS})))""",
    "drop_prompt": f"""
        SELECT u.conv_id, u.turn, list_slice(list_concat(u.ids, a.ids), len(u.ids) + 1, len(u.ids) + len(a.ids)) AS generated
        FROM ({_WORD_IDS}) u JOIN ({_WORD_IDS}) a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
        WHERE u.role = 'user' AND a.role = 'assistant'""",
    "argmax": "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax FROM embeddings",
    "decode_ids": f"""
        WITH vocab AS ({_VOCAB}),
        w AS (SELECT item_id, unnest(string_split(text, ' ')) AS piece,
                     generate_subscripts(string_split(text, ' '), 1) AS pos FROM benchmark),
        dec AS (SELECT item_id, string_agg(v.piece, ' ' ORDER BY pos) AS text, count(*) AS n
                FROM w JOIN vocab v USING (piece) WHERE NOT v.special GROUP BY item_id)
        SELECT b.item_id, coalesce(dec.text, '') AS text, CAST(coalesce(dec.n, 0) AS BIGINT) AS n_tokens
        FROM benchmark b LEFT JOIN dec USING (item_id)""",
}
