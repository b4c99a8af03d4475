"""SFT dataset preparation.

* Sampling is a distributed top-n on an ``md5(seed-id)`` key (``orderBy().limit()`` keeps at
  most n rows per partition before the final merge): reproducible, independent of
  partitioning, and never a global window over the whole table.
* Global ranks (the split, token ids) are counts of the groups before, plus the place in the
  group; groups are md5 prefixes, so no window sees more than a small share of the table.
* The vocabulary has every token of the corpus (``max_size`` can cut it where a model needs
  that).  Encoding looks tokens up in a broadcast copy if the vocabulary has at most
  ``BROADCAST_VOCAB`` entries, and by a join on the token otherwise; the result is the same.
"""

from __future__ import annotations

import os.path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import constants as K
from tessera.functions import text as X
from tessera.session import materialize

# Word-character runs or one other non-blank character (explicit classes, so the same
# pattern means the same thing to every regex engine).
TOKEN_PATTERN = r"[A-Za-z0-9_]+|[^ \t\n\r\f\x0BA-Za-z0-9_]"
PAD_ID, UNK_ID, EOS_ID = 0, 1, 2
SPECIAL = ["<pad>", "<unk>", "<eos>"]
BROADCAST_VOCAB = 1_000_000   # larger vocabularies are joined, not broadcast
TRAIN_SHARE = 0.75
ROWS_PER_BUCKET = 1024


def sample_key(id_col: str = "qa_id", seed: int = K.SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string")))


def sample_train(qa: DataFrame, n: int = K.TRAIN_SAMPLES, seed: int = K.SEED) -> DataFrame:
    """Seeded shuffle, first ``min(n, rows)``."""
    return qa.orderBy(sample_key(seed=seed), F.col("qa_id")).limit(n)


def sample_eval(qa: DataFrame, n: int = K.EVAL_SAMPLES) -> DataFrame:
    """Evaluation rows are not shuffled: first ``min(n, rows)`` by id."""
    return qa.orderBy("qa_id").limit(n)


def split_qa(qa: DataFrame, train_share: float = TRAIN_SHARE, seed: int = K.SEED) -> DataFrame:
    """Every row is in one split: in seeded order, the first ``floor(train_share * rows)``
    rows train and the rest evaluate.

    The order is that of an md5 key, so its first four digits deal the rows evenly into
    65,536 groups; a row's rank is the size of the groups before and its place in its own."""
    keyed = qa.select("*", sample_key(seed=seed).alias("_key")).withColumn("_group", F.substring("_key", 1, 4))
    sizes = keyed.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_group", (F.sum("_n").over(Window.orderBy("_group")) - F.col("_n")).alias("_before"))
    rows = sizes.select(F.sum("_n")).scalar()
    place = F.row_number().over(Window.partitionBy("_group").orderBy("_key", "qa_id"))
    ranked = keyed.withColumn("_place", place).join(before, "_group")
    in_train = F.col("_before") + F.col("_place") <= F.floor(rows * F.lit(train_share))
    return ranked.select(*qa.columns, F.when(in_train, "train").otherwise("eval").alias("split"))


def with_prompts(qa: DataFrame) -> DataFrame:
    """``train_prompt`` (question and answer) and ``inference_prompt`` (question only)."""
    return qa.select("*", X.format_prompt("question", "answer").alias("train_prompt"),
                     X.format_prompt("question").alias("inference_prompt"))


def tokens(text) -> Column:
    return F.regexp_extract_all(text if isinstance(text, Column) else F.col(text),
                                F.lit(TOKEN_PATTERN), 0)


def build_vocab(corpus: DataFrame, text_col: str = "train_prompt",
                max_size: int | None = None) -> DataFrame:
    """T4: ``(token, token_id, freq)``; pad, unk and eos first, then every token by frequency
    (ties by md5 of the token).  ``max_size`` keeps that many entries.

    An id is the number of tokens of higher frequency, plus those of equal frequency in
    earlier md5 groups, plus the place in the group: rare tokens, of which there may be
    very many of one frequency, never meet in one task.  Tokens are counted in each Arrow batch
    first, so a row for each distinct token of a batch is all that leaves it."""
    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(list(count_batch(batch.column(0))), names=["token", "freq"])

    counts = (corpus.select(text_col).mapInArrow(count, "token string, freq long")
              .groupBy("token").agg(F.sum("freq").alias("freq"))
              .select("*", F.md5("token").alias("_key"), F.substring(F.md5("token"), 1, 3).alias("_group")))
    groups = counts.groupBy("freq", "_group").agg(F.count(F.lit(1)).alias("_n"))
    levels = groups.groupBy("freq").agg(F.sum("_n").alias("_n"))
    higher = levels.select("freq", (F.sum("_n").over(Window.orderBy(F.col("freq").desc())) - F.col("_n")).alias("_higher"))
    earlier = groups.select("freq", "_group", (F.sum("_n").over(
        Window.partitionBy("freq").orderBy("_group")) - F.col("_n")).alias("_earlier"))
    place = F.row_number().over(Window.partitionBy("freq", "_group").orderBy("_key"))
    token_id = F.col("_higher") + F.col("_earlier") + F.col("_place") + (len(SPECIAL) - 1)
    ranked = (counts.withColumn("_place", place).join(earlier, ["freq", "_group"]).join(higher, "freq")
              .select("token", token_id.cast("int").alias("token_id"), "freq"))
    if max_size is not None:
        ranked = ranked.where(F.col("token_id") < max_size)
    special = corpus.sparkSession.createDataFrame(
        [(t, i, 0) for i, t in enumerate(SPECIAL)], "token string, token_id int, freq long")
    return special.unionByName(ranked)


# Kinds of bytes in UTF-8: blank, of a word, first of another character, further ones of it.
_BLANK, _WORD, _OTHER, _FURTHER = range(4)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[list(b" \t\n\r\f\x0b")] = _BLANK
_KINDS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")] = _WORD
_KINDS[0x80:0xC0] = _FURTHER


def _cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(where each text begins and the last one ends, where each token begins, all tokens) of
    texts without NULLs, in bytes: a word begins where no word was before, every other
    non-blank character is a token, and dropping the blanks leaves the tokens side by side."""
    wide = pa.types.is_large_string(texts.type)
    _, ends, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(len(texts) + 1, np.int64), np.empty(0, np.int64), pa.array([], pa.string())
    at = np.frombuffer(ends, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]]
    at = at.astype(np.int64) - at[0]
    kinds = _KINDS[data]
    word, kept = kinds == _WORD, kinds != _BLANK
    begins = word | (kinds == _OTHER)
    begins[1:] &= ~(word[1:] & word[:-1])
    first = at[:-1][at[:-1] < at[1:]]
    begins[first] = kept[first]
    ends = np.append(np.flatnonzero(begins[kept]), np.count_nonzero(kept)).astype(np.int32)
    flat = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(data[kept]))
    return at, np.flatnonzero(begins), flat


def cut_batch(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of tokens of each text, all tokens) of a batch, by vector functions.  The tokens
    are those of :func:`tokens`; a NULL has none."""
    at, begins, flat = _cut(pc.fill_null(texts, ""))
    return np.diff(np.searchsorted(begins, at)), flat


def _without_head(texts: pa.Array, most: int | None = None) -> tuple[pa.Array, pa.Array]:
    """(what all texts of a batch begin with, the texts without it); no token goes over the cut,
    which is after a blank and at most ``most`` bytes into the texts.  Prompts of one format
    begin alike, and what is common needs to be cut only once."""
    ends = pc.min_max(texts)
    low, high = (ends[k].as_buffer() for k in ("min", "max"))
    low, high = (b"" if v is None else v.to_pybytes() for v in (low, high))
    size = len(os.path.commonprefix([low, high])[:most])
    while size and _KINDS[low[size - 1]] != _BLANK:
        size -= 1
    head = pa.array([low[:size].decode("utf-8")], pa.string())
    if not size:
        return head, texts
    raw = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    longest = pc.max(pc.binary_length(texts)).as_py()
    return head, pc.binary_slice(texts.view(raw), size, longest).view(texts.type)


def count_batch(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(distinct tokens of a batch, how often each is in it); a token may come twice."""
    head, bodies = _without_head(texts.drop_null())
    of_head, of_bodies = (pc.value_counts(cut_batch(part)[1]) for part in (head, bodies))
    return (pa.concat_arrays([of_head.field("values"), of_bodies.field("values")]),
            pa.concat_arrays([pc.multiply(of_head.field("counts"), len(bodies)), of_bodies.field("counts")]))


ENCODED_TYPE = T.StructType([
    T.StructField("input_ids", T.ArrayType(T.IntegerType())),
    T.StructField("n_prompt", T.IntegerType()),
])


def encode_texts(train: pa.Array, prompt_bytes: pa.Array, prompt: pa.Array, lookup, max_len: int) -> pa.StructArray:
    """input_ids and n_prompt of a batch; ``lookup``: tokens -> ids.  The prompt is the first
    ``prompt_bytes`` bytes of the train prompt, which end with a blank, or, where that is NULL,
    ``prompt``."""
    train, begun = pc.fill_null(train, ""), prompt_bytes.is_valid().to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(prompt_bytes, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    head, bodies = _without_head(train, int(lengths[begun].min()) if begun.any() else None)
    size = len(head[0].as_buffer())
    head = cut_batch(head)[1]
    at, begins, flat = _cut(bodies)
    bounds = np.searchsorted(begins, at)
    in_prompt = np.searchsorted(begins, at[:-1] + np.maximum(lengths - size, 0)) - bounds[:-1] + len(head)
    n_prompt = np.where(begun, in_prompt, cut_batch(prompt)[0])

    counts = np.diff(bounds)
    ends = np.concatenate([[0], np.cumsum(counts + len(head))])
    ids = np.empty(ends[-1], np.int32)
    heads = ends[:-1, None] + np.arange(len(head))
    ids[heads] = lookup(head)
    ids[np.arange(len(flat)) + np.repeat((np.arange(len(train)) + 1) * len(head), counts)] = lookup(flat)
    if (counts + len(head) > max_len).any():
        place = np.arange(len(ids)) - np.repeat(ends[:-1], np.diff(ends))
        ids = ids[place < max_len]
        ends = np.concatenate([[0], np.cumsum(np.minimum(counts + len(head), max_len))])
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
         pa.array(np.minimum(n_prompt, max_len).astype(np.int32))], names=["input_ids", "n_prompt"])


def _encoder(vocab_bc, max_len: int):
    def encode_batch(train: pa.Array, prompt_bytes: pa.Array, prompt: pa.Array) -> pa.Array:
        names, ids = vocab_bc.value

        def lookup(flat):
            return pc.fill_null(pc.take(ids, pc.index_in(flat, value_set=names)), UNK_ID).to_numpy()

        return encode_texts(train, prompt_bytes, prompt, lookup, max_len)

    return F.arrow_udf(encode_batch, ENCODED_TYPE)


def _encoded(vocab_bc, max_len: int) -> Column:
    """input_ids and n_prompt.  Where the train prompt continues the inference prompt after a line
    break, the prompt is where the train prompt begins, and is not cut again."""
    train, head = F.col("train_prompt"), F.col("inference_prompt")
    continued = F.coalesce(train.startswith(head) & head.endswith("\n"), F.lit(False))
    return _encoder(vocab_bc, max_len)(train, F.when(continued, F.octet_length(head)), F.when(~continued, head))


def encode(examples: DataFrame, vocab: DataFrame, max_len: int = K.MAX_SEQ_LEN,
           id_col: str = "qa_id", keep: tuple = ()) -> DataFrame:
    """T4 + T5 + T6: ``input_ids`` (train prompt, truncated to ``max_len``), ``n_prompt``
    (inference prompt length, also truncated), ``labels`` (first ``n_prompt`` positions
    -100), ``attention_mask`` (ids != pad) and ``n_label_tokens``.

    Whole Arrow batches are cut and looked up by vector functions."""
    # never more than the limit comes to the driver, whatever vocabulary is passed in
    rows = vocab.select("token", "token_id").limit(BROADCAST_VOCAB + 1).collect()
    if len(rows) > BROADCAST_VOCAB:
        out = _encode_joined(examples, vocab, max_len, id_col, keep)
    else:
        known = examples.sparkSession.sparkContext.broadcast(
            (pa.array([r.token for r in rows], pa.string()), pa.array([r.token_id for r in rows], pa.int32())))
        out = examples.select(id_col, *keep, _encoded(known, max_len).alias("_e")).select(
            id_col, *keep, F.col("_e.input_ids").alias("input_ids"), F.col("_e.n_prompt").alias("n_prompt"))
    labels = F.transform("input_ids", lambda x, i: F.when(i < F.col("n_prompt"),
                                                            F.lit(K.LABEL_IGNORE_ID)).otherwise(x))
    mask = F.transform("input_ids", lambda x: F.when(x == PAD_ID, 0).otherwise(1))
    out = out.select(id_col, *keep, "input_ids", "n_prompt", labels.alias("labels"),
                     mask.alias("attention_mask"))
    return out.select("*", F.size("input_ids").alias("n_tokens"),
                      F.greatest(F.size("input_ids") - F.col("n_prompt"), F.lit(0))
                      .alias("n_label_tokens"))


def _encode_joined(examples: DataFrame, vocab: DataFrame, max_len: int, id_col: str, keep: tuple) -> DataFrame:
    """Encoding without a copy of the vocabulary in each task: a row's distinct tokens are
    joined with it (a frequent token is a skewed join that Spark splits) and come back as
    one map of at most ``max_len`` tokens."""
    rows = materialize(examples.select(
        F.monotonically_increasing_id().alias("_row"), id_col, *keep,
        F.slice(tokens("train_prompt"), 1, max_len).alias("_tokens"),
        F.when(F.col("inference_prompt").isNull(), 0)
        .otherwise(F.least(F.size(tokens("inference_prompt")), F.lit(max_len))).alias("n_prompt")))
    found = (rows.select("_row", F.explode(F.array_distinct("_tokens")).alias("token")).join(vocab, "token")
             .groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("token", "token_id"))).alias("_ids")))
    ids = F.transform("_tokens", lambda t: F.coalesce(F.try_element_at("_ids", t), F.lit(UNK_ID)))
    return (rows.join(found, "_row", "left")
            .select(id_col, *keep, F.coalesce(ids, F.array().cast("array<int>")).alias("input_ids"),
                    "n_prompt"))


def bucket_of(id_col: str, n_buckets) -> Column:
    return (F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10)
            .cast("bigint") % n_buckets)


def left_pad_batches(encoded: DataFrame, batch_size: int = K.BATCH_SIZE,
                     rows_per_bucket: int = ROWS_PER_BUCKET, id_col: str = "qa_id") -> DataFrame:
    """Batches of ``batch_size`` inside md5 buckets (rows numbered per bucket, never
    over the whole table); each sequence is left-padded with pad ids to its batch's
    longest length, the attention mask with zeros.  The number of buckets is the number of
    rows over ``rows_per_bucket``, rounded up, so a batch depends on the rows and the
    parameters only, on any cluster."""
    rows = encoded.select(F.count(F.lit(1))).scalar()
    n_buckets = F.greatest(F.ceil(rows / rows_per_bucket), F.lit(1))
    encoded = encoded.select("*", bucket_of(id_col, n_buckets).alias("bucket"))
    rn = F.row_number().over(Window.partitionBy("bucket").orderBy(id_col))
    b = encoded.withColumn("batch_no", F.floor((rn - 1) / batch_size).cast("int"))
    longest = F.max("n_tokens").over(Window.partitionBy("bucket", "batch_no"))
    b = b.withColumn("padded_len", longest)
    n_pad = F.col("padded_len") - F.col("n_tokens")
    return b.select(
        id_col, "bucket", "batch_no", "padded_len", n_pad.alias("n_pad"),
        F.concat(F.array_repeat(F.lit(PAD_ID), n_pad), "input_ids").alias("input_ids"),
        F.concat(F.array_repeat(F.lit(0), n_pad), "attention_mask").alias("attention_mask"),
        F.concat(F.array_repeat(F.lit(K.LABEL_IGNORE_ID), n_pad), "labels").alias("labels"))


def token_stats(examples: DataFrame, encoded: DataFrame | None = None) -> DataFrame:
    """Estimated tokens ``floor(len(prompt) * 1.3)`` over all samples (plus real
    counts when the encoded table is given)."""
    est = examples.agg(F.count(F.lit(1)).alias("n_samples"),
                       F.avg(F.floor(F.length("train_prompt") * F.lit(K.TOKENS_PER_CHAR)))
                       .alias("est_tokens_avg"))
    if encoded is None:
        return est
    real = encoded.agg(F.avg("n_tokens").alias("real_tokens_avg"),
                       F.max("n_tokens").alias("max_tokens"))
    return est.select("*", real.select("real_tokens_avg").scalar().alias("real_tokens_avg"),
                      real.select("max_tokens").scalar().alias("max_tokens"))


def step_plan(train: DataFrame, batch_size: int = K.BATCH_SIZE,
              grad_accum: int = K.GRAD_ACCUM_STEPS, epochs: int = K.NUM_EPOCHS) -> DataFrame:
    """Steps per epoch and total optimiser steps, in both formulas (trainer: ceil;
    simulation: floor division)."""
    n = F.count(F.lit(1))
    spe = F.ceil(n / batch_size)
    return train.agg(
        n.alias("n_samples"), spe.cast("long").alias("steps_per_epoch"),
        F.ceil(spe * epochs / grad_accum).cast("long").alias("total_steps_trainer"),
        F.floor(spe * epochs / grad_accum).cast("long").alias("total_steps_simulation"))


def encode_batches(qa: DataFrame, vocab: DataFrame, max_len: int = K.MAX_SEQ_LEN,
                   batch_size: int = K.BATCH_SIZE, rows_per_bucket: int = ROWS_PER_BUCKET,
                   id_col: str = "qa_id") -> DataFrame:
    """T4-T7 in one plan: prompts, encoding and masks (narrow maps), then left-padded
    batches (one shuffle by bucket)."""
    encoded = encode(with_prompts(qa), vocab, max_len, id_col)
    return left_pad_batches(encoded, batch_size, rows_per_bucket, id_col)
