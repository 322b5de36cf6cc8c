"""One query per operator over the given tables. Arrays are shown as text, doubles to six places."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.config import CleaningConfig, JobConfig, LoaderConfig, TokenizerConfig
from tokenloom.functions import text as tx
from tokenloom.functions.sql import register_tokenizer
from tokenloom.functions import tokens as tk
from tokenloom.operators import batching as bt
from tokenloom.operators import candidates as cd
from tokenloom.operators import cleaning as cl
from tokenloom.operators import encoding as en
from tokenloom.operators import inference as inf
from tokenloom.operators import merges as mg
from tokenloom.operators import packing as pk
from tokenloom.operators import scoring as sc
from tokenloom.operators import words as wd
from tokenloom.operators.vocabulary import Tokenizer, id_to_token, token_to_id
from tokenloom.plans.corpus import prepare_corpus
from tokenloom.sources import lines as ln
from tokenloom.sources.artifact import load_tokenizer, reuse_tokenizer, save_tokenizer
from tokenloom.sources.tables import read_documents
from tokenloom.staging import new_path, stage
from tokenloom.streaming import streams as sm

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CLEANING = CleaningConfig(min_length=20)
# One vocabulary of some 210 merges for all queries, whose SQL repeats every merge as a step; a larger one for the whole job.
TOKENIZER = TokenizerConfig(vocab_size=256)
JOB_TOKENIZER = TokenizerConfig(vocab_size=512)
SHARDS = 2
BLOCK = 128
LINE = 64
# No cleaned line has as many ids.
WHOLE_LINE = CLEANING.max_length + 2
LOADER = LoaderConfig(batch_size=8, max_length=BLOCK, num_workers=SHARDS, shuffle_buffer_size=50, seed=7)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


KEYS = {"documents": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id", "turn"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_documents(spark, f"{sf_dir}/{name}.parquet", *KEYS[name])


def shown(ids: str | Column, sep: str = " ") -> Column:
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.array_join(ids.cast("array<string>"), sep)


def rounded(name: str) -> Column:
    return F.round(F.col(name), 6).alias(name)


def shown_place(key: Column) -> list[Column]:
    """A place in the given documents, whose line numbers are ints."""
    doc_id, line_no, pos = wd.order_parts(key)
    return [doc_id, line_no.cast("int").alias("line_no"), pos]


def source_split() -> Column:
    """The given tables name no splits: every tenth document validates, the one after it tests."""
    last = F.pmod("doc_id", F.lit(10))
    return F.when(last == 0, "validation").when(last == 1, "test").otherwise("train")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ln.doc_lines(table(spark, sf_dir, "documents"))


def split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).withColumn("split", source_split())


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ln.doc_lines(table(spark, sf_dir, "pages"), "page_id", "html").withColumnRenamed("doc_id", "page_id")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.clean_lines(lines(spark, sf_dir), CLEANING)


def cleaned_text(rows: DataFrame) -> DataFrame:
    """Cleaning as a preparation of packing: raw lines are sorted first, then cleaned and encoded."""
    return cl.clean_lines(rows, CLEANING, out="text")


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned lines of this folder's documents, written once per session: training, packing and scoring all read them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _cleaned:
        _cleaned[key] = stage(clean(spark, sf_dir), "cleaned", compression="zstd")
    return _cleaned[key]


def kept_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of this folder's documents to train on, counted once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _counted:
        _counted[key] = stage(wd.word_filter(wd.word_counts(cleaned(spark, sf_dir), "clean"), TOKENIZER), "kept-words")
    return _counted[key]


_cleaned: dict[tuple[str, str], DataFrame] = {}
_counted: dict[tuple[str, str], DataFrame] = {}
_fitted: dict[tuple[str, str], Tokenizer] = {}


def fitted(spark: SparkSession, sf_dir: str) -> Tokenizer:
    """The tokenizer of this folder's documents, trained once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _fitted:
        _fitted[key] = mg.train_from_words(kept_words(spark, sf_dir), TOKENIZER)
    return _fitted[key]


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return en.encode_documents(cleaned(spark, sf_dir), fitted(spark, sf_dir), "clean", ascii_only=True)


def encoded_with(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return en.encode_texts(cleaned(spark, sf_dir), fitted(spark, sf_dir), "clean", ascii_only=True, **options)


# Sources, sinks, data set assembly


@query
def doc_lines(spark, sf_dir):
    return lines(spark, sf_dir)


@query
def nonblank_lines(spark, sf_dir):
    return ln.nonblank_lines(lines(spark, sf_dir))


@query
def drop_heading_lines(spark, sf_dir):
    return ln.drop_heading_lines(lines(spark, sf_dir))


@query
def dataset_splits(spark, sf_dir):
    return ln.dataset_splits(split_lines(spark, sf_dir))


@query
def split_stats(spark, sf_dir):
    written = ln.write_dataset(split_lines(spark, sf_dir), new_path(spark, "dataset"))
    return ln.split_stats(written, "data/raw", "documents", "raw", "given tables", "document lines by split")


@query
def write_text_lines(spark, sf_dir):
    path = new_path(spark, "text")
    ln.write_text_lines(clean(spark, sf_dir), path, "clean")
    return spark.read.text(path).groupBy(F.col("value").alias("text")).agg(F.count("*").alias("n"))


@query
def preview_sample(spark, sf_dir):
    return ln.preview_sample(split_lines(spark, sf_dir), ["train", "validation", "test"])


@query
def tokenizer_artifact(spark, sf_dir):
    path = new_path(spark, "tokenizer")
    save_tokenizer(spark, fitted(spark, sf_dir), path)
    return load_tokenizer(spark, path).merge_table(spark)


@query
def reuse_tokenizer_(spark, sf_dir):
    path = new_path(spark, "tokenizer")
    reuse_tokenizer(spark, path, lambda: fitted(spark, sf_dir))
    return reuse_tokenizer(spark, path).vocab_table(spark)


# Cleaning


@query
def html_unescape(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.html_unescape(F.col("html")).alias("text"))


@query
def strip_text(spark, sf_dir):
    framed = F.concat(F.lit(" \t\u00a0\u2003\n"), "text", F.lit("\u3000\u0085 \x1c\n "))
    return table(spark, sf_dir, "documents").select("doc_id", tx.strip_text(framed).alias("text"))


@query
def strip_tags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.strip_tags(F.col("html")).alias("text"))


@query
def mask_special_chars(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.mask_special_chars(F.col("text")).alias("text"))


@query
def collapse_ws(spark, sf_dir):
    spread = F.replace("text", F.lit(","), F.lit("   ,"))
    return table(spark, sf_dir, "documents").select("doc_id", tx.collapse_ws(spread).alias("text"))


@query
def lowercase_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.lowercase_text(F.col("text")).alias("text"))


@query
def length_filter(spark, sf_dir):
    kept = lines(spark, sf_dir).filter(tx.in_length(F.col("text"), CLEANING))
    return kept.select("doc_id", "line_no", F.char_length("text").alias("n_chars"))


@query
def null_guard(spark, sf_dir):
    """Every document with its text, and once more without one, which is rejected."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    none = docs.select((-1 - F.col("doc_id")).alias("doc_id"), F.lit(None).cast("string").alias("text"))
    out = cl.with_clean_text(docs.unionByName(none), CLEANING)
    return out.filter(F.col("clean").isNotNull()).select("doc_id", "clean")


@query
def clean_documents(spark, sf_dir):
    return clean(spark, sf_dir)


@query
def clean_pages(spark, sf_dir):
    return cl.clean_lines(page_lines(spark, sf_dir))


@query
def clean_toggles(spark, sf_dir):
    rows = page_lines(spark, sf_dir)
    out = None
    for name in ("remove_html", "remove_special_chars", "lowercase"):
        one = cl.clean_lines(rows, CleaningConfig(**{name: False})).withColumn("switched_off", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query
def clean_texts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cl.clean_lines(docs, CLEANING)


@query
def cleaning_report(spark, sf_dir):
    return cl.cleaning_report(split_lines(spark, sf_dir), CLEANING)


# Tokenizer training


@query
def nfkc_normalize(spark, sf_dir):
    """Letters, digits and spaces become compatibility forms first; normalizing must undo that."""
    plain = "abcdefghijklmnopqrstuvwxyz0123456789"
    wide = "".join(chr(ord(c) + 0xFEE0) for c in plain)
    widened = F.translate("text", plain + " ", wide + "\u00a0")
    return table(spark, sf_dir, "documents").select("doc_id", tx.unicode_normalize(widened).alias("text"))


@query
def pretokenize(spark, sf_dir):
    return wd.pretokenize(clean(spark, sf_dir), "clean")


@query
def word_counts(spark, sf_dir):
    return wd.word_counts(clean(spark, sf_dir), "clean").select("word", "freq", *shown_place(F.col("first")))


@query
def word_filter(spark, sf_dir):
    return kept_words(spark, sf_dir).select("word", "freq")


@query
def alphabet(spark, sf_dir):
    return wd.alphabet(kept_words(spark, sf_dir))


def _placed(pairs: DataFrame) -> DataFrame:
    return pairs.select("left", "right", "freq", *shown_place(F.col("first")), "i")


@query
def pair_counts(spark, sf_dir):
    return _placed(mg.pair_counts(mg.word_symbols(kept_words(spark, sf_dir))))


@query
def best_pair(spark, sf_dir):
    return _placed(mg.best_pair(mg.pair_counts(mg.word_symbols(kept_words(spark, sf_dir)))))


@query
def apply_merge(spark, sf_dir):
    words = mg.word_symbols(kept_words(spark, sf_dir))
    first = fitted(spark, sf_dir).merges[0]
    merged = mg.apply_merge(words, [(first.left, first.right)])
    return merged.select("word", shown(mg.symbol_list(F.col("symbols")), "|").alias("symbols"))


@query
def bpe_merges(spark, sf_dir):
    return fitted(spark, sf_dir).merge_table(spark)


@query
def vocab_table(spark, sf_dir):
    return fitted(spark, sf_dir).vocab_table(spark)


# Encoding and decoding


def _word_tokens(spark, sf_dir) -> DataFrame:
    words = wd.word_counts(clean(spark, sf_dir), "clean").select("word")
    return en.encode_words(words, fitted(spark, sf_dir))


@query
def encode_words(spark, sf_dir):
    return _word_tokens(spark, sf_dir).select("word", shown("tokens", "|").alias("tokens"))


@query
def encode_documents(spark, sf_dir):
    return encoded(spark, sf_dir).select("doc_id", "line_no", shown("input_ids").alias("input_ids"))


@query
def token_to_id_(spark, sf_dir):
    tokens = _word_tokens(spark, sf_dir).select(F.explode("tokens").alias("token")).distinct()
    return token_to_id(tokens, fitted(spark, sf_dir))


@query
def id_to_token_(spark, sf_dir):
    ids = encoded(spark, sf_dir).select(F.explode("input_ids").alias("id")).distinct()
    return id_to_token(ids, fitted(spark, sf_dir))


def _shown_rows(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select("doc_id", "line_no", *[shown(c).alias(c) for c in columns])


@query
def add_special_tokens(spark, sf_dir):
    return _shown_rows(encoded_with(spark, sf_dir, max_length=LINE), "input_ids")


@query
def truncate_ids(spark, sf_dir):
    return _shown_rows(encoded_with(spark, sf_dir, max_length=LINE, truncation=True), "input_ids")


@query
def pad_ids(spark, sf_dir):
    return _shown_rows(encoded_with(spark, sf_dir, max_length=LINE, truncation=True, padding=True), "input_ids")


@query
def attention_mask(spark, sf_dir):
    rows = encoded_with(
        spark, sf_dir, max_length=LINE, truncation=True, padding=True, return_attention_mask=True
    )
    return _shown_rows(rows, "attention_mask")


@query
def decode_ids(spark, sf_dir):
    return en.decode_ids(encoded_with(spark, sf_dir), fitted(spark, sf_dir)).select("doc_id", "line_no", "text")


@query
def roundtrip_check(spark, sf_dir):
    return en.roundtrip_check(clean(spark, sf_dir), fitted(spark, sf_dir), "clean")


# Packing, shuffling, batching


@query
def shard_lines(spark, sf_dir):
    return pk.shard_lines(lines(spark, sf_dir), 4).select("doc_id", "line_no", "shard")


def _samples(spark, sf_dir) -> DataFrame:
    return pk.unpacked_samples(clean(spark, sf_dir), fitted(spark, sf_dir), LINE, "clean", ascii_only=True)


@query
def unpacked_samples(spark, sf_dir):
    return _shown_rows(_samples(spark, sf_dir), "input_ids")


@query
def append_eos(spark, sf_dir):
    eos = fitted(spark, sf_dir).eos_id
    return _shown_rows(encoded(spark, sf_dir).withColumn("input_ids", pk.append_eos(F.col("input_ids"), eos)), "input_ids")


def _blocks(spark, sf_dir, drop_last: bool = False) -> DataFrame:
    return pk.pack_blocks(
        lines(spark, sf_dir), fitted(spark, sf_dir), BLOCK, SHARDS, drop_last, ascii_only=True, prepare=cleaned_text
    )


def _shown_blocks(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("input_ids", shown("input_ids"))


@query
def pack_blocks(spark, sf_dir):
    rows = ln.doc_lines(table(spark, sf_dir, "documents"), keep=("lang",))
    tok = fitted(spark, sf_dir)
    return _shown_blocks(
        pk.pack_blocks(rows, tok, BLOCK, SHARDS, by=("lang",), ascii_only=True, prepare=cleaned_text)
    )


@query
def pack_drop_last(spark, sf_dir):
    return _shown_blocks(_blocks(spark, sf_dir, drop_last=True))


@query
def pack_keep_last(spark, sf_dir):
    return _shown_blocks(_blocks(spark, sf_dir))


def _train_val(spark, sf_dir) -> DataFrame:
    held = source_split() == "validation"
    train, val = lines(spark, sf_dir).filter(~held), lines(spark, sf_dir).filter(held)
    return bt.train_val_blocks(train, val, fitted(spark, sf_dir), LOADER, ascii_only=True, prepare=cleaned_text)


@query
def train_val_blocks(spark, sf_dir):
    return _shown_blocks(_train_val(spark, sf_dir))


@query
def shuffle_blocks(spark, sf_dir):
    return bt.shuffle_blocks(_blocks(spark, sf_dir), 50, seed=7).select("shard", "block", "position")


@query
def batch_blocks(spark, sf_dir):
    return bt.batch_blocks(_blocks(spark, sf_dir), 8, "block").select("shard", "block", "batch_id", "row_in_batch")


def _line_batches(spark, sf_dir) -> DataFrame:
    """Batches of single lines: unlike packed blocks their samples differ in length."""
    cfg = LoaderConfig(batch_size=8, max_length=WHOLE_LINE, num_workers=SHARDS, pack_sequences=False, shuffle_buffer_size=0)
    tok = fitted(spark, sf_dir)
    samples = bt.split_samples(lines(spark, sf_dir), tok, cfg, ascii_only=True, prepare=cleaned_text)
    return bt.loader_batches(bt.val_samples(samples), cfg, tok.pad_id, ["shard"])


@query
def collate_pad(spark, sf_dir):
    return _line_batches(spark, sf_dir).select("shard", "batch_id", "row_in_batch", shown("input_ids").alias("input_ids"))


@query
def collate_labels(spark, sf_dir):
    return _line_batches(spark, sf_dir).select(
        "shard", "batch_id", "row_in_batch", shown("attention_mask").alias("attention_mask"), shown("labels").alias("labels")
    )


@query
def next_token_pairs(spark, sf_dir):
    pairs = sc.next_token_pairs(_blocks(spark, sf_dir), ["shard", "block"])
    return pairs.groupBy("prev_id", "next_id").agg(
        F.count("*").alias("n"), F.sum(F.col("block") * BLOCK + F.col("pos")).alias("place_sum")
    )


@query
def pack_efficiency(spark, sf_dir):
    packed = _blocks(spark, sf_dir).withColumn("batch_id", F.floor(F.col("block") / 8))
    width = packed.groupBy("shard", "batch_id").agg(F.sum("n").alias("tokens"), (F.max("n") * F.count("*")).alias("slots"))
    lines_ = _line_batches(spark, sf_dir)
    real = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x)
    unpacked = lines_.select(real.alias("tokens"), F.size("input_ids").alias("slots"))

    def share(df, name):
        return df.agg(F.sum("tokens").alias("tokens"), F.sum("slots").alias("slots")).select(
            F.lit(name).alias("mode"), "tokens", "slots", F.round(1 - F.col("tokens") / F.col("slots"), 6).alias("padding_share")
        )

    return share(width, "packed").unionByName(share(unpacked, "unpacked"))


# Scoring


def _samples_of_splits(spark, sf_dir) -> DataFrame:
    """The packed blocks of both splits, written once."""
    held = source_split() == "validation"
    rows = cleaned(spark, sf_dir).withColumn("split", F.when(held, "val").otherwise("train"))
    tok = fitted(spark, sf_dir)
    return bt.split_samples(rows, tok, LOADER, text_col="clean", by=["split"], ascii_only=True, prepare=lambda texts: texts)


def _scores(samples: DataFrame, size: int) -> DataFrame:
    """The score table learned on the train split, written once. Counts need no order, so the blocks are not shuffled for it."""
    train = bt.whole_samples(samples.filter("split = 'train'"), LOADER)
    return stage(sc.bigram_table(sc.next_token_pairs(train, []), size), "bigrams")


BATCH = ["split", "shard", "batch_id"]


def _scorer(spark, sf_dir) -> tuple[DataFrame, DataFrame, int, DataFrame]:
    """The pairs to score, the score table learned on the train split, the vocabulary size, the batch of every block."""
    samples, size = _samples_of_splits(spark, sf_dir), len(fitted(spark, sf_dir))
    batches = bt.batch_blocks(bt.placed_samples(samples.drop("input_ids"), LOADER), LOADER.batch_size)
    pairs = sc.next_token_pairs(samples, ["split", "shard", "block"])
    return pairs, _scores(samples, size), size, batches.select("split", "shard", "block", "batch_id")


@query
def bigram_table(spark, sf_dir):
    scores = _scores(_samples_of_splits(spark, sf_dir), len(fitted(spark, sf_dir)))
    return scores.select("prev_id", "next_id", "n", rounded("log_prob"))


def _losses(spark, sf_dir) -> DataFrame:
    pairs, scores, size, batches = _scorer(spark, sf_dir)
    return sc.masked_nll(pairs, scores, size, BATCH, batches)


@query
def masked_nll(spark, sf_dir):
    return _losses(spark, sf_dir).select("split", "shard", "batch_id", "n", rounded("nll"))


@query
def perplexity(spark, sf_dir):
    size = len(fitted(spark, sf_dir))
    scores = _scores(_samples_of_splits(spark, sf_dir), size)
    pairs = sc.next_token_pairs(encoded_with(spark, sf_dir), ["doc_id"])
    losses = sc.perplexity(sc.masked_nll(pairs, scores, size, ["doc_id"]))
    return losses.select("doc_id", "n", rounded("nll"), rounded("perplexity"))


@query
def perplexity_levels(spark, sf_dir):
    """Loss and perplexity per batch, per split, and of all."""
    pairs, scores, size, batches = _scorer(spark, sf_dir)
    rows = sc.loss_levels(pairs, scores, size, BATCH, placed=batches)
    return rows.select("level", "split", "shard", "batch_id", "n", rounded("nll"), rounded("perplexity"))


@query
def train_val_loss(spark, sf_dir):
    per_split = sc.perplexity(sc.total_loss(_losses(spark, sf_dir), ["split"]))
    return per_split.select("split", "n", rounded("nll"), rounded("perplexity"))


@query
def finite_loss_check(spark, sf_dir):
    return sc.finite_loss_check(_losses(spark, sf_dir))


# Scored candidates


def _logits(spark, sf_dir) -> DataFrame:
    scores = _scores(_samples_of_splits(spark, sf_dir), len(fitted(spark, sf_dir)))
    return scores.select(
        F.col("prev_id").alias("group_id"), F.col("next_id").alias("token_id"), F.log("n").alias("logit")
    )


@query
def softmax_temperature(spark, sf_dir):
    return cd.softmax_temperature(_logits(spark, sf_dir), 0.8).select("group_id", "token_id", rounded("prob"))


@query
def topk_candidates(spark, sf_dir):
    return cd.topk_candidates(_logits(spark, sf_dir), 5).select("group_id", "token_id", rounded("logit"))


@query
def nucleus_candidates(spark, sf_dir):
    return cd.nucleus_candidates(_logits(spark, sf_dir), 0.9).select("group_id", "token_id", rounded("logit"))


@query
def greedy_candidate(spark, sf_dir):
    return cd.greedy_candidate(_logits(spark, sf_dir)).select("group_id", "token_id", rounded("logit"))


@query
def sample_candidates(spark, sf_dir):
    return cd.sample_candidates(_logits(spark, sf_dir), seed=7).select("group_id", "token_id", rounded("logit"))


@query
def fan_out_sequences(spark, sf_dir):
    copies = cd.fan_out_sequences(_logits(spark, sf_dir), 3)
    drawn = cd.sample_candidates(copies, seed=7, by=["group_id", "copy"])
    return drawn.select("group_id", "copy", "token_id", rounded("logit"))


@query
def repeated_ngrams(spark, sf_dir):
    out = cd.repeated_ngrams(encoded(spark, sf_dir), ["doc_id", "line_no"])
    return out.select("doc_id", "line_no", shown("ngram").alias("ngram"), "n")


@query
def token_repetition(spark, sf_dir):
    return cd.token_repetition(encoded(spark, sf_dir), ["doc_id", "line_no"])


@query
def repetition_share(spark, sf_dir):
    out = cd.repetition_share(encoded(spark, sf_dir), ["doc_id", "line_no"])
    return out.select("doc_id", "line_no", "tokens", "distinct_tokens", rounded("repeated_share"))


# Batch inference and streaming


def _prompts(spark, sf_dir) -> DataFrame:
    asked = table(spark, sf_dir, "conversations").filter("role = 'user'").select("conv_id", "turn", "text")
    return inf.prepare_prompts(asked, fitted(spark, sf_dir))


@query
def prepare_prompts(spark, sf_dir):
    return _prompts(spark, sf_dir).select(
        "conv_id", "turn", shown("input_ids").alias("input_ids"), shown("attention_mask").alias("attention_mask")
    )


@query
def strip_prompt(spark, sf_dir):
    """The turn that answers a prompt stands for the generated text behind it; without one the text is empty."""
    tok = fitted(spark, sf_dir)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lower("text").alias("text"))
    answers = en.encode_documents(turns, tok).select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("input_ids").alias("answer")
    )
    none = F.array().cast("array<int>")
    outputs = _prompts(spark, sf_dir).join(answers, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        F.concat("input_ids", F.coalesce("answer", none), F.array(F.lit(tok.eos_id))).alias("output_ids"),
        F.size("input_ids").alias("prompt_length"),
    )
    return inf.strip_prompt(outputs, tok).select("conv_id", "turn", "text")


def _make_predictor(size: int):
    """A predictor a caller might bring: scores from the last real token and the prompt's length."""

    def make():
        def predict(ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
            n = mask.sum(axis=1)
            last = ids[np.arange(len(ids)), n - 1]
            return ((31 * last + 7 * n)[:, None] + 17 * np.arange(size)[None, :]) % 101 / 10.0

        return predict

    return make


def _predicted(spark, sf_dir) -> DataFrame:
    tok = fitted(spark, sf_dir)
    # The prompts' closing EOS is not something to continue from.
    prompts = _prompts(spark, sf_dir).withColumn("input_ids", F.slice("input_ids", 1, F.size("input_ids") - 1))
    return inf.batch_predict(prompts, _make_predictor(len(tok)), ("conv_id", "turn"), tok.pad_id)


@query
def batch_predict(spark, sf_dir):
    """The scores of each prompt in tenths, which they are whole numbers of."""
    tenths = F.transform("logits", lambda x: F.round(x * 10).cast("int"))
    return _predicted(spark, sf_dir).select("conv_id", "turn", shown(tenths).alias("logits"))


DRAW = inf.DrawConfig(repetition_penalty=1.2, no_repeat_ngram=3, temperature=0.8, top_k=20, top_p=0.9, seed=7)


@query
def next_token_draw(spark, sf_dir):
    """One next token for every user turn, through all steps on its stored scores."""
    out = inf.next_token_draw(_predicted(spark, sf_dir), ("conv_id", "turn"), DRAW)
    return out.select("conv_id", "turn", "token_id", rounded("logit"))


@query
def sql_encode(spark, sf_dir):
    """All cleaned lines encoded and decoded again in SQL."""
    register_tokenizer(spark, fitted(spark, sf_dir), "bpe")
    clean(spark, sf_dir).createOrReplaceTempView("clean_lines_of_query")
    return spark.sql(
        """SELECT doc_id, line_no, array_join(cast(bpe_encode(clean) AS array<string>), ' ') AS input_ids,
                  bpe_decode(bpe_encode_line(clean)) = clean AS unchanged FROM clean_lines_of_query"""
    )


def _streamed_lines(spark, sf_dir) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    return ln.doc_lines(sm.stream_documents(spark, f"{sf_dir}/documents.parquet*", schema, spread_by="doc_id"))


@query
def stream_clean_encode(spark, sf_dir):
    rows = sm.stream_clean_encode(_streamed_lines(spark, sf_dir), fitted(spark, sf_dir), CLEANING)
    path = new_path(spark, "stream")
    writer = rows.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint")
    writer.trigger(availableNow=True).start(f"{path}/rows").awaitTermination()
    return _shown_rows(spark.read.schema(rows.schema).parquet(f"{path}/rows"), "input_ids")


@query
def stream_pack(spark, sf_dir):
    tok = fitted(spark, sf_dir)
    rows = pk.shard_lines(sm.stream_clean_encode(_streamed_lines(spark, sf_dir), tok, CLEANING), SHARDS)
    path = new_path(spark, "stream")
    sm.stream_pack(rows, BLOCK, path, tok.eos_id).trigger(availableNow=True).start().awaitTermination()
    packed = sm.packed_blocks(spark, path).unionByName(sm.flush_remainder(spark, path))
    return _shown_blocks(packed)


QUERIES = {name.rstrip("_"): fn for name, fn in QUERIES.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job over the documents: clean, learn a vocabulary, encode, pack, shuffle, batch."""
    named = F.when(source_split() == "validation", "val").otherwise("train")
    rows = lines(spark, sf_dir).withColumn("split", named)
    cfg = JobConfig(CLEANING, JOB_TOKENIZER, LOADER)
    return prepare_corpus(rows, cfg).batches
