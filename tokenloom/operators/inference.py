"""Batch inference around a predictor that the caller brings."""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions.text import strip_text, with_computed
from tokenloom.operators.encoding import decode_expr, encode_texts
from tokenloom.operators.vocabulary import Tokenizer
from tokenloom.staging import stage

# ids [batch, width] and mask [batch, width] -> logits [batch, vocabulary]
Predict = Callable[[np.ndarray, np.ndarray], np.ndarray]


def prepare_prompts(
    prompts: DataFrame, tokenizer: Tokenizer, text_col: str = "text", lower: bool = True
) -> DataFrame:
    """Stripped, non-empty prompts with ``input_ids`` (specials on, no cut, no padding) and ``attention_mask``."""
    text = strip_text(F.col(text_col))
    kept = with_computed(prompts, text_col, F.lower(text) if lower else text).filter(F.col(text_col) != "")
    return encode_texts(kept, tokenizer, text_col, return_attention_mask=True)


def strip_prompt(
    outputs: DataFrame, tokenizer: Tokenizer, ids_col: str = "output_ids", prompt_length_col: str = "prompt_length"
) -> DataFrame:
    """The generated text: ids behind the prompt, decoded without special tokens."""
    rest = F.slice(ids_col, F.col(prompt_length_col) + 1, F.greatest(F.lit(0), F.size(ids_col) - F.col(prompt_length_col)))
    return outputs.withColumn("text", decode_expr(rest, tokenizer))


class Padding:
    """Real and all positions of the batches that a predictor got, added up over all tasks."""

    def __init__(self, spark: SparkSession):
        self._real, self._all = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def add(self, mask: np.ndarray) -> None:
        self._real.add(int(mask.sum()))
        self._all.add(int(mask.size))

    @property
    def share(self) -> float:
        """The share of positions that is padding, once the rows were computed. Repeated tasks count again."""
        return 1 - self._real.value / self._all.value if self._all.value else 0.0


def length_parts(counts: Mapping[int, int], parts: int) -> list[tuple[int, int, int]]:
    """Cut a histogram of lengths into ``parts`` of about equal numbers of positions: ``length, first, width`` for each length.

    Rows of a length are spread over ``width`` parts from ``first``, so that a length of any frequency is cut as well, and each
    part holds neighbouring lengths only.
    """
    total = max(1, sum(max(1, n) * c for n, c in counts.items()))
    out, before = [], 0
    for n in sorted(counts):
        own = max(1, n) * counts[n]
        first, last = before * parts // total, max(before, before + own - 1) * parts // total
        out.append((n, first, last - first + 1))
        before += own
    return out


def by_length(prompts: DataFrame, keys: Sequence[str], parts: int, ids_col: str = "input_ids") -> DataFrame:
    """The rows dealt to ``parts`` by length and sorted by it within them: near lengths stand next to each other.

    ``prompts`` should be a written table, since its histogram is read first. That has a row per length, at most as many as
    the longest prompt has tokens; it is broadcast back.
    """
    size = F.coalesce(F.size(ids_col), F.lit(0))
    counts = {r.n: r.c for r in prompts.groupBy(size.alias("n")).agg(F.count("*").alias("c")).collect()}
    if not counts:
        return prompts
    table = prompts.sparkSession.createDataFrame(length_parts(counts, parts), "_n int, _first int, _width int")
    placed = prompts.withColumn("_n", size).join(F.broadcast(table), "_n")
    part = F.col("_first") + F.pmod(F.xxhash64(*keys), F.col("_width"))
    return placed.repartitionById(parts, part.cast("int")).sortWithinPartitions("_n", *keys).drop("_n", "_first", "_width")


def _model_of_worker(tag: str, make_predict: Callable[[], Predict]) -> Predict:
    """The predictor of this Python worker, which Spark keeps from task to task; another call's predictor makes room."""
    held = sys.__dict__.setdefault("_predictor_of_worker", {})
    if tag not in held:
        held.clear()
        held[tag] = make_predict()
    return held[tag]


def batch_predict(
    prompts: DataFrame,
    make_predict: Callable[[], Predict],
    keys: tuple[str, ...],
    pad: int,
    batch_size: int = 64,
    near_lengths: bool = True,
    padding: Padding | None = None,
) -> DataFrame:
    """``keys, input_ids, logits``: next-token scores, one array per prompt, from a predictor built once per Python worker.

    Rows are padded on the right to the longest of their batch; the mask tells real positions. With ``near_lengths`` the
    prompts are written and dealt out by length first (:func:`by_length`), so that batches hardly pad and tasks have equal
    work; else they are taken as they lie. ``padding`` counts either way. A null prompt is an empty one. ``posexplode`` of the
    array gives one row per token for the operators in :mod:`candidates`; :func:`next_token_draw` works on the array.
    """
    tag = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = _model_of_worker(tag, make_predict)
        for arrow in batches:
            for at in range(0, arrow.num_rows, batch_size):
                part = arrow.slice(at, batch_size)
                lists = part.column("input_ids")
                offsets = lists.offsets.to_numpy()
                mask = np.arange(np.diff(offsets).max(initial=0))[None, :] < np.diff(offsets)[:, None]
                ids = np.full(mask.shape, pad, np.int64)
                ids[mask] = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
                if padding is not None:
                    padding.add(mask)
                logits = np.asarray(predict(ids, mask.astype(np.int64)), dtype=np.float64)
                n, v = logits.shape
                rows = pa.ListArray.from_arrays(pa.array(np.arange(0, n * v + 1, v, dtype=np.int32)), pa.array(logits.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in keys], lists, rows], names=[*keys, "input_ids", "logits"]
                )

    ids, scores = T.ArrayType(T.IntegerType()), T.ArrayType(T.DoubleType())
    schema = T.StructType([*[prompts.schema[k] for k in keys], T.StructField("input_ids", ids), T.StructField("logits", scores)])
    rows = prompts.select(*keys, "input_ids")
    if near_lengths:
        spark = prompts.sparkSession
        tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        rows = by_length(stage(rows, "prompts"), keys, tasks)
    return rows.mapInArrow(run, schema)


@dataclass(frozen=True)
class DrawConfig:
    """``repetition_penalty`` 1, ``no_repeat_ngram`` 0, ``top_k`` 0 and ``top_p`` 1 switch a step off; temperature 0 is greedy."""

    repetition_penalty: float = 1.0
    no_repeat_ngram: int = 0
    temperature: float = 1.0
    top_k: int = 0
    top_p: float = 1.0
    seed: int = 0


def banned_tokens(ids: np.ndarray, n: int) -> np.ndarray:
    """The tokens that would complete an ``n``-gram which the ids hold already."""
    if n <= 0 or len(ids) < n:
        return np.zeros(0, np.int64)
    grams = np.lib.stride_tricks.sliding_window_view(ids, n)
    return grams[(grams[:, : n - 1] == ids[len(ids) - n + 1 :]).all(axis=1), n - 1]


def draw(ids: np.ndarray, logits: np.ndarray, key: str, cfg: DrawConfig) -> tuple[int, float]:
    """Penalty, ban, temperature, top-k, nucleus and the draw for one row: the token and its final score."""
    tokens, times = np.unique(ids[(ids >= 0) & (ids < len(logits))], return_counts=True)
    x = logits.copy()
    x[tokens] /= cfg.repetition_penalty ** times.astype(np.float64)
    banned = banned_tokens(ids, cfg.no_repeat_ngram)
    x[banned[(banned >= 0) & (banned < len(x))]] = -np.inf
    if cfg.temperature > 0:
        x = x / cfg.temperature
    if 0 < cfg.top_k < len(x):
        x[x < np.partition(x, -cfg.top_k)[-cfg.top_k]] = -np.inf
    order = np.lexsort((np.arange(len(x)), -x))
    order = order[np.isfinite(x[order])]
    if not len(order):  # all are banned: the best raw score stands
        return int(logits.argmax()), 0.0
    if cfg.top_p < 1:
        weights = np.exp(x[order] - x[order[0]])
        before = np.cumsum(weights) - weights
        stay = before <= cfg.top_p * weights.sum()
        stay[0] = True
        order = order[stay]
    if cfg.temperature == 0:
        return int(order[0]), float(x[order[0]])
    digits = [int(hashlib.md5(f"{cfg.seed}:{key}:{t}".encode()).hexdigest()[:13], 16) for t in order.tolist()]
    noise = -np.log(-np.log((np.array(digits, np.float64) + 0.5) / 2.0**52))
    best = order[(x[order] + noise).argmax()]
    return int(best), float(x[best])


def next_token_draw(scores: DataFrame, keys: tuple[str, ...], cfg: DrawConfig = DrawConfig()) -> DataFrame:
    """``keys, token_id, logit``: one token per row of ``keys, input_ids, logits``, drawn within the row, without a shuffle.

    Scores of tokens in ``input_ids`` are divided by the penalty to the power of their count, tokens that would repeat an
    n-gram of ``input_ids`` are banned, then temperature, top-k (ties stay), nucleus and the draw follow, whose noise is
    a hash of seed, keys and token. Where all are banned the best raw score stands. Rows without scores have no token.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, logits = batch.column("input_ids"), batch.column("logits")
            labels = zip(*[batch.column(k).to_pylist() for k in keys], strict=True)
            found = []
            for i, label in enumerate(labels):
                own = np.asarray(logits[i].values.to_numpy(zero_copy_only=False) if logits[i].is_valid else [], np.float64)
                held = np.asarray(ids[i].values.to_numpy(zero_copy_only=False) if ids[i].is_valid else [], np.int64)
                found.append(draw(held, own, ":".join(map(str, label)), cfg) if len(own) else (None, None))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(k) for k in keys],
                    pa.array([t for t, _ in found], pa.int32()),
                    pa.array([x for _, x in found], pa.float64()),
                ],
                names=[*keys, "token_id", "logit"],
            )

    schema = T.StructType(
        [scores.schema[k] for k in keys] + [T.StructField("token_id", T.IntegerType()), T.StructField("logit", T.DoubleType())]
    )
    return scores.select(*keys, "input_ids", "logits").mapInArrow(run, schema)
