"""Text to token ids and back.

Encoding needs no join. The merge rules are bounded by the vocabulary, so they go to every task, and a
task encodes each distinct word of an Arrow batch once; the running text is then filled in by array
arithmetic. Joining the text's words with a table of encoded words would instead shuffle every word
occurrence of the corpus twice, with the most frequent words as hot keys.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions import tokens as tk
from tokenloom.functions.text import unicode_normalize, with_computed
from tokenloom.operators.vocabulary import Tokenizer, token_at
from tokenloom.operators.words import is_plain, plain_words, words_of

EncodeFn = Callable[[Column], Column]

# Words that a Python worker keeps encoded: some 20 MB. Frequent words are back at once after it is emptied.
_MEMO_LIMIT = 1 << 16

# Words that are encoded side by side, up to a length in characters, and pairs of symbols that get a table of their own.
_WORDS_AT_ONCE, _SHORT_WORD, _DENSE_PAIRS = 1 << 14, 32, 1 << 22


def split_word(word: str, merges: dict[tuple[str, str], str]) -> list[str]:
    """Apply the leftmost known pair until none is left. Rule rank plays no part.

    Everything left of the leftmost pair is settled, so one sweep with a stack does it: push a
    character, then join the top two symbols for as long as they form a known pair.
    """
    stack: list[str] = []
    for char in word:
        stack.append(char)
        while len(stack) > 1 and (joined := merges.get((stack[-2], stack[-1]))) is not None:
            stack[-2:] = [joined]
    return stack


def _merge_map(tokenizer: Tokenizer) -> dict[tuple[str, str], str]:
    return {(m.left, m.right): m.merged for m in tokenizer.merges}


# Distinct words to their ids: all ids in one pool, and each word's place and number of ids in it.
Pool = tuple[np.ndarray, np.ndarray, np.ndarray]
PoolFn = Callable[[pa.Array], Pool]


def _fill_in(words: pa.Array, per_row: np.ndarray, encode_all: PoolFn) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of the words, and how many each row has; only distinct words are encoded."""
    coded = words.dictionary_encode()
    pool, word_at, size = encode_all(coded.dictionary)

    which = coded.indices.to_numpy()
    length = size[which]
    end = np.cumsum(length)
    total = int(end[-1]) if len(end) else 0
    ids = pool[np.arange(total) + np.repeat(word_at[which] - (end - length), length)]

    bounds = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(per_row)])]
    return ids, np.diff(bounds)


def _one_by_one(merges: dict[tuple[str, str], str], ids: dict[str, int], unk: int) -> PoolFn:
    """Words of any characters; those once encoded are kept."""
    memo: dict[str, list[int]] = {}

    def encode_word(word: str) -> list[int]:
        found = memo.get(word)
        if found is None:
            if len(memo) >= _MEMO_LIMIT:
                memo.clear()
            found = memo[word] = [ids.get(t, unk) for t in split_word(word, merges)]
        return found

    def encode_all(words: pa.Array) -> Pool:
        pieces = [encode_word(w) for w in words.to_pylist()]
        size = np.fromiter((len(p) for p in pieces), np.int64, len(pieces))
        pool = np.fromiter(chain.from_iterable(pieces), np.int32, int(size.sum()))
        return pool, np.cumsum(size) - size, size

    return encode_all


def _side_by_side(merges: dict[tuple[str, str], str], ids: dict[str, int], unk: int) -> PoolFn:
    """ASCII words, as :func:`split_word` does it, but one character of thousands of words at a time; longer words one by one."""
    symbols = {chr(c): c for c in range(128)}
    for symbol in chain.from_iterable((*pair, merged) for pair, merged in merges.items()):
        symbols.setdefault(symbol, len(symbols))
    bottom = len(symbols)  # below every stack: part of no pair
    token = np.array([ids.get(s, unk) for s in symbols], np.int32)
    codes = np.array([symbols[a] * (bottom + 1) + symbols[b] for a, b in merges], np.int64)
    made = np.array([symbols[m] for m in merges.values()], np.int32)
    dense = (bottom + 1) ** 2 <= _DENSE_PAIRS
    if dense:
        table = np.full((bottom + 1) ** 2, -1, np.int32)
        table[codes] = made
    else:
        order = np.argsort(codes)
        codes, made = codes[order], made[order]

    def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left.astype(np.int64) * (bottom + 1) + right
        if dense:
            return table[code]
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        return np.where(codes[at] == code, made[at], -1)

    def encode_some(chars: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, order = len(begin), np.argsort(length, kind="stable")
        begin, length = begin[order], length[order]
        stack = np.full((int(length[-1]) + 1) * n, bottom, np.int32)
        depth = np.ones(n, np.int64)
        for i in range(int(length[-1])):
            first = int(np.searchsorted(length, i, "right"))  # words of more than i characters
            word = np.arange(first, n)
            top = chars[begin[first:] + i].astype(np.int32)
            at = np.arange(n - first)
            while len(at):
                found = joined(stack[(depth[word[at]] - 1) * n + word[at]], top[at])
                at, found = at[found >= 0], found[found >= 0]
                top[at] = found
                depth[word[at]] -= 1
            stack[depth[first:] * n + word] = top
            depth[first:] += 1
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        size = depth[rank] - 1
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return token[stack[(place + 1) * n + np.repeat(rank, size)]], size

    rest = _one_by_one(merges, ids, unk)

    def encode_all(words: pa.Array) -> Pool:
        _, places, chars = words.buffers()
        bounds = np.frombuffer(places, np.int32, len(words) + 1, 4 * words.offset).astype(np.int64)
        chars = np.frombuffer(chars, np.uint8) if chars is not None else np.zeros(0, np.uint8)
        length = np.diff(bounds)
        short = np.flatnonzero(length <= _SHORT_WORD)
        pools, size, sizes = [], np.zeros(len(words), np.int64), []
        for some in np.array_split(short, len(short) // _WORDS_AT_ONCE + 1):
            if len(some):
                pool, size[some] = encode_some(chars, bounds[some], length[some])
                pools.append(pool)
        long = np.flatnonzero(length > _SHORT_WORD)
        pool, _, size[long] = rest(words.take(pa.array(long)))
        in_pool = np.concatenate([short, long])
        word_at = np.empty(len(words), np.int64)
        word_at[in_pool] = np.cumsum(size[in_pool]) - size[in_pool]
        return np.concatenate([*pools, pool]), word_at, size

    return encode_all


def _lists(parts: list[tuple[np.ndarray, np.ndarray]], given: pa.Array) -> pa.ListArray:
    """The ids of all parts as one list for each row of ``given``, null where that is."""
    ids = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int32)])
    bounds = np.concatenate([[0], np.cumsum(np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)]))])
    mask = given.is_null() if given.null_count else None
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()), mask=mask)


def _rules_of(spark: SparkSession, tokenizer: Tokenizer, method: Callable[..., PoolFn]) -> Callable[[], PoolFn]:
    """What gives a task its ``method`` under the tokenizer's rules, which are broadcast."""
    tokenizer.require_trained()
    rules = spark.sparkContext.broadcast((_merge_map(tokenizer), tokenizer.ids, tokenizer.unk_id))
    made: list[PoolFn] = []

    def of_task() -> PoolFn:
        if not made:
            made.append(method(*rules.value))
        return made[0]

    return of_task


def word_encoder(spark: SparkSession, tokenizer: Tokenizer) -> EncodeFn:
    """A column function ``array<string>`` of words -> ``array<int>`` of ids."""
    rules = _rules_of(spark, tokenizer, _one_by_one)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(words: pa.Array) -> pa.Array:
        per_row = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return _lists([_fill_in(words.flatten(), per_row, rules())], words)

    return encode


def plain_encoder(spark: SparkSession, tokenizer: Tokenizer) -> EncodeFn:
    """A column function from plain texts (:func:`is_plain`) to their ids: no word is ever a row or a string of the JVM."""
    rules = _rules_of(spark, tokenizer, _side_by_side)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: pa.Array) -> pa.Array:
        return _lists([_fill_in(words, per_row, rules()) for _, words, per_row in plain_words(texts)], texts)

    return encode


def encoder(spark: SparkSession, tokenizer: Tokenizer, ascii_only: bool = False) -> EncodeFn:
    """The tokenizer as a column function, text -> ids without special tokens.

    ``ascii_only`` promises ASCII input (text cleaned of special characters), which normalization
    would not change, and so saves a pass through Python.
    """
    encode_plain, encode_words_ = plain_encoder(spark, tokenizer), word_encoder(spark, tokenizer)
    cfg = tokenizer.config

    def encode(text: Column) -> Column:
        if not ascii_only:
            text = unicode_normalize(text, cfg.unicode_normalizer)
        if cfg.lowercase:
            text = F.lower(text)
        plain = is_plain(text)
        return F.coalesce(encode_plain(F.when(plain, text)), encode_words_(F.when(~plain, words_of(text))))

    return encode


def encode_words(words: DataFrame, tokenizer: Tokenizer, word_col: str = "word") -> DataFrame:
    """Add ``tokens``, the sub-word tokens of each word, to a table of (distinct) words.

    A generated column: a filter over an ordinary one, such as exploding the tokens adds, would take the Python function along
    below the aggregate that makes the words distinct, and run it on every occurrence.
    """
    tokenizer.require_trained()
    rules = words.sparkSession.sparkContext.broadcast(_merge_map(tokenizer))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split_all(column: pa.Array) -> pa.Array:
        return pa.array(
            [None if w is None else split_word(w, rules.value) for w in column.to_pylist()], pa.list_(pa.string())
        )

    return with_computed(words, "tokens", split_all(F.col(word_col)))


def encode_documents(
    lines: DataFrame, encode: Tokenizer | EncodeFn, text_col: str = "text", ascii_only: bool = False
) -> DataFrame:
    """Replace the text by ``input_ids`` (no special tokens). Narrow: no shuffle, no join."""
    if isinstance(encode, Tokenizer):
        encode = encoder(lines.sparkSession, encode, ascii_only)
    return with_computed(lines, "input_ids", encode(F.col(text_col))).drop(text_col)


def encode_texts(
    lines: DataFrame,
    tokenizer: Tokenizer,
    text_col: str = "text",
    add_special_tokens: bool = True,
    max_length: int | None = None,
    truncation: bool = False,
    padding: bool = False,
    return_attention_mask: bool = False,
    ascii_only: bool = False,
) -> DataFrame:
    """Encoding with every option: specials, truncation, padding, and the mask by length."""
    out = encode_documents(lines, tokenizer, text_col, ascii_only)
    ids = F.col("input_ids")
    if add_special_tokens:
        ids = tk.add_special_tokens(ids, tokenizer.bos_id, tokenizer.eos_id, max_length)
    out = out.withColumn("input_ids", ids)
    if max_length and truncation:
        eos = tokenizer.eos_id if add_special_tokens else None
        out = out.withColumn("input_ids", tk.truncate_ids(F.col("input_ids"), max_length, eos))
    width = max_length if max_length and padding else None
    if return_attention_mask:
        out = out.withColumn("attention_mask", tk.length_mask(F.size("input_ids"), width))
    if width:
        out = out.withColumn("input_ids", tk.pad_ids(F.col("input_ids"), width, tokenizer.pad_id))
    return out


def decode_expr(ids: Column, tokenizer: Tokenizer, skip_special_tokens: bool = True) -> Column:
    """Ids back to text, in the JVM; tokens that read like a special token are left out on request."""
    tokens = F.transform(ids, lambda i: token_at(i, tokenizer))
    if skip_special_tokens:
        tokens = F.filter(tokens, lambda t: ~t.isin(*tokenizer.config.special_tokens.values()))
    return F.array_join(tokens, "")


def decode_ids(
    encoded: DataFrame, tokenizer: Tokenizer, skip_special_tokens: bool = True, ids_col: str = "input_ids"
) -> DataFrame:
    return encoded.withColumn("text", decode_expr(F.col(ids_col), tokenizer, skip_special_tokens))


def roundtrip_check(lines: DataFrame, tokenizer: Tokenizer, text_col: str = "text") -> DataFrame:
    """One row: lines checked, and lines that decoding gives back unchanged (specials added and skipped)."""
    kept = lines.withColumn("original", F.col(text_col))
    decoded = decode_ids(encode_texts(kept, tokenizer, text_col), tokenizer)
    return decoded.agg(
        F.count("*").alias("lines"),
        F.sum(F.when(F.col("text") == F.col("original"), 1).otherwise(0)).cast("bigint").alias("unchanged"),
    )
