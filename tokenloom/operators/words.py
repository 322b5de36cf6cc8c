"""Pre-tokens, their frequencies, and the alphabet they are made of."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.config import TokenizerConfig

# Fixed value: contractions, optional space + letters, + digits, + other characters, white space.
WORD_PATTERN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Printable ASCII but the apostrophe, which may begin a contraction. Java looks single characters up in one table, ranges one by one.
_PLAIN_CHARS = "".join(c for c in map(chr, range(0x20, 0x7F)) if c != "'")
_NOT_PLAIN = "[^" + re.sub(r"([^A-Za-z0-9])", r"\\\1", _PLAIN_CHARS) + "]|  "

# Kinds of a plain text's characters: space, letter, digit, other.
_KINDS = np.array([0 if c == 32 else 1 if chr(c).isalpha() else 2 if chr(c).isdigit() else 3 for c in range(128)] + [3] * 128, np.uint8)

# Characters of plain texts that are looked at together.
_CHARS_AT_ONCE = 1 << 22

# An order key is one exact decimal, doc_id * 2^62 + line_no * 2^27 + pos (below 2^125 < 10^38): room for 2^35 lines of
# a file and 2^27 words of a line. Being of fixed width it can be a hash-aggregation buffer, which a struct cannot:
# min(struct) forces a sort.
_POS_BITS = 27
_LINE_BITS = 2**_POS_BITS
_DOC_BITS = 2**62


def words_of(text: Column) -> Column:
    """The pre-tokens of a text; together they cover it without gaps."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), 0)


def is_plain(text: Column) -> Column:
    """Whether :func:`plain_words` gives the words of a text: characters of ``_PLAIN_CHARS`` only, no two spaces in a row."""
    return ~F.rlike(text, F.lit(_NOT_PLAIN))


def plain_words(texts: pa.Array) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """The words of plain texts (none for null), in runs of rows: the first row, all words of the run, and how many each row has.

    In a plain text a word begins at a space, and where the kind of character changes other than behind a space. The words are
    slices of the texts' own buffer.
    """
    texts = texts.cast(pa.string()).fill_null("")
    if not len(texts):
        return
    _, places, chars = texts.buffers()
    bounds = np.frombuffer(places, np.int32, len(texts) + 1, 4 * texts.offset)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(bounds, int(bounds[row]) + _CHARS_AT_ONCE, "right")) - 1)
        low, own = int(bounds[row]), bounds[row : stop + 1] - bounds[row]
        if own[-1]:
            kinds = _KINDS[np.frombuffer(chars, np.uint8, int(own[-1]), low)]
            begins = kinds == 0
            begins[1:] |= (kinds[1:] != kinds[:-1]) & ~begins[:-1]
            begins[own[:-1][np.diff(own) > 0]] = True
            begin = np.flatnonzero(begins)
            edges = (np.append(begin, own[-1]) + low).astype(np.int32)
            yield row, pa.StringArray.from_buffers(len(begin), pa.py_buffer(edges), chars), np.diff(np.searchsorted(begin, own))
        else:
            yield row, pa.array([], pa.string()), np.zeros(stop - row, np.int64)
        row = stop


def _wide(value: Column) -> Column:
    return value.cast("decimal(19,0)")


def order_key(doc_id: Column, line_no: Column, pos: Column | None = None) -> Column:
    base = _wide(doc_id) * _wide(F.lit(_DOC_BITS)) + _wide(line_no.cast("bigint") * _LINE_BITS)
    key = base.cast("decimal(38,0)")
    return key if pos is None else (key + pos).cast("decimal(38,0)")


def order_parts(key: Column) -> list[Column]:
    """``doc_id, line_no, pos`` of an order key, for showing it."""
    low = F.pmod(key, _wide(F.lit(_DOC_BITS))).cast("bigint")
    high = F.call_function("div", key - low, _wide(F.lit(_DOC_BITS)))
    return [
        high.alias("doc_id"),
        F.shiftright(low, _POS_BITS).alias("line_no"),
        low.bitwiseAND(F.lit(_LINE_BITS - 1)).cast("int").alias("pos"),
    ]


def pretokenize(lines: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per pre-token: ``doc_id, line_no, pos, word``."""
    return lines.select("doc_id", "line_no", F.posexplode(words_of(F.col(text_col))).alias("pos", "word"))


_NO_PLACE = 1 << 62


def _ranked_lines(doc: pa.Array, line: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each row, where its words begin in the order of the rows' keys (equal keys alike, null ones last), and a row of each rank."""
    lacking = doc.is_null().to_numpy(zero_copy_only=False) | line.is_null().to_numpy(zero_copy_only=False)
    doc, line = (c.fill_null(0).to_numpy(zero_copy_only=False) for c in (doc, line))
    order = np.lexsort((line, doc, lacking))
    opens = np.ones(len(order), bool)
    opens[1:] = (np.diff(doc[order]) != 0) | (np.diff(line[order]) != 0) | np.diff(lacking[order])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(opens) - 1
    return np.where(lacking, _NO_PLACE, rank << 32), order[opens]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n, doc_id, line_no, pos``: the distinct words of a run of rows, how often they stand there, and where first."""
    for batch in batches:
        if not batch.num_rows:
            continue
        base, row_of = _ranked_lines(batch.column("doc_id"), batch.column("line_no"))
        listed = batch.column("words")
        others = (0, listed.flatten(), listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        for row, words, per_row in (*plain_words(batch.column("text")), others):
            if not len(words):
                continue
            coded = words.dictionary_encode()
            which, size = coded.indices.to_numpy(), len(coded.dictionary)
            start = base[row : row + len(per_row)] - (np.cumsum(per_row) - per_row)
            first = np.full(size, 2 * _NO_PLACE - 1)
            np.minimum.at(first, which, np.repeat(start, per_row) + np.arange(len(which)))
            none = first >= _NO_PLACE
            at = pa.array(row_of[np.where(none, 0, first >> 32)], mask=none)
            columns = [batch.column("doc_id").take(at), batch.column("line_no").take(at), pa.array(first & 0xFFFFFFFF, mask=none)]
            counts = pa.array(np.bincount(which, minlength=size).astype(np.int64))
            yield pa.RecordBatch.from_arrays([coded.dictionary, counts, *columns], names=["word", "n", "doc_id", "line_no", "pos"])


def word_counts(lines: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, freq, first``: frequency and the order key of the first occurrence.

    The one pass over the running text. Words are counted by the Arrow batch, and places are compared as longs there, so the
    decimal keys are made for a batch's distinct words only. Partial aggregation then sends one row per distinct word and task
    into the shuffle, so a word that makes up a third of the corpus costs no more than any other.
    """
    text = F.col(text_col)
    rows = lines.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("line_no").cast("bigint").alias("line_no"),
        F.when(is_plain(text), text).alias("text"),
        F.when(~is_plain(text), words_of(text)).alias("words"),
    )
    counted = rows.mapInArrow(_count_words, "word string, n long, doc_id long, line_no long, pos long")
    place = order_key(F.col("doc_id"), F.col("line_no"), F.col("pos"))
    return counted.groupBy("word").agg(F.sum("n").alias("freq"), F.min(place).alias("first"))


def word_filter(counts: DataFrame, cfg: TokenizerConfig = TokenizerConfig()) -> DataFrame:
    """Words frequent enough and short enough to take part in training."""
    return counts.filter(
        (F.col("freq") >= cfg.min_frequency) & (F.char_length("word") <= cfg.max_token_length)
    )


def chars_of(word: Column) -> Column:
    return F.split(word, "")


def alphabet(words: DataFrame) -> DataFrame:
    """``idx, char``: distinct characters in code-point order.

    Binary string order is code-point order. The ranking window has no partition key, but holds at most
    one row per Unicode code point.
    """
    chars = words.select(F.explode(chars_of(F.col("word"))).alias("char")).filter(F.col("char") != "").distinct()
    return chars.select((F.row_number().over(Window.orderBy("char")) - 1).alias("idx"), "char")
