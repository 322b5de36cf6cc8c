"""Learning merge rules: pairs of the distinct words are counted once, then kept up to date from the words that merges rewrite.

A word's symbols sit in one string, each wrapped in two marker characters, so that a merge is a single
native ``replace``: left to right and non-overlapping, as merging must be.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tokenloom.config import TokenizerConfig
from tokenloom.functions.text import with_computed
from tokenloom.operators.vocabulary import Merge, Tokenizer
from tokenloom.operators.words import alphabet, chars_of, word_counts, word_filter
from tokenloom.staging import new_path, scratch, stage

_OPEN, _CLOSE = "\x01", "\x02"
_JOINT = _CLOSE + _OPEN
# The marker characters themselves, should a text hold them, are spelled with two characters each.
_ESCAPES = {"\x00": "\x00a", _OPEN: "\x00b", _CLOSE: "\x00c"}

_PAIRS_PER_ROUND = 128
_HEAD, _MARKS = 2_048, 1 << 16
_PENDING_LIMIT = 64


def _wrap(word: Column) -> Column:
    def escape(char: Column) -> Column:
        return reduce(lambda out, kv: F.when(char == kv[0], kv[1]).otherwise(out), _ESCAPES.items(), char)

    chars = F.filter(chars_of(word), lambda c: c != "")
    return F.concat(F.lit(_OPEN), F.array_join(F.transform(chars, escape), _JOINT), F.lit(_CLOSE))


def _escape(symbol: str) -> str:
    return "".join(_ESCAPES.get(c, c) for c in symbol)


def _unescape(symbol: str) -> str:
    for plain, spelled in reversed(_ESCAPES.items()):
        symbol = symbol.replace(spelled, plain)
    return symbol


def word_symbols(words: DataFrame) -> DataFrame:
    """``word, freq, first, symbols``: every kept word split into single characters."""
    return words.withColumn("symbols", _wrap(F.col("word")))


def symbol_list(symbols: Column) -> Column:
    return F.split(F.substr(symbols, F.lit(2), F.length(symbols) - 2), _JOINT)


def _pairs(words: DataFrame, *keep: str, with_parts: bool = False) -> DataFrame:
    """One row per adjacent symbol pair: the kept columns, ``i, left, right`` (wrapped spelling), and all symbols if asked for."""
    parts = with_computed(words, "parts", symbol_list(F.col("symbols"))).filter(F.size("parts") > 1)
    placed = parts.select(*keep, "parts", F.explode(F.sequence(F.lit(0), F.size("parts") - 2)).alias("i"))
    return placed.select(
        *keep, "i", F.get("parts", F.col("i")).alias("left"), F.get("parts", F.col("i") + 1).alias("right"), *["parts"] * with_parts
    )


def pair_counts(words: DataFrame) -> DataFrame:
    """``left, right, freq, first, i``: pair frequency weighted by word frequency, and where it is first met.

    ``first`` is the order key of the earliest word holding the pair, ``i`` the place in that word.
    """
    spelled = {v: k for k, v in _ESCAPES.items()}

    def plain(symbol: str) -> Column:
        out = F.col(symbol)
        for code in (_ESCAPES[_CLOSE], _ESCAPES[_OPEN], _ESCAPES["\x00"]):
            out = F.replace(out, F.lit(code), F.lit(spelled[code]))
        return out.alias(symbol)

    return (
        _pairs(words, "freq", "first")
        .groupBy("left", "right")
        .agg(F.sum("freq").alias("freq"), F.min(F.struct("first", "i")).alias("met"))
        .select(plain("left"), plain("right"), "freq", "met.first", "met.i")
    )


def best_pair(pairs: DataFrame) -> DataFrame:
    """Highest frequency; among equals the pair met first."""
    return pairs.orderBy(F.desc("freq"), "first", "i").limit(1)


def merge_symbols(symbols: Column, merges: Iterable[tuple[str, str]]) -> Column:
    """Replace each pair, in the given order.

    The pairs are one array literal: the generated code is the same for any merges, so that a training
    round does not pay for compiling its own.
    """
    rules = [
        {
            "apart": _OPEN + _escape(left) + _JOINT + _escape(right) + _CLOSE,
            "joined": _OPEN + _escape(left) + _escape(right) + _CLOSE,
        }
        for left, right in merges
    ]
    listed = F.from_json(F.lit(json.dumps(rules)), "array<struct<apart:string,joined:string>>")
    return F.aggregate(listed, symbols, lambda s, r: F.replace(s, r.apart, r.joined))


def apply_merge(words: DataFrame, merges: Iterable[tuple[str, str]]) -> DataFrame:
    """Replace each pair, in the given order, in every word."""
    return words.withColumn("symbols", merge_symbols(F.col("symbols"), merges))


@dataclass(frozen=True)
class _Ranked:
    left: str
    right: str
    freq: int


@dataclass
class _Known:
    """Count of a pair, where it is first met (only a lower bound unless ``sure``), and the hash that the cluster knows it by."""

    freq: int
    met: int
    tag: int
    sure: bool = True


@dataclass(frozen=True)
class Round:
    """A round of training: its merges, the words that it rewrote, and whether the head of the ranking was read anew."""

    merges: int
    touched: int
    head_read: bool


def independent_prefix(ranked: Sequence[_Ranked], known: Iterable[str]) -> list[_Ranked]:
    """The longest head of the ranking whose merges one-at-a-time training would choose in this order.

    Let p1..pm head the ranking, with no symbol that is the left half of one and the right half of
    another. Merging p1 = (a, b) then uses up no occurrence of the others, can only lower other pairs, and
    creates pairs such as (x, ab) and (ab, y): each occurrence of one was an occurrence of (x, a) or (b, y),
    pairs outside the head and so ranked after pm, and it begins too late to win a tie against pm.
    So p2 is chosen next, and so on. The argument needs a new symbol, and no overlap within a pair: a
    merge such as (a, a), or one whose text is a token already, may be taken but ends the round.
    """
    known = set(known)
    lefts: set[str] = set()
    rights: set[str] = set()
    head: list[_Ranked] = []
    for pair in ranked:
        if pair.left in rights or pair.right in lefts:
            break
        head.append(pair)
        merged = pair.left + pair.right
        if pair.left == pair.right or merged in known:
            break
        lefts.add(pair.left)
        rights.add(pair.right)
        known.add(merged)
    return head


def _placed_pairs(words: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and, for each adjacent pair, ``left, right, at``: the word's place plus the characters before the pair.

    Unlike a symbol's number, the characters before it stay the same when other symbols of the word are merged.
    """
    placed = _pairs(words, *keep, "place", with_parts=True)
    at = F.col("place") + F.length(F.array_join(F.slice("parts", 1, F.col("i")), ""))
    return placed.select(*keep, "left", "right", at.alias("at"))


def _tag() -> Column:
    return F.xxhash64("left", "right").alias("tag")


@dataclass(frozen=True)
class _Words:
    """The words in training: ``word, symbols, freq, place``, and merges that are not yet in their symbols."""

    table: DataFrame
    pending: tuple[tuple[str, str], ...] = ()

    def all(self, holding: Iterable[str] | None = None) -> DataFrame:
        """The words with all merges done; of those words only whose text holds one of the given (plain) spellings.

        A pair, or a symbol made from one, stands only in words that hold its text: a look at the text spares most words the merges.
        """
        words = self.table
        if holding is not None:
            sought = F.from_json(F.lit(json.dumps(list(holding))), "array<string>")
            words = words.filter(F.exists(sought, lambda s: F.contains(F.col("word"), s)))
        return with_computed(words, "symbols", merge_symbols(F.col("symbols"), self.pending)) if self.pending else words


class _Head:
    """The pairs that can come next, with exact counts, kept on the driver between rounds.

    Counts are read once for the ``size`` first pairs of the ranking (the base). A merge only lowers other pairs and
    makes pairs with its own symbol, so a pair outside stays behind the last one inside (``bound``) until the head
    is read again, and the changes in the words that a merge rewrites (the deltas) keep the head exact.
    """

    def __init__(self, size: int):
        self.size = size
        self.pairs: dict[tuple[str, str], _Known] = {}
        self.bound: tuple[int, int] | None = None  # rank of the last pair of a full head; None if all pairs are in it

    def read(self, words: _Words) -> None:
        counted = _placed_pairs(words.all(), "freq").groupBy("left", "right").agg(F.sum("freq").alias("freq"), F.min("at").alias("met"))
        rows = counted.orderBy(F.desc("freq"), "met").limit(self.size).select("*", _tag()).collect()
        self.pairs = {(r.left, r.right): _Known(r.freq, r.met, r.tag) for r in rows}
        self.bound = (-rows[-1].freq, rows[-1].met) if len(rows) == self.size else None

    def may_hold(self, tag: Column) -> Column:
        """Whether the head has a pair of this tag, wrongly true for a few in a hundred: one bit map instead of 2,048 literals to plan."""
        bits = np.zeros(_MARKS, bool)
        bits[[k.tag % _MARKS for k in self.pairs.values()]] = True
        place = F.pmod(tag, F.lit(_MARKS))
        byte = F.substr(F.lit(np.packbits(bits, bitorder="little").tobytes()), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
        bit = F.call_function("shiftright", F.conv(F.hex(byte), 16, 10).cast("bigint"), F.pmod(place, F.lit(8)).cast("int"))
        return bit.bitwiseAND(F.lit(1)) == 1

    @property
    def least(self) -> int:
        return -self.bound[0] if self.bound else 1

    def apply(self, rows: list, made: set[str]) -> None:
        """Take in the changes of a round that made the symbols ``made``."""
        self.pairs = {p: k for p, k in self.pairs.items() if made.isdisjoint(p)}
        for r in rows:
            pair = (r.left, r.right)
            if r.left in made or r.right in made:  # all its occurrences are among the rewritten words
                self.pairs[pair] = _Known(r.plus, r.first_now, r.tag)
                continue
            known = self.pairs[pair]
            known.freq += r.delta
            if r.first_before is not None and r.first_before <= known.met != r.first_now:
                known.sure = False
        # The bound only settles places with exact counts: what fell behind it is looked at again when the head is read.
        self.pairs = {p: k for p, k in self.pairs.items() if k.freq >= self.least}

    def ranked(self, words: _Words) -> list[tuple[tuple[str, str], _Known]]:
        """The pairs that are surely ahead of all those outside, in order; unsure places are settled only where counts tie."""
        while True:
            order = sorted(self.pairs.items(), key=lambda kv: (-kv[1].freq, kv[1].met))[: 2 * _PAIRS_PER_ROUND]
            counts = Counter(k.freq for _, k in order)
            unsure = {p: k for p, k in order if not k.sure and (counts[k.freq] > 1 or k.freq == self.least)}
            if not unsure:
                break
            tags = ", ".join(str(k.tag) for k in unsure.values())
            texts = [_unescape(a) + _unescape(b) for a, b in unsure]
            met = _placed_pairs(words.all(texts)).select("left", "right", "at", _tag()).filter(f"tag IN ({tags})")
            for r in met.groupBy("left", "right").agg(F.min("at").alias("met")).collect():
                if (known := unsure.get((r.left, r.right))) is not None:
                    known.met, known.sure = r.met, True
        inside = [(p, k) for p, k in order if self.bound is None or (-k.freq, k.met) <= self.bound]
        return inside[:_PAIRS_PER_ROUND]


def _changes(words: _Words, taken: list[tuple[str, str]], remade: list[str], head: _Head) -> tuple[list, int]:
    """What ``taken`` changes in the counts of the head's pairs and of pairs with new symbols, and how many words it rewrites.

    A word is looked at only if a merge rewrites it, or if it holds a symbol whose text another merge had made before:
    counts of pairs with such a symbol are read anew. Everything but the comparison of the two spellings is work on those words.
    """
    rewritten = words.all([a + b for a, b in taken])
    both = with_computed(rewritten, "after", merge_symbols(F.col("symbols"), taken))
    changed = F.col("symbols") != F.col("after")
    if remade:
        again = F.from_json(F.lit(json.dumps([_OPEN + _escape(s) + _CLOSE for s in remade])), "array<string>")
        changed = changed | F.exists(again, lambda s: F.contains(F.col("after"), s))
    touched = Observation()
    both = both.filter(changed).observe(touched, F.count("*").alias("words"))
    spelled = F.explode(F.array(F.struct(F.col("symbols"), F.lit(-1).alias("sign")), F.struct(F.col("after").alias("symbols"), F.lit(1).alias("sign"))))
    sides = both.select("place", "freq", spelled.alias("side")).select("place", "freq", "side.symbols", "side.sign")
    pairs, now = _placed_pairs(sides, "freq", "sign"), F.col("sign") > 0
    changes = pairs.groupBy("left", "right").agg(
        F.sum(F.col("freq") * F.col("sign")).alias("delta"),
        F.sum(F.when(now, F.col("freq")).otherwise(0)).alias("plus"),
        F.min(F.when(now, F.col("at"))).alias("first_now"),
        F.min(F.when(~now, F.col("at"))).alias("first_before"),
    )
    made = F.from_json(F.lit(json.dumps([_escape(a + b) for a, b in taken])), "array<string>")
    new = F.arrays_overlap(F.array("left", "right"), made)
    rows = changes.select("*", _tag(), new.alias("new")).filter(
        (F.col("new") & (F.col("plus") >= head.least))
        | (~F.col("new") & head.may_hold(F.col("tag")) & ((F.col("delta") != 0) | ~F.col("first_now").eqNullSafe(F.col("first_before"))))
    )
    found = [r for r in rows.collect() if r.new or (r.left, r.right) in head.pairs]
    return found, touched.get["words"]


def train_from_words(words: DataFrame, cfg: TokenizerConfig = TokenizerConfig(), rounds: list[Round] | None = None) -> Tokenizer:
    """Learn merges until the vocabulary holds ``vocab_size`` tokens or no pair is left.

    ``words`` is ``word, freq, first``, as :func:`word_filter` gives it. All pairs are counted once, and again only when the
    2,048 first pairs of the ranking are used up; in between, a round works on the words that its merges rewrite
    (:class:`_Head`, :func:`_changes`). Each round takes every merge that is certain (:func:`independent_prefix`), so
    rounds are far fewer than merges. The driver sees the alphabet and the head; words and pairs stay distributed.
    ``rounds`` is filled with what each round did.
    """
    with scratch(words.sparkSession):
        chars, merges = _learned(words, cfg, [] if rounds is None else rounds)
    return Tokenizer.build(cfg, chars, merges)


def _learned(words: DataFrame, cfg: TokenizerConfig, rounds: list[Round]) -> tuple[list[str], list[Merge]]:
    spark = words.sparkSession
    words = stage(words, "words")
    # A sorted position replaces the wide order key: one long per word, leaving room for the characters in it.
    stride = 2 * cfg.max_token_length + 1
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Rounds are many small jobs, which re-planning at run time would only delay: they get a session of their own.
    trainer = spark.newSession()
    trainer.conf.set("spark.sql.adaptive.enabled", "false")
    trainer.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, "symbols")
    stage(
        word_symbols(words.repartitionByRange(tasks, "first").sortWithinPartitions("first"))
        .withColumn("place", F.monotonically_increasing_id() * stride)
        .select("word", "symbols", "freq", "place"),
        "symbols",
        path,
    )
    table = trainer.read.schema("word string, symbols string, freq bigint, place bigint").parquet(path)
    chars = [r.char for r in alphabet(words).orderBy("idx").collect()]
    known = set(cfg.special_tokens) | set(cfg.special_tokens.values()) | set(chars)
    size = len(set(cfg.special_tokens.values()) | set(chars))
    merges: list[Merge] = []

    # Two slots written in turn: the older generation is overwritten, so scratch space stays at two tables.
    slots = [new_path(spark, "symbols"), new_path(spark, "symbols")]
    generation = 0
    pending: list[tuple[str, str]] = []
    head, table = _Head(_HEAD), table.persist(StorageLevel.MEMORY_AND_DISK)
    current = _Words(table)
    try:
        while size < cfg.vocab_size:
            ranked = head.ranked(current)
            read = not ranked
            if read:
                head.read(current)
                ranked = head.ranked(current)
            if not ranked:
                break
            taken, remade = [], []
            for pair in independent_prefix([_Ranked(_unescape(a), _unescape(b), k.freq) for (a, b), k in ranked], known):
                if size >= cfg.vocab_size:
                    break
                merged = pair.left + pair.right
                merges.append(Merge(len(merges), pair.left, pair.right, merged, pair.freq))
                taken.append((pair.left, pair.right))
                if merged in known:
                    remade.append(merged)
                else:
                    known.add(merged)
                    size += 1
            if size >= cfg.vocab_size:
                rounds.append(Round(len(taken), 0, read))
                break
            rows, touched = _changes(current, taken, remade, head)
            head.apply(rows, {_escape(a + b) for a, b in taken})
            rounds.append(Round(len(taken), touched, read))
            pending += taken
            current = _Words(table, tuple(pending))
            if len(pending) >= _PENDING_LIMIT:
                done = current.all().filter(F.contains("symbols", F.lit(_JOINT)))
                fresh = stage(done, "symbols", path=slots[generation % 2]).persist(StorageLevel.MEMORY_AND_DISK)
                table.unpersist()
                table, pending, generation = fresh, [], generation + 1
                current = _Words(table)
    finally:
        table.unpersist()
    return chars, merges


def train_tokenizer(
    lines: DataFrame,
    cfg: TokenizerConfig = TokenizerConfig(),
    text_col: str = "text",
) -> Tokenizer:
    """Train on ``doc_id, line_no, text``. Texts are taken as they are: normalization belongs to encoding."""
    return train_from_words(word_filter(word_counts(lines, text_col), cfg), cfg)
