"""The fitted tokenizer: merge rules and token ids, small by construction (one entry per vocabulary token)."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.config import TokenizerConfig

MERGE_SCHEMA = "rank int, left string, right string, merged string, pair_freq long"
VOCAB_SCHEMA = "token string, id int, kind string"


class TokenizerError(Exception):
    """A tokenizer that cannot be loaded, or is used before training."""


@dataclass(frozen=True)
class Merge:
    rank: int
    left: str
    right: str
    merged: str
    pair_freq: int


@dataclass(frozen=True)
class VocabEntry:
    token: str
    id: int
    kind: str


def number_tokens(
    special_tokens: Mapping[str, str], chars: Iterable[str], merged: Iterable[str], dense_ids: bool = True
) -> list[VocabEntry]:
    """Special tokens from 0, their aliases on the same ids, then characters, then merges without repeats.

    Without ``dense_ids`` the aliases use up ids too: the next id is the number of names given so far.
    """
    entries: list[VocabEntry] = []
    names: dict[str, int] = {}

    def add(token: str, kind: str) -> None:
        if token not in names:
            distinct = len(entries) if dense_ids else len(names)
            names[token] = distinct
            entries.append(VocabEntry(token, distinct, kind))

    for value in special_tokens.values():
        add(value, "special")
    aliases = [VocabEntry(alias, names[value], "alias") for alias, value in special_tokens.items()]
    for alias in aliases:
        names[alias.token] = alias.id
    for char in chars:
        add(char, "char")
    for token in merged:
        add(token, "merge")
    return entries + aliases


@dataclass(frozen=True)
class Tokenizer:
    config: TokenizerConfig
    merges: tuple[Merge, ...]
    vocab: tuple[VocabEntry, ...]

    @classmethod
    def build(cls, config: TokenizerConfig, chars: Sequence[str], merges: Sequence[Merge]) -> Tokenizer:
        vocab = number_tokens(config.special_tokens, chars, [m.merged for m in merges], config.dense_ids)
        return cls(config, tuple(merges), tuple(vocab))

    def __len__(self) -> int:
        """Distinct ids, aliases not counted."""
        return sum(e.kind != "alias" for e in self.vocab)

    @property
    def ids(self) -> dict[str, int]:
        return {e.token: e.id for e in self.vocab}

    @property
    def tokens(self) -> dict[int, str]:
        return {e.id: e.token for e in self.vocab if e.kind != "alias"}

    def _special(self, alias: str) -> int:
        return self.ids[self.config.special_tokens[alias]]

    @property
    def pad_id(self) -> int:
        return self._special("<pad>")

    @property
    def unk_id(self) -> int:
        return self._special("<unk>")

    @property
    def bos_id(self) -> int:
        return self._special("<bos>")

    @property
    def eos_id(self) -> int:
        return self._special("<eos>")

    def require_trained(self) -> None:
        if not self.merges:
            raise TokenizerError("the tokenizer has no merges; train it first")

    def merge_table(self, spark: SparkSession) -> DataFrame:
        rows = [(m.rank, m.left, m.right, m.merged, m.pair_freq) for m in self.merges]
        return spark.createDataFrame(rows, MERGE_SCHEMA)

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(e.token, e.id, e.kind) for e in self.vocab], VOCAB_SCHEMA)


def special_token_ids(vocab: DataFrame) -> DataFrame:
    """``alias, token, id`` of the special tokens, read off a vocabulary table."""
    alias = vocab.filter(F.col("kind") == "alias").select(F.col("token").alias("alias"), "id")
    return alias.join(F.broadcast(vocab.filter(F.col("kind") == "special").select("token", "id")), "id")


def token_to_id(tokens: DataFrame, tokenizer: Tokenizer, token_col: str = "token", out: str = "id") -> DataFrame:
    """Look tokens up, aliases too; unknown ones get the UNK id.

    The vocabulary is broadcast: it has one row per token, ``vocab_size`` and the aliases at most.
    """
    vocab = tokenizer.vocab_table(tokens.sparkSession).select(F.col("token").alias(token_col), F.col("id").alias(out))
    return tokens.join(F.broadcast(vocab), token_col, "left").withColumn(
        out, F.coalesce(out, F.lit(tokenizer.unk_id))
    )


def id_to_token(ids: DataFrame, tokenizer: Tokenizer, id_col: str = "id", out: str = "token") -> DataFrame:
    """Look ids up; ids without a token read as the UNK token."""
    return ids.withColumn(out, token_at(F.col(id_col), tokenizer))


def token_at(token_id: Column, tokenizer: Tokenizer) -> Column:
    """The token of an id as an expression: constant-time access to an array literal of the vocabulary."""
    by_id = tokenizer.tokens
    listed = json.dumps([by_id.get(i) for i in range(max(by_id) + 1)])
    unk = tokenizer.config.special_tokens["<unk>"]
    return F.coalesce(F.get(F.from_json(F.lit(listed), "array<string>"), token_id), F.lit(unk))
