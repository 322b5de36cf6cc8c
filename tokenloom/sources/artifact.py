"""The tokenizer on disk: Parquet tables ``vocab``, ``merges`` and ``meta`` under one path, or one JSON file as others keep it."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import asdict, fields

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from tokenloom.config import TokenizerConfig
from tokenloom.operators.vocabulary import Merge, Tokenizer, TokenizerError, VocabEntry
from tokenloom.staging import write_bytes


def save_tokenizer(spark: SparkSession, tokenizer: Tokenizer, path: str) -> None:
    """Pair halves have columns of their own, so any token survives, commas included."""
    config = dict(asdict(tokenizer.config), special_tokens=list(tokenizer.config.special_tokens.items()))
    tokenizer.vocab_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
    tokenizer.merge_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")
    spark.createDataFrame([(json.dumps(config),)], "config string").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/meta"
    )


def load_tokenizer(spark: SparkSession, path: str) -> Tokenizer:
    try:
        config = json.loads(spark.read.parquet(f"{path}/meta").first()["config"])
        merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
        vocab = spark.read.parquet(f"{path}/vocab").collect()
    except (PySparkException, TypeError, ValueError) as e:
        raise TokenizerError(f"no tokenizer can be read at {path}: {e}") from e
    config["special_tokens"] = dict(config["special_tokens"])
    entries = sorted((VocabEntry(r.token, r.id, r.kind) for r in vocab), key=lambda e: (e.kind == "alias", e.id))
    return Tokenizer(
        TokenizerConfig(**config),
        tuple(Merge(r.rank, r.left, r.right, r.merged, r.pair_freq) for r in merges),
        tuple(entries),
    )


def export_json(spark: SparkSession, tokenizer: Tokenizer, path: str) -> None:
    """Write one JSON file of ``config``, ``vocab`` (``token_to_id``, ``id_to_token``, ``special_tokens``) and ``merges``.

    A merge is named by its halves with a comma between them. The file is the size of the vocabulary and goes through
    Spark's file systems, so ``path`` may lie in any store that they reach. An existing file is replaced.
    """
    names = {f.name for f in fields(TokenizerConfig)} - {"dense_ids"}
    config = {k: v for k, v in asdict(tokenizer.config).items() if k in names}
    state = {
        "config": config,
        "vocab": {
            "token_to_id": tokenizer.ids,
            "id_to_token": {str(i): t for i, t in tokenizer.tokens.items()},
            "special_tokens": dict(tokenizer.config.special_tokens),
        },
        "merges": {f"{m.left},{m.right}": m.merged for m in tokenizer.merges},
    }
    write_bytes(spark, path, json.dumps(state, ensure_ascii=False, indent=2).encode())


def halves(name: str, merged: str, known: Mapping[str, int]) -> tuple[str, str]:
    """The two halves of a merge ``name``, of which one comma was put between them.

    Commas can be tokens too, so the right one is that whose removal leaves ``merged`` and whose sides are both among the
    ``known`` tokens with their places: of several, the one whose later side was known first.
    """
    fits = []
    for at in (i for i, c in enumerate(name) if c == ","):
        left, right = name[:at], name[at + 1 :]
        if left + right == merged and left in known and right in known:
            fits.append((max(known[left], known[right]), at, left, right))
    if not fits:
        raise TokenizerError(f"the merge {name!r} has no two halves in the vocabulary that make {merged!r}")
    return min(fits)[2:]


def import_json(spark: SparkSession, path: str) -> Tokenizer:
    """The tokenizer of a file as :func:`export_json` writes it; ids stay as they are, merge counts are unknown (0)."""
    try:
        state = json.loads(spark.read.text(path, wholetext=True).first()["value"])
        vocab, given = state["vocab"], {f.name for f in fields(TokenizerConfig)} - {"dense_ids", "special_tokens"}
        special = vocab["special_tokens"]
        ids = {str(t): int(i) for t, i in vocab["token_to_id"].items()}
        merged = {str(k): str(v) for k, v in state["merges"].items()}
        config = {k: v for k, v in state["config"].items() if k in given}
    except (PySparkException, KeyError, TypeError, ValueError, AttributeError) as e:
        raise TokenizerError(f"no tokenizer can be read at {path}: {e}") from e
    known = {t: n for n, t in enumerate(sorted(ids, key=lambda t: (t in special, ids[t])))}
    merges = [Merge(rank, *halves(k, v, known), v, 0) for rank, (k, v) in enumerate(merged.items())]
    made = set(merged.values())

    def kind(token: str) -> str:
        if token in special:
            return "alias" if token not in special.values() else "special"
        return "special" if token in special.values() else "merge" if token in made else "char"

    entries = [VocabEntry(t, ids[t], kind(t)) for t in known]
    dense = sorted(e.id for e in entries if e.kind != "alias") == list(range(sum(e.kind != "alias" for e in entries)))
    return Tokenizer(TokenizerConfig(**config, special_tokens=special, dense_ids=dense), tuple(merges), tuple(entries))


def reuse_tokenizer(
    spark: SparkSession, path: str, train: Callable[[], Tokenizer] | None = None
) -> Tokenizer:
    """The tokenizer at ``path`` if it loads; else train one, save it there and return it.

    Without ``train`` a missing tokenizer is an error.
    """
    try:
        return load_tokenizer(spark, path)
    except TokenizerError:
        if train is None:
            raise
    tokenizer = train()
    save_tokenizer(spark, tokenizer, path)
    return tokenizer
