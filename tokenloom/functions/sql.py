"""A tokenizer as SQL functions of a session."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from tokenloom.functions.text import normalizer
from tokenloom.operators.encoding import word_encoder
from tokenloom.operators.vocabulary import Tokenizer
from tokenloom.operators.words import WORD_PATTERN


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_tokenizer(spark: SparkSession, tokenizer: Tokenizer, prefix: str = "bpe") -> None:
    """Make ``<prefix>_encode(text)``, ``<prefix>_encode_line(text)`` (with BOS and EOS), ``<prefix>_decode(ids)``
    (without tokens that read like special ones) and ``<prefix>_token(id)`` temporary functions of the session.

    They are SQL functions over built-in ones and one Arrow function for the merges, so the optimizer sees through them: a
    query has the plan of the DataFrame operators. Null gives null; an id without a token reads as the UNK token. Functions
    of the same names are replaced, so several tokenizers need prefixes of their own. Spark 4.1's optimizer refuses a SELECT
    with several of them straight over a UNION; read the union from a table, or call one function a SELECT.
    """
    if not prefix.isidentifier():
        raise ValueError(f"not a name for SQL functions: {prefix!r}")
    cfg = tokenizer.config
    spark.udf.register(f"{prefix}_word_ids", word_encoder(spark, tokenizer))
    text = "text"
    if cfg.unicode_normalizer is not None:
        spark.udf.register(f"{prefix}_normalize", normalizer(cfg.unicode_normalizer))
        # Pure ASCII texts (as many bytes as characters) are never sent to Python.
        text = f"coalesce({prefix}_normalize(CASE WHEN octet_length(text) <> char_length(text) THEN text END), text)"
    if cfg.lowercase:
        text = f"lower({text})"
    by_id = tokenizer.tokens
    listed = f"from_json({_literal(json.dumps([by_id.get(i) for i in range(max(by_id) + 1)]))}, 'array<string>')"
    unk = _literal(cfg.special_tokens["<unk>"])
    tokens = f"transform(ids, i -> coalesce(get({listed}, i), {unk}))"
    special = f"array({', '.join(map(_literal, cfg.special_tokens.values()))})"
    words = f"regexp_extract_all({text}, {_literal(WORD_PATTERN)}, 0)"
    functions = {
        "encode(text STRING)": ("ARRAY<INT>", f"{prefix}_word_ids({words})"),
        "encode_line(text STRING)": ("ARRAY<INT>", f"concat(array({tokenizer.bos_id}), {prefix}_encode(text), array({tokenizer.eos_id}))"),
        "token(id INT)": ("STRING", f"coalesce(get({listed}, id), CASE WHEN id IS NOT NULL THEN {unk} END)"),
        "decode(ids ARRAY<INT>)": ("STRING", f"array_join(filter({tokens}, t -> NOT array_contains({special}, t)), '')"),
    }
    for name, (kind, body) in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}_{name} RETURNS {kind} RETURN {body}")
