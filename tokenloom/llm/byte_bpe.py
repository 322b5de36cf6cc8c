"""Byte-level BPE of a public tokenizer file, inside tasks."""

from __future__ import annotations

import base64
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Fixed values of the public byte-level vocabulary: its special token, and the pattern of its words.
END_TEXT, END_ID = "<|endoftext|>", 50256
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_RUN = 100_000
_LONG_SPACE = re.compile(rf"\s{{{_LONG_RUN}}}")


def task_cache() -> dict:
    """A dictionary that outlives a task: Python workers serve many tasks, and task code travels by value."""
    name = "_tokenloom_task_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


class ByteEncoder:
    """Ids as the vocabulary's own library gives them; ``ranks`` is the path of the file of ranks, ``vocabulary`` of the JSON."""

    def __init__(self, ranks: str, vocabulary: str):
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self._vocabulary, self._library = vocabulary, None

    def _whole(self, text: str) -> np.ndarray:
        """By the slower library, which is loaded where it is needed."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._vocabulary)
        return np.asarray(self._library.encode(text, add_special_tokens=False).ids, np.uint32)

    def ids(self, text: str) -> np.ndarray:
        """Ids of a whole text. Very long white space goes to the slower library, whose pattern search has no limit."""
        if len(text) >= _LONG_RUN and _LONG_SPACE.search(text):
            return self._whole(text)
        parts = text.split(END_TEXT)
        if len(parts) == 1:
            return self._fast.encode_to_numpy(text)
        out = []
        for i, part in enumerate(parts):
            out += [np.array([END_ID] * (i > 0), np.uint32), self._fast.encode_to_numpy(part)]
        return np.concatenate(out)


def encoder(ranks: str, vocabulary: str) -> ByteEncoder:
    cache = task_cache()
    if (ranks, vocabulary) not in cache:
        cache[ranks, vocabulary] = ByteEncoder(ranks, vocabulary)
    return cache[ranks, vocabulary]


def encoded_rows(
    batches: Iterator[pa.RecordBatch], text_slices, ranks: str, vocabulary: str, end_id: int, column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """For each run of rows: the rows, all their ids with the end id after each row, and n + 1 offsets."""
    enc = encoder(ranks, vocabulary)
    end = np.array([end_id], np.uint32)
    for rows, _, _ in text_slices(batches, column):
        parts = []
        for text in rows.column(column).to_pylist():
            parts += [enc.ids(text or ""), end]
        sizes = np.fromiter((len(parts[i]) + 1 for i in range(0, len(parts), 2)), np.int64, len(parts) // 2)
        yield rows, np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])


def id_lists(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(ids.astype(np.int32, copy=False))).cast(pa.list_(pa.int32()))
