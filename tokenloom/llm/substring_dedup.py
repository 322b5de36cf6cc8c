"""Removal of word sequences that an earlier document has, by seeds and their extension.

Of every run of seven successive 7-word sequences the one with the smallest hash is a seed (winnowing). Such
a run is a window of 13 words, so two documents with a common window have its seed in common, and a seed
that only one document has ends the matter there. Documents are joined on the seeds that several have. From such a
seed a match is extended both ways, to every window that the seed was chosen in: two documents match over a
window if they agree on all words before and after the seed in it. Matches are looked up by the hash of the extended
sequence, so that a passage in a third of all documents costs one row for each, and never a pair. Overlapping
windows join into maximal repeats, of at least 13 words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import (
    col,
    drop_staged,
    fresh,
    joined_hashes,
    staged,
    text_of,
    text_slices,
    window_hashes,
    word_hashes,
    word_spans,
)

WINDOW, SEED = 13, 7
# Names of working columns, unlike any in a table.
_ID, _TEXT, _LIST = "_dedup_row_id", "_dedup_row_text", "_dedup_row_list"


class Windows:
    """All windows of a run of rows: row, hash of the whole window, hash of its seed, first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, seed: int):
        self.starts, self.ends, self.firsts = word_spans(data, offsets)
        words = word_hashes(data, self.starts, self.ends)
        grams, span = window_hashes(words, seed), window - seed + 1
        n = max(0, len(words) - window + 1)
        if not n:
            self.row = self.at = np.zeros(0, np.int64)
            self.whole = self.seed = np.zeros(0, np.int64)
            return
        best = grams[:n].copy()
        for k in range(1, span):
            np.minimum(best, grams[k : k + n], out=best)
        # Sequences at either end of the window, and those between where the two leave words out.
        whole = words[:n].copy()
        for k in [*range(0, window - seed, seed), window - seed]:
            whole = joined_hashes(whole, grams[k : k + n])
        row = np.searchsorted(self.firsts, np.arange(n), "right") - 1
        inside = np.arange(n) + window <= self.firsts[row + 1]
        self.at = np.flatnonzero(inside)
        self.row, self.whole, self.seed = row[inside], whole[inside].view(np.int64), best[inside].view(np.int64)


def _pairs(row_ids: np.ndarray, row: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (id, key) pairs."""
    order = np.lexsort((keys, row))
    r, k = row[order], keys[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    return row_ids[r[new]], k[new]


def _seeds(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_slices(batches, _TEXT):
            found = Windows(data, offsets, window, seed)
            ids, keys = _pairs(rows.column(_ID).to_numpy(), found.row, found.seed)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], names=["key", _ID])

    return run


def _listed(lists: pa.ListArray, row: int) -> np.ndarray:
    """The sorted values of a row's list, none if it is null."""
    own = lists[row]
    return np.sort(own.values.to_numpy(zero_copy_only=False)) if own.is_valid else np.zeros(0, np.int64)


def _within(rows: pa.RecordBatch, row: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key is in the list of its row."""
    out, lists = np.zeros(len(keys), bool), rows.column(_LIST)
    ends = np.searchsorted(row, np.arange(rows.num_rows + 1))
    for i in range(rows.num_rows):
        if ends[i] < ends[i + 1] and lists[i].is_valid:
            own, mine = _listed(lists, i), keys[ends[i] : ends[i + 1]]
            if len(own):
                out[ends[i] : ends[i + 1]] = own[np.minimum(np.searchsorted(own, mine), len(own) - 1)] == mine
    return out


def _extended(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_slices(batches, _TEXT):
            found = Windows(data, offsets, window, seed)
            shared = _within(rows, found.row, found.seed)
            ids, keys = _pairs(rows.column(_ID).to_numpy(), found.row[shared], found.whole[shared])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], names=["key", _ID])

    return run


def repeated_windows(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """For each id the list of its windows that a smaller id has too. Null ids take no part."""
    docs = docs.filter(F.col(_ID).isNotNull()).select(_ID, _TEXT)
    seeds = docs.mapInArrow(_seeds(window, seed), f"key long, {_ID} long")
    shared = staged(_several(seeds).select("key"), "seeds")
    per_doc = seeds.join(shared, "key", "left_semi").groupBy(_ID).agg(F.collect_set("key").alias(_LIST))
    matches = staged(docs.join(per_doc, _ID).mapInArrow(_extended(window, seed), f"key long, {_ID} long"), "matches")
    first = _several(matches).select("key", F.col("lo").alias("first"))
    later = matches.join(first, "key").filter(F.col(_ID) > F.col("first"))
    out = staged(later.groupBy(_ID).agg(F.collect_set("key").alias(_LIST)), "repeats")
    drop_staged(shared, matches)
    return out


def _several(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(F.min(_ID).alias("lo"), F.max(_ID).alias("hi")).filter("lo < hi")


def _removed(window: int, seed: int, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_slices(batches, _TEXT):
            found = Windows(data, offsets, window, seed)
            gone = np.zeros(len(found.starts) + 1, np.int64)
            at = found.at[_within(rows, found.row, found.whole)]
            np.add.at(gone, at, 1)
            np.add.at(gone, at + window, -1)
            gone = np.cumsum(gone)[:-1] > 0
            texts, counts, lost, spans = [], [], [], []
            for i in range(rows.num_rows):
                lo, hi = int(found.firsts[i]), int(found.firsts[i + 1])
                own = gone[lo:hi]
                # Runs of kept and of removed words.
                edges = np.flatnonzero(np.diff(np.concatenate([[True], own, [True]]).astype(np.int8)))
                kept = [data[found.starts[lo + a] : found.ends[lo + b - 1]].tobytes() for a, b in zip(edges[::2], edges[1::2], strict=True)]
                texts.append(b" ".join(kept).decode())
                counts.append(hi - lo)
                lost.append(int(own.sum()))
                cuts = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(cuts[::2], cuts[1::2], strict=True)])
            struct = pa.StructArray.from_arrays(
                [
                    pa.array(texts, pa.string()),
                    pa.array(counts, pa.int64()),
                    pa.array(lost, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                names=["text", "n_words", "n_removed", "spans"],
            )
            keep = [n for n in rows.schema.names if n not in (_ID, _TEXT, _LIST)]
            yield pa.RecordBatch.from_arrays([*[rows.column(n) for n in keep], struct], names=[*keep, out])

    return run


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", out: str = "deduped"
) -> DataFrame:
    """All columns of ``docs`` and a struct ``out``: ``text, n_words, n_removed, spans``.

    A word goes if a window of ``window`` words that holds it also starts in a document with a smaller id; all
    windows are judged on the input. Words are runs of non-space characters, as they are. ``spans`` are the maximal
    removed runs as word numbers, ``text`` the kept runs, as they stood, joined by a space. Equal ids don't
    remove from each other, nulls and empty texts have no words, rows with a null id stay whole and remove nothing,
    an empty table gives an empty one. If ``docs`` has a column ``out``, the struct's name gets underscores in front, as
    :func:`~tokenloom.llm.common.fresh` tells; columns named like the working ones step aside meanwhile.
    """
    out = fresh(docs, out)[0]
    working = {_ID, _TEXT, _LIST}
    aside = dict(zip(docs.columns, docs.columns, strict=True))
    for c in docs.columns:
        if c.lower() in working:
            aside[c] = fresh(docs, *working, "_aside_" + c)[-1]
    keyed = docs.select(
        *[col(docs, c).alias(a) for c, a in aside.items()], col(docs, id_col).cast("long").alias(_ID), text_of(docs, text_col).alias(_TEXT)
    )
    joined = keyed.join(repeated_windows(keyed, window, seed), _ID, "left")
    schema = ", ".join(f"`{aside[c]}` {t}" for c, t in docs.dtypes)
    kinds = "struct<text: string, n_words: long, n_removed: long, spans: array<struct<start: long, end: long>>>"
    done = joined.mapInArrow(_removed(window, seed, out), f"{schema}, `{out}` {kinds}")
    return done.select(*[col(done, a).alias(c) for c, a in aside.items()], out)
