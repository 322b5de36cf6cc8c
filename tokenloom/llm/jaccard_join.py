"""Exact Jaccard join of documents on word n-grams, with prefix filters under several global orders.

Two sets whose Jaccard similarity is at least t share a token among the first ``n - ceil(t n) + 1`` tokens
of each, under any one order of all tokens. Candidates come from the order by rarity, where such prefixes
seldom meet; the pair must also meet in the prefixes under ascending and under descending hashes before its
sets are compared. With the place of a common token, the prefix shrinks to what the sizes of the two
sets allow.

Groups stay linear: equal sets are one class; every candidate is first compared with the smallest id that
shares its token, links make components, and only pairs between different components are compared after
that. No link between different components is left out, so the components are those of the whole join.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import col, drop_staged, staged, text_of, text_slices, window_hashes, word_hashes, word_spans
from tokenloom.llm.components import components

N_GRAM = 5
PERCENT = 80
#: Rarity is counted over all documents in this many hash buckets: 4 MB, whatever the corpus.
BUCKET_BITS = 20
_RANGES = 64
_FAN_IN = 64


def shingle_sets(batches: Iterator[pa.RecordBatch], n_gram: int) -> Iterator[tuple[object, np.ndarray]]:
    """``doc_id`` and the sorted distinct 64-bit hashes of every row's word n-grams."""
    for rows, data, offsets in text_slices(batches, "text"):
        starts, ends, firsts = word_spans(data, offsets)
        words = word_hashes(data, starts, ends, lower=True)
        for i, doc_id in enumerate(rows.column("doc_id").to_pylist()):
            own = words[firsts[i] : firsts[i + 1]]
            yield doc_id, np.unique(window_hashes(own, min(n_gram, len(own)))) if len(own) else own


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _facts(n_gram: int):
    """Size and signature of every set, and at the end how often the task saw each hash bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.uint32)
        held: list[tuple] = []
        for doc_id, tokens in shingle_sets(batches, n_gram):
            np.add.at(counts, (tokens >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), 1)
            sign = np.frombuffer(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest(), "<i8")
            held.append((doc_id, len(tokens), int(sign[0]), int(sign[1]), None, None, None))
            if len(held) == 5000:
                yield _fact_rows(held)
                held = []
        part, size = TaskContext.get().partitionId(), len(counts) // _RANGES
        for r in range(_RANGES):
            own = counts[r * size : (r + 1) * size]
            if own.any():
                held.append((None, None, None, None, r, part, zlib.compress(own.tobytes(), 1)))
        yield _fact_rows(held)

    return run


_FACTS = "doc_id long, n long, s1 long, s2 long, range int, part int, counts binary"
_FACT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
_FACT_NAMES = ["doc_id", "n", "s1", "s2", "range", "part", "counts"]


def _fact_rows(held: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*held, strict=True)) if held else [()] * len(_FACT_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _FACT_TYPES, strict=True)], names=_FACT_NAMES)


def _add_counts(key: tuple, rows: pa.Table) -> pa.Table:
    total = None
    for c in rows.column("counts").to_pylist():
        own = np.frombuffer(zlib.decompress(c), np.uint32)
        total = own.copy() if total is None else np.minimum(total.astype(np.uint64) + own, 2**32 - 1).astype(np.uint32)
    return pa.table(
        {
            "range": pa.array([key[0].as_py()], pa.int32()),
            "part": pa.array([key[1].as_py()], pa.int32()),
            "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary()),
        }
    )


def rarity(facts: DataFrame) -> np.ndarray:
    """How many sets have a token in each hash bucket. Tasks' counts are added in groups of bounded size."""
    counts = facts.filter("counts IS NOT NULL").select("range", "part", "counts")
    parts = (counts.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        grouped = counts.withColumn("part", F.floor(F.col("part") / _FAN_IN).cast("int")).groupBy("range", "part")
        counts = grouped.applyInArrow(_add_counts, "range int, part int, counts binary")
        parts = -(-parts // _FAN_IN)
    out = np.zeros(1 << BUCKET_BITS, np.uint32)
    size = len(out) // _RANGES
    for r in counts.collect():  # at most 64 rows, 4 MB in all
        out[r["range"] * size : (r["range"] + 1) * size] = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return out


def _prefixes(n_gram: int, percent: int, counts):
    """The rarest tokens of every set, with their places; a task gives equal sets once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare, seen, held, rows = counts.value, set(), [], 0
        for doc_id, tokens in shingle_sets(batches, n_gram):
            if doc_id is None or not len(tokens):
                continue
            sign = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
            if sign in seen:
                continue
            seen.add(sign)
            length = prefix_length(len(tokens), percent)
            order = np.lexsort((tokens, rare[(tokens >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]))[:length]
            held.append((doc_id, len(tokens), tokens[order]))
            rows += length
            if rows >= 200_000:
                yield _prefix_rows(held)
                held, rows = [], 0
        yield _prefix_rows(held)

    return run


def _prefix_rows(held: list[tuple]) -> pa.RecordBatch:
    sizes = [len(t) for _, _, t in held]
    tokens = np.concatenate([t for _, _, t in held]) if held else np.zeros(0, np.uint64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(tokens.view(np.int64)),
            pa.array(np.repeat(np.array([d for d, _, _ in held], np.int64), sizes)),
            pa.array(np.repeat(np.array([n for _, n, _ in held], np.int32), sizes)),
            pa.array(np.concatenate([np.arange(s, dtype=np.int32) for s in sizes]) if held else np.zeros(0, np.int32)),
        ],
        names=["token", "doc_id", "n", "place"],
    )


def _can_link(x: str, y: str, percent: int) -> Column:
    """Whether sizes and places of a shared token leave room for enough common tokens."""
    n, m = F.col(f"{x}.n").cast("long"), F.col(f"{y}.n").cast("long")
    least = F.ceil((n + m) * percent / F.lit(100 + percent) - 1e-9)
    sizes = (n * 100 >= m * percent) & (m * 100 >= n * percent)
    return sizes & (F.col(f"{x}.place") <= n - least) & (F.col(f"{y}.place") <= m - least)


def _sets(n_gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets, held = [], [], 0
        for doc_id, tokens in shingle_sets(batches, n_gram):
            ids.append(doc_id)
            sets.append(tokens.tobytes())
            held += len(sets[-1])
            if held > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["doc_id", "tokens"])
                ids, sets, held = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["doc_id", "tokens"])

    return run


def meets_in_prefixes(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """The prefix filters under ascending and under descending hashes, for sorted sets."""
    a, b = prefix_length(len(x), percent), prefix_length(len(y), percent)
    if len(np.intersect1d(x[:a], y[:b], assume_unique=True)) == 0:
        return False
    return len(np.intersect1d(x[-a:], y[-b:], assume_unique=True)) > 0


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for p, q in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                keep.append(meets_in_prefixes(x, y, percent) and linked(x, y, percent))
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], names=["a", "b"])

    return run


def verified(docs: DataFrame, pairs: DataFrame, n_gram: int, percent: int) -> DataFrame:
    """The links among distinct candidate ``pairs`` (a, b), written. Only documents in a pair have their sets made."""
    wanted = staged(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "candidates")
    sets = staged(docs.join(wanted, "doc_id", "left_semi").mapInArrow(_sets(n_gram), "doc_id long, tokens binary"), "sets")
    first = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x")), "a")
    both = first.join(sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y")), "b")
    links = staged(both.select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long").distinct(), "links")
    drop_staged(sets, wanted)
    return links


def ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def jaccard_components(
    docs: DataFrame, n_gram: int = N_GRAM, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    Words are runs of non-space characters with A-Z folded; a set holds the distinct ``n_gram``-word windows, or the
    whole sequence of a shorter text. Two documents link at ``100 * common >= percent * union``; a component is named by
    its smallest id. Null, empty and blank texts have no set and are alone. Rows with a null id have a null component
    and take part in nothing. Rows that repeat an id count as texts of one document. An empty table gives an empty
    one; other columns are not read.
    """
    docs = docs.select(col(docs, id_col).cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    facts = staged(docs.mapInArrow(_facts(n_gram), _FACTS), "facts")
    counts = docs.sparkSession.sparkContext.broadcast(rarity(facts))
    own = facts.filter("counts IS NULL").select("doc_id", "n", "s1", "s2")
    sized = own.filter("n > 0 AND doc_id IS NOT NULL")
    classes = sized.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"))
    member = staged(sized.select("doc_id", "s1", "s2").distinct().join(classes, ["s1", "s2"]).select("doc_id", "rep"), "classes")

    tokens = staged(docs.mapInArrow(_prefixes(n_gram, percent, counts), "token long, doc_id long, n int, place int"), "prefixes")
    shared = tokens.groupBy("token").count().filter("count > 1").select("token")
    # Copies that different tasks have seen fall together here.
    met = tokens.join(shared, "token", "left_semi").join(member, "doc_id")
    rows = staged(met.groupBy("token", "rep", "n").agg(F.min("place").alias("place")), "shared-prefixes")
    drop_staged(tokens)

    leads = rows.groupBy("token").agg(F.min(F.struct("rep", "n", "place")).alias("y")).select("token", "y.rep", "y.n", "y.place")
    with_lead = rows.alias("x").join(leads.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.rep") != F.col("y.rep")))
    pairs = with_lead.filter(_can_link("x", "y", percent)).select(*ordered(F.col("x.rep"), F.col("y.rep"))).distinct()
    pairs = staged(pairs, "lead-pairs")
    links = verified(docs, pairs, n_gram, percent)
    known = components(links)

    labelled = rows.join(known, F.col("rep") == F.col("node"), "left").select(
        "token", "rep", "n", "place", F.coalesce("component", "rep").alias("component")
    )
    mixed = labelled.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = mixed.filter("lo < hi").select("token")
    labelled = staged(labelled.join(mixed, "token", "left_semi"), "mixed-prefixes")
    # Documents of one component with one size and place stand together: their pairs are made only where they pass.
    kinds = labelled.select("token", "component", "n", "place").distinct()
    x, y = kinds.alias("x"), kinds.alias("y")
    apart = (F.col("x.token") == F.col("y.token")) & (F.col("x.component") < F.col("y.component"))
    fit = x.join(y, apart & _can_link("x", "y", percent)).select(
        F.col("x.token").alias("token"), *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "xy" for c in ("component", "n", "place")]
    )
    fit = staged(fit, "cross-kinds")
    for s in "xy":
        side = labelled.select("token", F.col("rep").alias(f"{s}_rep"), *[F.col(c).alias(f"{s}_{c}") for c in ("component", "n", "place")])
        fit = fit.join(side, ["token", f"{s}_component", f"{s}_n", f"{s}_place"])
    cross = fit.select(*ordered(F.col("x_rep"), F.col("y_rep"))).distinct().join(pairs, ["a", "b"], "left_anti")
    more = verified(docs, staged(cross, "cross-pairs"), n_gram, percent)
    drop_staged(rows, labelled)
    # An id that repeats with other texts belongs to the classes of all of them.
    again = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b")
    several = member.join(again.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    final = components(links.union(more).union(several))

    named = member.groupBy("doc_id").agg(F.min("rep").alias("rep")).join(final, F.col("rep") == F.col("node"), "left")
    named = named.select(F.col("doc_id").alias("id"), F.coalesce("component", "rep").alias("component"))
    return own.join(named, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, n_gram: int = N_GRAM, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of each component, and those with a null id; columns unchanged."""
    found = jaccard_components(docs, n_gram, percent, id_col, text_col)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, col(docs, id_col) == gone["_gone"], "left_anti")
