"""Quality by perplexity under an interpolated modified Kneser-Ney model of byte n-grams.

The model is trained on all trusted documents but a held-out fold, whose perplexities give each language its
threshold. A window of bytes is a number, so counts of all orders are tables of numbers, kept in shards by hash:
discounts, back-off weights and probabilities come from joins of these tables, one order upon the other, for
just those windows that occur in the documents. Documents lie in blocks by a hash of their id; a block gives
each of its distinct windows once, and gets each one's probability once. Neither counts nor windows pass through
the driver, which sees four numbers per order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import col, drop_staged, fresh, kept_names, staged, text_of, text_slices

#: Stands before a text, so that its first bytes have a context.
START = 1
#: Keeps something for windows not seen, also where few counts would give a discount of 0.
LEAST_DISCOUNT = 0.01


@dataclass(frozen=True)
class PerplexityRule:
    """A document is kept up to the ``quantile`` of its language's held-out trusted perplexities, times ``slack``.

    The default quantile is chosen by labelled documents: those trusted and held out that are kept against those of
    bad quality or toxic that go. One in ``fold`` trusted documents is held out. A language with fewer than ``least`` of
    them, ``n``, takes the median of its own times a ratio of quantile to median: its own ratio by ``n / least``, for the
    rest the one over all languages. A language without any takes the quantile over all. Blocks hold about
    ``block_bytes`` of text.
    """

    order: int = 5
    quantile: float = 0.975
    slack: float = 1.0
    fold: int = 5
    least: int = 30
    block_bytes: int = 32 << 20


def windows(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The window that ends at each byte of a run of texts, as a number, and the texts' ends in this list."""
    n = len(offsets) - 1
    lead = order - 1
    padded = np.full(len(data) + n * lead, START, np.uint64)
    sizes = np.diff(offsets)
    place = np.arange(len(data)) + np.repeat(np.arange(1, n + 1) * lead, sizes)
    padded[place] = data
    code = np.zeros(len(padded), np.uint64)
    for back in range(order):
        code[back:] |= padded[: len(padded) - back] << np.uint64(8 * back)
    return code[place].view(np.int64), np.cumsum(sizes)


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([c for _, c in held]), len(keys)).astype(np.int64)


def _held_out(ids: np.ndarray, fold: int) -> np.ndarray:
    """Whether a document is in the held-out fold: a fixed rule on its id."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(33)) % np.uint64(fold) == 0


def _counted(order: int, fold: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        trusted = right.column("doc_id").to_numpy()
        block, held = None, []
        for batch in left.to_batches():
            for rows, data, offsets in text_slices(iter([batch]), "text", 1 << 21):
                block = rows.column("block")[0].as_py()
                code, ends = windows(data, offsets, order)
                keys, inverse = np.unique(code, return_inverse=True)
                ids = rows.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
                counts = rows.column("doc_id").is_valid().to_numpy(zero_copy_only=False) & np.isin(ids, trusted) & ~_held_out(ids, fold)
                weight = np.repeat(counts, np.diff(np.concatenate([[0], ends])))
                held.append((keys, np.bincount(inverse, weight, len(keys))))
                if len(held) == 16:
                    held = [_merged(held)]
        keys, counts = _merged(held) if held else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return pa.table({"block": pa.array(np.full(len(keys), block or 0, np.int32)), "gram": pa.array(keys), "n": pa.array(counts)})

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block one row with the windows and log-probabilities that a task has of it, compressed."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def out() -> pa.RecordBatch:
        blobs = []
        for parts in held.values():
            grams, logs = (np.concatenate(x) for x in zip(*parts, strict=True))
            by = np.argsort(grams)
            blobs.append((zlib.compress(np.diff(grams[by], prepend=0).tobytes(), 1), logs[by].astype(np.float32).tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array([b[0] for b in blobs], pa.binary()), pa.array([b[1] for b in blobs], pa.binary())],
            names=["block", "grams", "logs"],
        )

    rows = 0
    for batch in batches:
        blocks, grams, logs = (batch.column(c).to_numpy() for c in ("block", "gram", "log"))
        order = np.argsort(blocks, kind="stable")
        cuts = np.flatnonzero(np.diff(blocks[order])) + 1
        for own in np.split(order, cuts):
            if len(own):
                held.setdefault(int(blocks[own[0]]), []).append((grams[own], logs[own]))
        rows += batch.num_rows
        if rows > 2_000_000:
            yield out()
            held.clear()
            rows = 0
    yield out()


def _scored(order: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        grams = [np.cumsum(np.frombuffer(zlib.decompress(g), np.int64)) for g in right.column("grams").to_pylist()]
        logs = [np.frombuffer(x, np.float32) for x in right.column("logs").to_pylist()]
        known, log = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (grams, logs))
        by = np.argsort(known)
        known, log = known[by], log[by].astype(np.float64)
        out = []
        for batch in left.to_batches():
            for rows, data, offsets in text_slices(iter([batch]), "text", 1 << 21):
                code, ends = windows(data, offsets, order)
                sums = np.concatenate([[0.0], np.cumsum(log[np.searchsorted(known, code)])]) if len(code) else np.zeros(1)
                edges = np.concatenate([[0], ends])
                sizes = np.diff(edges)
                total = sums[edges[1:]] - sums[edges[:-1]]
                out.append(
                    pa.table(
                        {
                            "doc_id": rows.column("doc_id"),
                            "mark": rows.column("mark"),
                            "lang": rows.column("lang"),
                            "n_bytes": pa.array(sizes),
                            "log_prob": pa.array(total),
                        }
                    )
                )
        return pa.concat_tables(out) if out else pa.table({n: pa.array([], t) for n, t in _SCORE_TYPES.items()})

    return run


_SCORES = "doc_id long, mark long, lang string, n_bytes long, log_prob double"
_SCORE_TYPES = {"doc_id": pa.int64(), "mark": pa.int64(), "lang": pa.string(), "n_bytes": pa.int64(), "log_prob": pa.float64()}


def _discounts(counts: DataFrame) -> list[float]:
    """The discounts of windows seen once, twice, and more often, from how many windows were seen how often."""
    seen = {r["n"]: r["count"] for r in counts.filter("n <= 4").groupBy("n").count().collect()}
    n = [0, *[seen.get(i, 0) for i in (1, 2, 3, 4)]]
    if not n[1] or not n[2]:
        return [0.5, 0.5, 0.5]
    y = n[1] / (n[1] + 2 * n[2])
    return [min(max(k - (k + 1) * y * n[k + 1] / n[k], LEAST_DISCOUNT), float(k)) if n[k] else k / 2 for k in (1, 2, 3)]


def probabilities(grams: DataFrame, order: int) -> DataFrame:
    """``gram, p`` for every row of ``grams`` (``gram, n``), from the counts ``n`` of those that were seen in training.

    The highest order counts occurrences, each lower one the distinct bytes that stand before its windows in the order above.
    Unseen windows and contexts fall back on the order below, the lowest on all 256 bytes alike.
    """
    made, wanted, counts = [], [grams.select("gram")], [staged(grams.filter("n > 0"), "counts")]
    for k in range(order - 1, 0, -1):
        short = F.col("gram").bitwiseAND((1 << (8 * k)) - 1).alias("gram")
        wanted.append(staged(wanted[-1].select(short).distinct(), "wanted"))
        counts.append(staged(counts[-1].select(short).groupBy("gram").agg(F.count("*").alias("n")), "counts"))
        made += [wanted[-1], counts[-1]]
    made.append(counts[0])
    below = None
    for k in range(1, order + 1):
        count = counts[order - k]
        d = _discounts(count)
        off = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        contexts = count.groupBy(F.shiftright("gram", 8).alias("context")).agg(
            F.sum("n").alias("total"), F.sum(off).alias("saved")
        )
        own = count.select(F.col("gram").alias("seen"), (F.col("n") - off).alias("rest"))
        asked = wanted[order - k].withColumn("context", F.shiftright("gram", 8))
        joined = asked.join(own, F.col("gram") == F.col("seen"), "left").join(contexts, "context", "left")
        joined = joined.withColumn("shorter", F.col("gram").bitwiseAND((1 << (8 * (k - 1))) - 1))
        lower = F.lit(1 / 256)
        if below is not None:
            joined = joined.join(below.select(F.col("gram").alias("shorter"), F.col("p").alias("lower")), "shorter")
            lower = F.col("lower")
        p = F.coalesce(F.col("rest") / F.col("total"), F.lit(0.0)) + F.coalesce(F.col("saved") / F.col("total"), F.lit(1.0)) * lower
        after = staged(joined.select("gram", p.alias("p")), "probabilities")
        if below is not None:
            drop_staged(below)
        below = after
    drop_staged(*made)
    return below


def scores(docs: DataFrame, trusted: DataFrame, rule: PerplexityRule) -> DataFrame:
    """``doc_id, mark, lang, n_bytes, log_prob`` of every row of ``docs`` (``doc_id, mark, lang, text``)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // rule.block_bytes))

    def block(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block")

    placed = docs.select(block(F.coalesce("doc_id", "mark")), *[F.col(c) for c in ("doc_id", "mark", "lang", "text")])
    known = trusted.select(block(F.col("doc_id")), "doc_id")
    by_block = placed.groupBy("block")
    counted = by_block.cogroup(known.groupBy("block")).applyInArrow(_counted(rule.order, rule.fold), "block int, gram long, n long")
    counted = staged(counted, "windows")
    grams = staged(counted.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    p = probabilities(grams, rule.order)
    logs = counted.join(p, "gram").select("block", "gram", F.log("p").alias("log"))
    packed = staged(logs.mapInArrow(_packed, "block int, grams binary, logs binary"), "block-logs")
    drop_staged(counted, grams, p)
    out = staged(by_block.cogroup(packed.groupBy("block")).applyInArrow(_scored(rule.order), _SCORES), "scores")
    drop_staged(packed)
    return out


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids whose labels all say good quality and not toxic."""
    every = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return every.filter("doc_id IS NOT NULL AND quality = 1 AND toxic = 0").select(F.col("doc_id").cast("long").alias("doc_id"))


def _mark(docs: DataFrame, text_col: str, lang_col: str) -> Column:
    return F.xxhash64(text_of(docs, text_col), col(docs, lang_col).cast("string"))


def classified(
    docs: DataFrame,
    labels: DataFrame,
    rule: PerplexityRule = PerplexityRule(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``doc_id, mark, lang, n_bytes, perplexity, threshold, kept`` of every row of ``docs``; ``mark`` is a hash of text and language.

    ``labels`` has ``doc_id, quality, toxic``. Null and empty texts have no perplexity and are not kept. A null language is
    one of its own. Without trusted documents every text has the same perplexity, 256, no threshold, and is kept. Repeated
    rows are judged alike, an empty table gives an empty one.
    """
    text = text_of(docs, text_col)
    picked = docs.select(
        col(docs, id_col).cast("long").alias("doc_id"), _mark(docs, text_col, lang_col).alias("mark"), col(docs, lang_col).cast("string").alias("lang"), text.alias("text")
    )
    trusted = staged(trusted_ids(labels), "trusted")
    found = scores(picked, trusted, rule).withColumn("perplexity", F.when(F.col("n_bytes") > 0, F.exp(-F.col("log_prob") / F.col("n_bytes"))))
    held = found.join(held_out(trusted, rule.fold), "doc_id", "left_semi").filter("perplexity IS NOT NULL")
    held = staged(held.select("lang", "perplexity"), "held-out")
    at, middle = (F.percentile_approx("perplexity", q, 100_000) for q in (rule.quantile, 0.5))
    overall = held.agg((at * rule.slack).alias("overall"))
    per_lang = held.groupBy(F.col("lang").alias("of")).agg(at.alias("own"), middle.alias("middle"), F.count("*").alias("n"))
    of_lang = F.col("lang").eqNullSafe(F.col("of"))
    # Few documents give a median well and a tail badly: the tail's ratio to the median is shared. Few rows, one per language.
    ratios = held.join(F.broadcast(per_lang), of_lang).select((F.col("perplexity") / F.col("middle")).alias("ratio"))
    ratio = ratios.agg(F.percentile_approx("ratio", rule.quantile, 100_000).alias("ratio"))
    share = F.least(F.lit(1.0), F.col("n") / rule.least)
    own = (share * F.col("own") + (1 - share) * F.col("middle") * F.col("ratio")) * rule.slack
    per_lang = per_lang.join(F.broadcast(ratio)).select("of", own.alias("own"))
    # One row, and one row per language.
    judged = found.join(per_lang, of_lang, "left").join(F.broadcast(overall))
    threshold = F.coalesce("own", "overall")
    kept = F.col("perplexity").isNotNull() & (threshold.isNull() | (F.col("perplexity") <= threshold))
    return judged.select("doc_id", "mark", "lang", "n_bytes", "perplexity", threshold.alias("threshold"), kept.alias("kept"))


def _fold_flags(fold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_held_out(batch.column("doc_id").to_numpy(), fold)))

    return run


def held_out(trusted: DataFrame, fold: int) -> DataFrame:
    return trusted.mapInArrow(_fold_flags(fold), "doc_id long")


def keep_fluent(docs: DataFrame, labels: DataFrame, rule: PerplexityRule = PerplexityRule(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, columns unchanged."""
    mark = fresh(docs, "_mark")[0]
    good = classified(docs, labels, rule, id_col, text_col, lang_col).filter("kept").select("doc_id", "mark").distinct()
    good = good.select(F.col("doc_id").alias("_good_id"), F.col("mark").alias("_good_mark"))
    marked = docs.withColumn(mark, _mark(docs, text_col, lang_col))
    same = col(marked, id_col).eqNullSafe(good["_good_id"]) & (marked[mark] == good["_good_mark"])
    return marked.join(good, same, "left_semi").select(*kept_names(docs))
