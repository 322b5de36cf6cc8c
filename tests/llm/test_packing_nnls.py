import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tokenloom.llm.packing import code_type, combinations, nnls, pack_documents, plan_rests

BYTE = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"))


def test_combinations_fill_the_window():
    kinds = combinations(32, 2)
    assert len(set(kinds)) == len(kinds) and all(sum(k) == 32 and sorted(k) == list(k) for k in kinds)
    assert len(kinds) == 1 + 15 + sum(1 for a in range(2, 17) for b in range(a, 32) if 32 - a - b >= b)


def test_nnls_meets_the_optimality_conditions():
    rnd = np.random.default_rng(1)
    for _ in range(5):
        a, b = rnd.random((12, 30)), rnd.random(12) * 5
        x = nnls(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and slope.max() < 1e-6 and abs(slope[x > 1e-9]).max() < 1e-5


HISTOGRAMS = {
    "empty": {}, "one": {5: 1}, "alike": {1500: 1000}, "tiny": {1: 5000}, "long": {2047: 70, 2041: 3}, "pairs": {1000: 400, 1048: 400},
    "mixed": {r: random.Random(r).randint(0, 40) for r in range(1, 2048)}, "tail": {r: 1 for r in range(1, 2048, 97)},
}


@pytest.mark.parametrize("name", HISTOGRAMS)
def test_plan_places_every_id_once(name):
    counts = np.zeros(2048, np.int64)
    for r, c in HISTOGRAMS[name].items():
        counts[r] = c
    plan = plan_rests(counts)
    covered, sequences = {}, {}
    for rest, lo, hi, first, last, each, slot, base in plan.rows:
        for rank in range(lo, hi):
            covered.setdefault((rest, rank), []).append((first, last))
            sequences.setdefault(base + (rank - lo) // each, {})[slot + (rank - lo) % each] = last - first
    assert set(covered) == {(r, k) for r, c in HISTOGRAMS[name].items() for k in range(c)}
    for (rest, _), spans in covered.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == rest and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert sorted(sequences) == list(range(plan.sequences))
    total = sum(r * c for r, c in HISTOGRAMS[name].items())
    for pieces in sequences.values():
        assert sorted(pieces) == list(range(len(pieces))) and sum(pieces.values()) <= 2048
    assert plan.sequences * 2048 - total <= max(2048, 0.02 * total)


def test_packed_documents(spark):
    rnd = random.Random(4)
    texts = [None, "", "one", "<|endoftext|> two"] + [" ".join(rnd.choice(["alpha", "beta", "gamma", "Δ"]) for _ in range(rnd.randint(1, 6000))) for _ in range(60)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(3, texts[3], 1), (None, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rest int").repartition(4)
    library = Tokenizer.from_file(BYTE[1])
    pieces = pack_documents(docs, *BYTE, end_id=1)
    got = pieces.collect()
    want = sorted([(i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t, _ in rows], key=repr)
    assert sum(len(ids) for _, ids in want) == sum(r.length for r in got)
    ids_of = dict(want)
    sequences = {}
    for r in got:
        assert r.ids == ids_of[r.doc_id][r.start : r.start + r.length] and r.length == len(r.ids) and r.doc_tokens == len(ids_of[r.doc_id])
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(n for _, n in spans) <= 2048
    per_doc = {}
    for r in got:
        per_doc.setdefault(r.doc_id, []).extend(range(r.start, r.start + r.length))
    for doc_id, places in per_doc.items():
        times = sum(i == doc_id for i, _, _ in rows)
        assert sorted(places) == sorted([*range(len(ids_of[doc_id]))] * times)
    sums = {(r.doc_id, r.start, r.ids_crc32) for r in pack_documents(docs, *BYTE, end_id=1, checksums=True).collect()}
    assert sums == {(r.doc_id, r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got}
    assert pack_documents(docs.limit(0), *BYTE, end_id=1).collect() == []


def test_ids_beyond_two_bytes(spark, tmp_path):
    """A larger vocabulary, or end id, takes four bytes an id; the ids are those of the library."""
    assert code_type(BYTE[1], 1).itemsize == 2 and code_type(BYTE[1], 70_000).itemsize == 4
    docs = spark.createDataFrame([(i, "some words " * i) for i in range(30)], "doc_id long, text string")
    library = Tokenizer.from_file(BYTE[1])
    whole = {}
    for r in pack_documents(docs, *BYTE, end_id=70_000).orderBy("doc_id", "start").collect():
        whole.setdefault(r.doc_id, []).extend(r.ids)
    assert whole == {i: library.encode("some words " * i, add_special_tokens=False).ids + [70_000] for i in range(30)}
