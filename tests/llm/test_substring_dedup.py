import random
import re

import pytest

from tokenloom.llm.substring_dedup import remove_repeats


def plain(rows, window):
    """(words, removed places) of every row, over all windows of all rows."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if d is not None and d < first.get(key, d + 1):
                first[key] = d
    out = []
    for (d, t), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        out.append((d, t, len(w), sorted(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def checked(docs, rows, out, window):
    got = []
    for r in docs.collect():
        places = [i for s in r[out].spans for i in range(s.start, s.end)]
        assert len(places) == r[out].n_removed and all(s.end - s.start >= window for s in r[out].spans)
        got.append((r.doc_id, r.text, r[out].n_words, places, " ".join(r[out].text.split())))
    assert sorted(got, key=repr) == sorted(plain(rows, window), key=repr)


@pytest.mark.parametrize("window, seed", [(13, 7), (5, 3), (13, 13)])
def test_removal_equals_brute_force(spark, window, seed):
    rnd = random.Random(window)
    word = lambda: f"w{rnd.randrange(50)}"
    passages = [[word() for _ in range(rnd.randint(3, 40))] for _ in range(12)]
    rows = [(900, None), (901, ""), (902, " \n"), (None, " ".join(passages[0] * 3)), (5, " ".join(passages[5])), (5, " ".join(passages[5]))]
    for i in range(150):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else [word() for _ in range(rnd.randint(0, 30))] for _ in range(rnd.randint(0, 5))]
        rows.append((rnd.randrange(200), "\t".join(w for p in parts for w in p)))
    rows += [(1000 + i, " ".join(passages[7] + passages[8])) for i in range(60)]  # a large group of copies
    big = [word() for _ in range(200_000)]
    rows += [(2000, " ".join(big)), (2001, " ".join([*big[:100_000], "new", *big[100_000:]]))]  # a megabyte each
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n int").repartition(4)
    done = remove_repeats(docs, window, seed)
    assert done.columns == ["doc_id", "text", "n", "deduped"]
    checked(done, rows, "deduped", window)


def test_clashing_names_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(1, text), (2, "x " + text)]
    taken = "doc_id long, text string, deduped string, _dedup_row_id int, _Dedup_Row_Text int, _dedup_row_list int"
    docs = spark.createDataFrame([(d, t, "own", 7, 8, 9) for d, t in rows], taken)
    done = remove_repeats(docs)
    assert done.columns == [*docs.columns, "_deduped"]
    assert {tuple(r)[2:6] for r in done.collect()} == {("own", 7, 8, 9)}
    checked(done, rows, "_deduped", 13)
    assert remove_repeats(docs.limit(0)).collect() == []
    assert remove_repeats(docs.select("doc_id", "text"), out="what").columns == ["doc_id", "text", "what"]
