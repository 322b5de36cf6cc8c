import json
import random
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import plain
from tokenloom.config import TokenizerConfig
from tokenloom.functions.sql import register_tokenizer
from tokenloom.functions.text import normalized, unicode_normalize
from tokenloom.operators import encoding as enc
from tokenloom.operators import merges as mg
from tokenloom.operators import words as wd
from tokenloom.operators.vocabulary import Merge, Tokenizer, TokenizerError, id_to_token, special_token_ids, token_to_id
from tokenloom.sources.artifact import export_json, import_json, load_tokenizer, reuse_tokenizer, save_tokenizer

GOLDEN = ["low lower lowest", "low low new"]
CFG = TokenizerConfig(vocab_size=20, min_frequency=1)


def by_hand(pairs, chars, **cfg):
    merges = [Merge(i, l, r, l + r, 1) for i, (l, r) in enumerate(pairs)]
    return Tokenizer.build(TokenizerConfig(**cfg), sorted(chars), merges)


@pytest.fixture(scope="module")
def golden(spark):
    rows = [(0, i, t) for i, t in enumerate(GOLDEN)]
    return mg.train_tokenizer(spark.createDataFrame(rows, "doc_id long, line_no int, text string"), CFG)


def test_pretokens_match_the_regex_module(as_lines):
    rng = random.Random(3)
    letters = "ab'sdtm lévr9 \t\n \x1c.,-!٠Ａ\U0001f600x"
    texts = ["".join(rng.choice(letters) for _ in range(30)) for _ in range(300)]
    rows = wd.pretokenize(as_lines(texts)).orderBy("line_no", "pos").collect()
    got = [[r.word for r in rows if r.line_no == i] for i in range(0, 300, 7)]
    assert got == [plain.words(texts[i]) for i in range(0, 300, 7)]


def test_word_counts_and_first_occurrence(as_lines):
    counts = wd.word_counts(as_lines(GOLDEN, doc_id=9)).select("word", "freq", *wd.order_parts(F.col("first")))
    got = {r.word: (r.freq, r.doc_id, r.line_no, r.pos) for r in counts.collect()}
    assert got == {
        "low": (2, 9, 0, 0), " lower": (1, 9, 0, 1), " lowest": (1, 9, 0, 2), " low": (1, 9, 1, 1), " new": (1, 9, 1, 2),
    }


def test_order_keys_hold_the_largest_ids(spark):
    rows = [(2**63 - 1, 2**35 - 1, 2**27 - 1), (2**63 - 1, 2**35 - 1, 2**27 - 2), (-(2**63), 0, 0), (-5, 2**31 + 7, 3), (0, 0, 1)]
    df = spark.createDataFrame(rows, "d long, l long, p int")
    key = wd.order_key(F.col("d"), F.col("l"), F.col("p")).alias("key")
    out = df.select(key).orderBy("key").select(*wd.order_parts(F.col("key"))).collect()
    assert [tuple(r) for r in out] == sorted(rows)


def test_golden_merges_and_ids(golden):
    assert [(m.left, m.right, m.pair_freq) for m in golden.merges] == [
        ("l", "o", 5), ("lo", "w", 5), (" ", "low", 3), (" low", "e", 2), (" lowe", "r", 1), (" lowe", "s", 1), (" lowes", "t", 1),
    ]
    chars = [e.token for e in golden.vocab if e.kind == "char"]
    assert chars == list(" elnorstw")
    assert [e.id for e in golden.vocab if e.kind != "alias"] == list(range(20))
    sparse = Tokenizer.build(TokenizerConfig(vocab_size=20, dense_ids=False), chars, golden.merges)
    assert [e.id for e in sparse.vocab if e.kind in ("char", "merge")] == list(range(8, 24))
    assert len(sparse) == len(golden) == 20


def test_min_frequency_two_keeps_only_low(as_lines):
    out = mg.train_tokenizer(as_lines(GOLDEN), TokenizerConfig(vocab_size=20, min_frequency=2))
    assert [(m.left, m.right, m.pair_freq) for m in out.merges] == [("l", "o", 2), ("lo", "w", 2)]


def prefix_training(texts, size, min_frequency, head_limit):
    """The round rule of training, run over plain counts."""
    from collections import Counter

    freq = Counter(w for t in texts for w in plain.words(t))
    kept = {w: list(w) for w, n in freq.items() if n >= min_frequency}
    tokens, rules, rounds = {c for w in kept for c in w}, [], 0
    while 4 + len(tokens) < size:
        counts = Counter()
        for w, symbols in kept.items():
            for pair in zip(symbols, symbols[1:]):
                counts[pair] += freq[w]
        if not counts:
            break
        rounds += 1
        ranked = [mg._Ranked(*p, n) for p, n in sorted(counts.items(), key=lambda kv: -kv[1])][:head_limit]
        for pair in mg.independent_prefix(ranked, tokens):
            if 4 + len(tokens) >= size:
                break
            rules.append((pair.left, pair.right, pair.freq))
            tokens.add(pair.left + pair.right)
            kept = {w: plain.join_pair(s, pair.left, pair.right) for w, s in kept.items()}
    return rules, rounds


def test_several_merges_a_round_equal_one_at_a_time():
    rng = random.Random(11)
    saved = 0
    for case in range(400):
        letters = "abcdefgh"[: rng.randrange(1, 9)]
        texts = [
            " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 30)))
            for _ in range(rng.randrange(1, 4))
        ]
        size, least = rng.randrange(5, 70), rng.choice([1, 1, 2])
        expected = plain.learn(texts, size, least)[1]
        got, rounds = prefix_training(texts, size, least, 64)
        assert got == expected, case
        saved += len(expected) - rounds
    assert saved > 500


def test_training_equals_the_plain_trainer(as_lines):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeé\U0001f600") for _ in range(rng.randrange(1, 8))) for _ in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=20)) + "..., aaaa\x01\x02\x00b" for _ in range(25)]
    tok = mg.train_tokenizer(as_lines(texts), TokenizerConfig(vocab_size=140, min_frequency=2))
    chars, rules = plain.learn(texts, 140, 2)
    assert [e.token for e in tok.vocab if e.kind == "char"] == chars
    assert [(m.left, m.right, m.pair_freq) for m in tok.merges] == rules


@pytest.mark.parametrize("head", [2048, 9])
def test_rounds_touch_only_words_that_a_merge_rewrites(as_lines, monkeypatch, head):
    """600 merges equal those of the plain trainer; the words looked at are those whose symbols change, and no others."""
    monkeypatch.setattr(mg, "_HEAD", head)
    rng = random.Random(8)
    n, size = (600, 640) if head == 2048 else (60, 100)
    letters = "etaoinshrdlucm"
    vocabulary = sorted({"".join(rng.choice(letters[: rng.randrange(2, 15)]) for _ in range(rng.randrange(1, 12))) for _ in range(n)})
    texts = [" ".join(rng.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=200)) for _ in range(15)]
    words, rounds = wd.word_filter(wd.word_counts(as_lines(texts)), CFG), []
    tok = mg.train_from_words(words, TokenizerConfig(vocab_size=size, min_frequency=1), rounds)
    rules = plain.learn(texts, size)[1]
    assert [(m.left, m.right, m.pair_freq) for m in tok.merges] == rules and len(rules) >= 0.9 * n
    kept = {w: list(w) for t in texts for w in plain.words(t)}
    known, at = {c for s in kept.values() for c in s}, 0
    for r in rounds[:-1]:
        own, before = rules[at : at + r.merges], kept
        made = {a + b for a, b, _ in own}
        for a, b, _ in own:
            kept = {w: plain.join_pair(s, a, b) for w, s in kept.items()}
        # A symbol that another merge had made before is counted anew wherever it stands.
        again = made & known
        assert r.touched == sum(kept[w] != before[w] or bool(again & set(kept[w])) for w in kept)
        known |= made
        at += r.merges
    assert len(rounds) < len(rules) and sum(r.head_read for r in rounds) <= (3 if head == 2048 else len(rounds))
    assert sum(r.touched for r in rounds) < 0.5 * len(kept) * len(rounds)


def test_pair_operators_step_by_step(as_lines):
    words = mg.word_symbols(wd.word_filter(wd.word_counts(as_lines(GOLDEN)), CFG))
    top = mg.best_pair(mg.pair_counts(words)).first()
    assert (top.left, top.right, top.freq, top.i) == ("l", "o", 5, 0)
    merged = mg.apply_merge(words, [("l", "o"), ("lo", "w")])
    symbols = {r.word: r.s for r in merged.select("word", mg.symbol_list(F.col("symbols")).alias("s")).collect()}
    assert symbols[" lowest"] == [" ", "low", "e", "s", "t"]


def test_leftmost_pair_wins_over_rank():
    pairs = {("b", "c"): "bc", ("a", "b"): "ab"}
    assert enc.split_word("abc", pairs) == ["ab", "c"]
    rng = random.Random(1)
    for _ in range(4000):
        known = {("".join(rng.choices("ab", k=rng.randrange(1, 3))), "".join(rng.choices("ab", k=rng.randrange(1, 3)))) for _ in range(6)}
        word = "".join(rng.choices("abc", k=rng.randrange(0, 12)))
        assert enc.split_word(word, {p: p[0] + p[1] for p in known}) == plain.encode_word(word, known)


def test_golden_encoding(as_lines, golden):
    sparse = Tokenizer.build(TokenizerConfig(vocab_size=20, dense_ids=False), list(" elnorstw"), golden.merges)
    out = enc.encode_documents(as_lines(["low newest z"]), sparse).first().input_ids
    assert out == [18, 8, 11, 9, 16, 9, 14, 15, 8, 1]
    words = as_lines(["low", " newest"]).withColumnRenamed("text", "word")
    assert [r.tokens for r in enc.encode_words(words, sparse).orderBy("line_no").collect()] == [
        ["low"], [" ", "n", "e", "w", "e", "s", "t"],
    ]


def test_encoding_rows_of_every_shape(spark, golden):
    texts = ["", None, "low", "low newest " * 500, "\n", "ﬁ low"] * 40
    lines = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "doc_id long, line_no int, text string")
    import unicodedata

    ids, pairs = golden.ids, {(m.left, m.right) for m in golden.merges}
    out = enc.encode_documents(lines.repartition(3), golden).orderBy("doc_id").collect()
    for row, text in zip(out, texts):
        if text is None:
            assert row.input_ids is None
            continue
        parts = [t for w in plain.words(unicodedata.normalize("NFKC", text)) for t in plain.encode_word(w, pairs)]
        assert row.input_ids == [ids.get(t, 1) for t in parts]


@pytest.mark.parametrize(
    "options, ids, mask",
    [
        ({}, [2, 10, 11, 12, 3], [1] * 5),
        ({"max_length": 4, "truncation": True}, [2, 10, 11, 12], [1] * 4),
        ({"max_length": 3, "truncation": True}, [2, 10, 3], [1] * 3),
        ({"max_length": 7, "padding": True}, [2, 10, 11, 12, 3, 0, 0], [1, 1, 1, 1, 1, 0, 0]),
        ({"max_length": 2, "truncation": True, "add_special_tokens": False}, [10, 11], [1, 1]),
        ({"max_length": 4}, [2, 10, 11, 12], [1] * 4),
    ],
)
def test_encode_options(as_lines, options, ids, mask):
    tok = by_hand([("x", "y")], "abcdefghi")
    content = "".join(tok.tokens[i] for i in (10, 11, 12))
    row = enc.encode_texts(as_lines([content]), tok, return_attention_mask=True, **options).first()
    assert (row.input_ids, row.attention_mask) == (ids, mask)


def test_untrained_is_refused(as_lines):
    with pytest.raises(TokenizerError):
        enc.encode_documents(as_lines(["a"]), by_hand([], "ab"))


def test_decode_and_lookups(spark, as_lines, golden):
    ids = spark.createDataFrame([([2, 17, 4, 999, 3],)], "input_ids array<int>")
    kept, skipped = (enc.decode_ids(ids, golden, s).first().text for s in (False, True))
    assert kept == "[BOS]" + golden.tokens[17] + " [UNK][EOS]"
    assert skipped == golden.tokens[17] + " "
    tokens = spark.createDataFrame([("low",), ("<eos>",), ("[EOS]",), ("nope",)], "token string")
    assert {r.token: r.id for r in token_to_id(tokens, golden).collect()} == {
        "low": golden.ids["low"], "<eos>": 3, "[EOS]": 3, "nope": 1,
    }
    back = id_to_token(spark.createDataFrame([(3,), (-1,), (50,)], "id int"), golden)
    assert {r.id: r.token for r in back.collect()} == {3: "[EOS]", -1: "[UNK]", 50: "[UNK]"}
    assert {r.alias: r.id for r in special_token_ids(golden.vocab_table(spark)).collect()} == {
        "<pad>": 0, "<unk>": 1, "<bos>": 2, "<eos>": 3,
    }
    check = enc.roundtrip_check(as_lines(["low new", "low z"]), golden).first()
    assert (check.lines, check.unchanged) == (2, 1)


def test_artifact_round_trip_keeps_commas(spark, tmp_path):
    tok = by_hand([(" ", ","), (",", "'")], " ,'", dense_ids=False)
    save_tokenizer(spark, tok, f"{tmp_path}/tok")
    assert load_tokenizer(spark, f"{tmp_path}/tok") == tok


def test_json_files_of_others(spark, tmp_path, golden):
    """A file by hand, with a hole for each alias and merges over commas; then out and in again, and the same ids for all documents."""
    special = dict(TokenizerConfig().special_tokens)
    names = [*special.values(), *special, *" ,abx", "a,", ",b", ",,", "a,b", "xa"]
    order = [t for t in names if t not in special]
    ids = {t: i + (4 if t not in special.values() else 0) for i, t in enumerate(order)} | {a: order.index(t) for a, t in special.items()}
    merges = {"a,,": "a,", ",,b": ",b", ",,,": ",,", "a,,,b": "a,,b", "a,b": "ab", "a,,b": "a,b", "x,a": "xa"}
    ids |= {"a,,b": 40, "ab": 41}
    state = {"config": {"vocab_size": 60, "min_frequency": 2, "cache_capacity": 9, "special_tokens": special}, "merges": merges,
             "vocab": {"token_to_id": ids, "id_to_token": {str(i): t for t, i in ids.items() if t not in special}, "special_tokens": special}}
    (tmp_path / "old.json").write_text(json.dumps(state))
    tok = import_json(spark, f"{tmp_path}/old.json")
    pairs = [(m.left, m.right) for m in tok.merges]
    assert pairs[:3] == [("a", ","), (",", "b"), (",", ",")] and pairs[4:] == [("a", "b"), ("a,", "b"), ("x", "a")]
    assert pairs[3] == ("a,", ",b") and tok.ids == ids and not tok.config.dense_ids and tok.config.vocab_size == 60
    for given_ in (tok, golden):
        export_json(spark, given_, f"{tmp_path}/new/file.json")
        back = import_json(spark, f"{tmp_path}/new/file.json")
        assert (back.ids, back.tokens, back.config) == (given_.ids, given_.tokens, given_.config)
        assert [(m.left, m.right, m.merged) for m in back.merges] == [(m.left, m.right, m.merged) for m in given_.merges]
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.lower("text").alias("text"))
        one, two = (enc.encode_documents(docs, t) for t in (given_, back))
        assert one.exceptAll(two).count() == 0
    for broken in ("{", '{"config": {}}', json.dumps({**state, "merges": {"p,q": "pq"}})):
        (tmp_path / "bad.json").write_text(broken)
        with pytest.raises(TokenizerError):
            import_json(spark, f"{tmp_path}/bad.json")
    with pytest.raises(TokenizerError):
        import_json(spark, f"{tmp_path}/none.json")


def test_sql_functions_equal_the_operators(spark, tmp_path, golden):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "ﬁ low 'quoted' \\ back")], "doc_id long, text string"))
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    docs.createOrReplaceTempView("sql_docs")
    register_tokenizer(spark, golden, "gold")
    out = spark.sql("SELECT doc_id, gold_encode(text) AS input_ids, gold_encode_line(text) AS line, gold_decode(gold_encode_line(text)) AS back FROM sql_docs")
    got = {r.doc_id: (r.input_ids, r.line, r.back) for r in out.collect()}
    want = {r.doc_id: r.input_ids for r in enc.encode_documents(docs, golden).collect()}
    lines = enc.encode_texts(docs, golden)
    text = {r.doc_id: (r.input_ids, r.text) for r in enc.decode_ids(lines, golden).collect()}
    assert got == {d: (want[d], *text[d]) for d in want}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("gold_word_ids(") == 1  # encoded once for all three
    assert [r.t for r in spark.sql("SELECT gold_token(id) AS t FROM VALUES (2), (-5), (NULL) AS v(id)").collect()] == ["[BOS]", "[UNK]", None]
    with pytest.raises(ValueError):
        register_tokenizer(spark, golden, "no name")


def test_reuse(spark, tmp_path, golden):
    path, calls = f"{tmp_path}/tok", []
    with pytest.raises(TokenizerError):
        reuse_tokenizer(spark, path)

    def fit():
        calls.append(1)
        return golden

    assert reuse_tokenizer(spark, path, fit) == reuse_tokenizer(spark, path, fit) == golden
    assert calls == [1]


def test_nfkc(as_lines):
    rows = as_lines(["ﬁne ① Ａ", "plain", None]).select("line_no", unicode_normalize(F.col("text")).alias("t"))
    assert [r.t for r in rows.orderBy("line_no").collect()] == ["fine 1 A", "plain", None]


def test_distinct_words_are_split_after_they_are_made_distinct(spark, golden):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "0 AS line_no", "text")
    words = wd.word_counts(docs).select("word")
    out = enc.encode_words(words, golden).select(F.explode("tokens").alias("token")).distinct()
    out.collect()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # Read from the top: the Python function comes before the aggregate over the words, and once.
    made = [line for line in plan.splitlines() if "ArrowEvalPython" in line or "Aggregate [word" in line]
    assert len(made) == 2 and "ArrowEvalPython" in made[0], plan


def test_a_worker_keeps_few_words_and_few_texts(spark):
    def peak(work):
        tracemalloc.start()
        kept = work()
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return kept, top

    memo, top = peak(lambda: {f" {k:x}abcdefghijk": [260 + k, k] for k in range(enc._MEMO_LIMIT)})
    assert top < 32_000_000
    wide = "".join(chr(0xFF41 + k % 26) for k in range(3_000))
    texts = pa.array([wide] * 4_000 + [None, ""], pa.string())
    got, top = peak(lambda: normalized(texts, "NFKC"))
    assert got.to_pylist() == [unicodedata.normalize("NFKC", wide)] * 4_000 + [None, ""]
    assert top < 6_000_000 and normalized(pa.array([], pa.string()), "NFKC").to_pylist() == []
