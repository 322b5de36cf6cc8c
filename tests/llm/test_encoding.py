import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tokenloom.llm import token_files, trie_bpe
from tokenloom.llm.byte_bpe import ByteEncoder

BYTE = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"))
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", "  ", "Hello, World! it's 2024  don't", "İstanbul ΣΑΣ ß ﬁ ½ ①", "a<|endoftext|>b <|startoftext|><|endoft", "😀👍🏽 中文字 日本語 한국어",
    "é ́x   y\x1cz \x85", "!!!???...'ll'd'S 'T", "x" * 5000, "ab" * 3000, "नमस्ते 12345 x y", "<|endoftext|>", "</w> a</w>b", "a\n\n b \t c",
]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(2)
    letters = "abcdehilnorst'.,!é ßü-0123́Σ \n"
    return ODD + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(1500)]


def test_byte_ids_equal_the_library(texts):
    library, own = Tokenizer.from_file(BYTE[1]), ByteEncoder(*BYTE)
    for t in [*texts[1:], "\n" * 120_000]:
        assert own.ids(t).tolist() == library.encode(t, add_special_tokens=False).ids


def test_word_ids_equal_the_library(texts):
    library, own, names = Tokenizer.from_file(WORD), trie_bpe.TrieEncoder(WORD), trie_bpe.token_names(WORD)
    for t, found in zip(texts[1:], own.encode_all(texts[1:]), strict=True):
        ids = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(found, "<u4").tolist() == ids
        assert trie_bpe.decoded(np.array(ids, np.int64), names) == library.decode(ids, skip_special_tokens=False)


def test_word_documents(spark, texts):
    library = Tokenizer.from_file(WORD)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts[:80])], "doc_id long, text string, ids string")
    rows = trie_bpe.encode_documents(docs, WORD)
    assert rows.columns == ["doc_id", "text", "ids", "_ids"]
    for r in trie_bpe.digests(trie_bpe.decode_documents(rows, WORD, "_ids"), WORD, "_ids").collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert trie_bpe.encode_documents(docs.limit(0), WORD).collect() == []


def test_digests_beside_columns_of_the_same_names(spark):
    rows = spark.createDataFrame([(1, [5, 6], "own", 2), (2, None, "own", 3)], "doc_id long, ids array<int>, n_tokens string, IDS_sha256 int")
    out = trie_bpe.digests(rows, WORD)
    assert out.columns == ["doc_id", "n_tokens", "IDS_sha256", "_n_tokens", "_ids_sha256", "decoded_sha256"]
    got = {r.doc_id: (r.n_tokens, r["IDS_sha256"], r._n_tokens) for r in out.collect()}
    assert got == {1: ("own", 2, 2), 2: ("own", 3, 0)}
    assert trie_bpe.digests(rows.limit(0), WORD).collect() == []


def test_token_files(spark, texts, tmp_path):
    library = Tokenizer.from_file(BYTE[1])
    rows = [(i * 3, t, "x") for i, t in enumerate(texts[:200])] + [(6, ODD[2], "x")]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(5)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, *BYTE, end_id=0)
    got = sorted(token_files.with_crc32(token_files.read_tokens(spark, path)).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    want, before = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t, _ in rows}, 0
    for r, doc_id in zip(got, sorted(i for i, _, _ in rows), strict=True):
        ids = want[doc_id]
        assert (r.doc_id, r.start, r.n_tokens) == (doc_id, before, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        before += len(ids)


def test_token_files_are_read_in_part(spark, texts, tmp_path):
    import glob

    import pyarrow.parquet as pq

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, *BYTE, end_id=0)
    plan = token_files.read_tokens(spark, path).select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1].splitlines()[0]
    meta = pq.ParquetFile(glob.glob(f"{path}/tokens/*.parquet")[0]).metadata.row_group(0)
    ids = next(meta.column(i) for i in range(meta.num_columns) if meta.column(i).path_in_schema.startswith("ids"))
    assert ids.has_dictionary_page and meta.column(0).has_offset_index and meta.column(0).has_column_index
    empty = str(tmp_path / "empty")
    token_files.write_tokens(docs.limit(0), empty, *BYTE, end_id=0)
    assert token_files.read_tokens(spark, empty).collect() == []
