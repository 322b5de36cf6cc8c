"""Word-level BPE with word ends, encoded over a trie of the distinct words.

The encoding of a text's prefix is fixed by its last token and the encoding of what stands before that
token. So a walk down a trie needs one state per node, the last token of the prefix that ends there, and
words with a common prefix share its states. Two neighbouring tokens may stand together if no merge that
ranks before their own completion joins across the border between them; a sequence is the encoding of its
text if all its neighbours may.

Distinct words of a run of texts are sorted, which lists the trie's leaves in depth-first order; the stack
of states is cut back to the prefix shared with the word before and extended from there.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tokenloom.llm.byte_bpe import task_cache
from tokenloom.llm.common import col, fresh, kept_names, text_slices

END = "</w>"
#: Chunks, and words, whose ids a task keeps, and the longest that it keeps.
MEMO, MEMO_BYTES = 150_000, 200
SLICE = 8 << 20
#: Pairs of neighbours that a task remembers.
MEMO_PAIRS = 150_000
_NEVER = 1 << 40
# Printable ASCII and composed Latin letters: these need no normalization, and fold as everywhere.
_LATIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# What the vocabulary takes as words in such text in lower case, without white space.
_LATIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
# Fixed rule: byte-level vocabularies write bytes without a printable character as letters from 256 on, in order.
_HIDDEN = [*range(33), *range(127, 161), 173]
_LETTERS = {b: 256 + n for n, b in enumerate(_HIDDEN)}


class TrieEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self._library = Tokenizer.from_file(path)
        self._id: dict[str, int] = dict(model["vocab"])
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._split = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self._rank: dict[tuple[str, str], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self._rank.setdefault((left, right), rank)
        self._borders()
        self._together: dict[tuple[str, str], bool] = {}
        self._memo, self._word_memo = Memo(MEMO, MEMO_BYTES), Memo(MEMO, MEMO_BYTES)

    def _borders(self) -> None:
        """For each token: the tokens that successively end at its right border and begin at its left one.

        Each comes with the rank of the merge that swallows it. Only tokens that encode to themselves have an entry.
        """
        letters = {t for t in self._id if len(t) == 1 or (len(t) == 1 + len(END) and t.endswith(END))}
        self._right = {t: [(t, _NEVER)] for t in letters}
        self._left = {t: [(t, _NEVER)] for t in letters}
        for (a, b), rank in sorted(self._rank.items(), key=lambda x: x[1]):
            whole = a + b
            if whole in self._right or whole not in self._id or a not in self._right or b not in self._right:
                continue
            if self._apart(a, b, rank):
                self._right[whole] = [*self._right[b][:-1], (b, rank), (whole, _NEVER)]
                self._left[whole] = [*self._left[a][:-1], (a, rank), (whole, _NEVER)]
        self._bytes = {t: self._id[t].to_bytes(4, "little") for t in self._right}
        self._longest = max((len(t.removesuffix(END)) for t in self._right), default=1)

    def _apart(self, a: str, b: str, below: int = _NEVER) -> bool:
        """Whether ``a`` and ``b`` both get completed, with no merge across their border ranked before ``below``."""
        right, left, i, j = self._right[a], self._left[b], 0, 0
        while True:
            (x, x_rank), (y, y_rank) = right[i], left[j]
            across = self._rank.get((x, y), _NEVER)
            if across < below and across < x_rank and across <= y_rank:
                return False
            if x_rank == y_rank == _NEVER:
                return True
            if x_rank <= y_rank:
                i += 1
            else:
                j += 1

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of distinct byte-level words (little-endian unsigned 32-bit), by one depth-first walk over their trie."""
        out: dict[str, bytes] = {}
        known, together, apart, longest, code = self._right, self._together, self._apart, self._longest, self._bytes
        if len(together) >= MEMO_PAIRS:
            together.clear()
        states: list[str] = [""]  # states[k] is the last token of the current word's first k letters
        before = ""
        for word in sorted(set(words)):
            size = len(word)
            shared, most = 0, min(len(states), size, len(before) + 1) - 1
            if word[:most] == before[:most]:
                shared = most
            else:
                while word[shared] == before[shared]:
                    shared += 1
            del states[shared + 1 :]
            for end in range(shared + 1, size + 1):
                # Just one token can be the last; short ones are the likeliest.
                for start in range(end - 1, max(-1, end - 1 - longest), -1):
                    token = word[start:end] if end < size else word[start:] + END
                    if token in known:
                        if not start:
                            break
                        pair = (states[start], token)
                        fits = together.get(pair)
                        if fits is None:
                            fits = together[pair] = apart(*pair)
                        if fits:
                            break
                else:
                    raise ValueError(f"no token ends at {end} of {word[:60]!r}")
                states.append(token)
            token = states.pop()
            ids, at = [code[token]], size - len(token) + len(END)
            while at:
                token = states[at]
                ids.append(code[token])
                at -= len(token)
            ids.reverse()
            out[word] = b"".join(ids)
            before = word
        return out

    def _words(self, chunk: str) -> list[str]:
        """Byte-level words of a chunk without ASCII white space."""
        if _LATIN.fullmatch(chunk):
            words = _LATIN_WORDS.findall(chunk.lower())
            return words if chunk.isascii() else [w if w.isascii() else _byte_level(w) for w in words]
        normal = self._library.normalizer.normalize_str(chunk)
        return [w for w, _ in self._library.pre_tokenizer.pre_tokenize_str(normal)]

    def _learn(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        words = {c: self._words(c.decode()) for c in chunks}
        ids = self._word_memo.get_all({w for ws in words.values() for w in ws}, self.encode_words)
        return {c: ids[ws[0]] if len(ws) == 1 else b"".join(map(ids.__getitem__, ws)) for c, ws in words.items()}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers.

        The collector of cycles pauses: there are none, and looking for them among so many small objects takes a third of the time.
        """
        paused = gc.isenabled()
        gc.disable()
        try:
            return self._encode_all(texts)
        finally:
            if paused:
                gc.enable()

    def _encode_all(self, texts: list[str]) -> list[bytes]:
        parts = [[t] if self._split is None or "<" not in t else self._split.split(t) for t in texts]
        wanted: set[bytes] = set()
        for part in parts:
            for p in part:
                if p not in self.specials:
                    wanted.update(p.encode().split())
        get = self._memo.get_all(wanted, self._learn).__getitem__
        special = {t: i.to_bytes(4, "little") for t, i in self.specials.items()}
        return [b"".join([special[p] if p in special else b"".join(map(get, p.encode().split())) for p in part]) for part in parts]


def _byte_level(word: str) -> str:
    """A word of Latin letters as the vocabulary writes its UTF-8 bytes."""
    return word.encode().decode("latin-1").translate(_LETTERS)


class Memo:
    """Remembers what was asked for lately: when the newer half is full, the older one goes."""

    def __init__(self, size: int, longest: int):
        self._size, self._longest = size // 2, longest
        self._old: dict = {}
        self._new: dict = {}

    def get_all(self, wanted: set, learn) -> dict:
        out, new = {}, set()
        for key in wanted:
            value = self._new.get(key) or self._old.get(key)
            if value is None:
                new.add(key)
            else:
                out[key] = value
        out.update(learn(new))
        for key in out:
            if len(key) <= self._longest:
                self._new[key] = out[key]
                if len(self._new) > self._size:
                    self._old, self._new = self._new, {}
        return out


def encoder(path: str) -> TrieEncoder:
    cache = task_cache()
    if ("trie", path) not in cache:
        cache["trie", path] = TrieEncoder(path)
    return cache["trie", path]


def token_names(path: str) -> list[str]:
    """Tokens by id; "" where there is none."""
    cache = task_cache()
    if ("names", path) not in cache:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
        names = [""] * (max(ids.values(), default=-1) + 1)
        for token, i in ids.items():
            names[i] = token
        cache["names", path] = names
    return cache["names", path]


def decoded(ids: np.ndarray, names: list[str]) -> str:
    """The vocabulary file names no decoder, for which its library joins the tokens by spaces."""
    return " ".join(map(names.__getitem__, ids.tolist()))


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``ids`` (array of int) of every whole text. Nulls and texts without words have no ids.

    No shuffle: every row stays where it is, repeated rows are encoded alike. All columns are kept, or those in ``keep``
    (``ids`` gets underscores in front if it is taken).
    """
    out = fresh(docs, "ids")[0]
    keep = docs.columns if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for rows, _, _ in text_slices(batches, text_col, SLICE):
            found = enc.encode_all([t or "" for t in rows.column(text_col).to_pylist()])
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int64)
            ids = pa.array(np.frombuffer(b"".join(found), "<i4"))
            lists = pa.LargeListArray.from_arrays(pa.array(offsets), ids).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], lists], names=[*keep, out])

    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c in keep)
    return docs.select(*kept_names(docs)).mapInArrow(run, f"{kinds}, `{out}` array<int>")


def _each_ids(batch: pa.RecordBatch, ids_col: str) -> Iterator[np.ndarray | None]:
    lists = batch.column(ids_col)
    values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    for i in range(batch.num_rows):
        yield values[offsets[i] : offsets[i + 1]] if lists[i].is_valid else None


def decode_documents(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded``, the text that the ids stand for. Null ids give null."""
    out = fresh(rows, "decoded")[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = token_names(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [None if ids is None else decoded(ids, names) for ids in _each_ids(part, ids_col)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return rows.mapInArrow(run, f"{_ddl(rows)}, `{out}` string")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in df.dtypes)


def digests(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """For ``ids_col``: ``n_tokens`` (long), ``ids_sha256`` of the ids as little-endian unsigned 32-bit integers, and
    ``decoded_sha256`` of the decoded text in UTF-8, which is decoded and hashed row by row. Null ids count as none.

    The other columns are kept; a new name that one of them has gets underscores in front. An empty table gives an empty
    one. A text of any length is one row in one task, whose decoded form is held once.
    """
    kept = [n for n in rows.columns if n != ids_col]
    names_out = fresh(rows.select(*[col(rows, n) for n in kept]), "n_tokens", "ids_sha256", "decoded_sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = token_names(path)
        for batch in batches:
            counts, sums, texts = [], [], []
            for ids in _each_ids(batch, ids_col):
                ids = np.zeros(0, np.int32) if ids is None else ids
                counts.append(len(ids))
                sums.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                texts.append(hashlib.sha256(decoded(ids, names).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(texts, pa.string())],
                names=[*kept, *names_out],
            )

    kinds = [f"`{c}` {t}" for c, t in rows.dtypes if c != ids_col]
    kinds += [f"`{n}` {t}" for n, t in zip(names_out, ("long", "string", "string"), strict=True)]
    return rows.mapInArrow(run, ", ".join(kinds))
