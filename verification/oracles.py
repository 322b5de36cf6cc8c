"""DuckDB SQL for the queries, built from named steps. Nothing here reads what Spark has written."""

from __future__ import annotations

SIZE = 256  # tokens in the vocabulary; its merges are as many steps as DuckDB nests by default
SPECIALS = 4
SHARDS = 2
BLOCK = 128
LINE = 64
BUFFER = 50
BATCH = 8
SEED = 7

_WS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# Every merge adds a token at most, and there is a character at least.
_MERGE_LIST = range(SIZE - SPECIALS)


def _unescape(x: str) -> str:
    """The entities that occur in the given pages; all of them also count without their semicolon."""
    for name, code in (("middot", 183), ("copy", 169), ("quot", 34), ("lt", 60), ("gt", 62), ("amp", 38)):
        x = f"regexp_replace({x}, '&{name};?', chr({code}), 'g')"
    return x


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_WS}+', ''), '{_WS}+$', '')"


def _tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"


def _mask(x: str) -> str:
    return f"regexp_replace({x}, '[^A-Za-z0-9.,!?;:\\-{_WS[1:-1]}]', ' ', 'g')"


def _collapse(x: str) -> str:
    return _strip(f"regexp_replace({x}, '{_WS}+', ' ', 'g')")


def _clean(x: str, html: bool = True, special: bool = True, lower: bool = True) -> str:
    x = _strip(_unescape(x))
    x = _tags(x) if html else x
    x = _mask(x) if special else x
    x = _collapse(x)
    return f"lower({x})" if lower else x


def _split_of(doc: str = "doc_id") -> str:
    return f"CASE WHEN {doc} % 10 = 0 THEN 'validation' WHEN {doc} % 10 = 1 THEN 'test' ELSE 'train' END"


def _as_lines(table: str, key: str, text: str, extra: str = "") -> str:
    return f"""
      SELECT {key}, {extra} CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS line_no, unnest(a) AS text
      FROM (SELECT *, regexp_split_to_array(regexp_replace({text}, '(\\r\\n|\\r|\\n)$', ''), '\\r\\n?|\\n') AS a
            FROM {table} WHERE {text} <> '')"""


def _text(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


# name -> (steps it reads, body)
STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "lines": ((), _as_lines("documents", "doc_id", "text", "lang,")),
    "page_lines": ((), _as_lines("pages", "page_id", "html")),
    "cl": (
        ("lines",),
        f"""SELECT * FROM (SELECT doc_id, line_no, lang, {_clean('text')} AS clean FROM lines)
            WHERE length(clean) > 20 AND length(clean) <= 100000""",
    ),
    "occ": (
        ("cl",),
        """SELECT doc_id, line_no, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS word
           FROM (SELECT doc_id, line_no, regexp_extract_all(clean, ' ?[a-z]+| ?[0-9]+| ?[^\\sa-z0-9]+|\\s+') AS w FROM cl)""",
    ),
    "wc": (
        ("occ",),
        """SELECT word, count(*) AS freq, min((doc_id * 1000000 + line_no) * 100000 + pos) AS met FROM occ GROUP BY word""",
    ),
    "w0": (
        ("wc",),
        """SELECT word, freq, met,
                  chr(1) || array_to_string(string_split(word, ''), chr(2) || chr(1)) || chr(2) AS s
           FROM wc WHERE freq >= 2 AND length(word) <= 100""",
    ),
    "chars": (
        ("w0",),
        "SELECT c AS char, row_number() OVER (ORDER BY c) - 1 AS idx FROM (SELECT DISTINCT unnest(string_split(word, '')) AS c FROM w0)",
    ),
    "vocab": (
        ("chars", "merges"),
        """SELECT unnest(['[PAD]', '[UNK]', '[BOS]', '[EOS]']) AS token, unnest([0, 1, 2, 3]) AS id, 'special' AS kind
           UNION ALL SELECT unnest(['<pad>', '<unk>', '<bos>', '<eos>']), unnest([0, 1, 2, 3]), 'alias'
           UNION ALL SELECT char, 4 + idx, 'char' FROM chars
           UNION ALL SELECT merged, 4 + (SELECT count(*) FROM chars) + row_number() OVER (ORDER BY rank) - 1, 'merge'
                     FROM (SELECT merged, min(rank) AS rank FROM merges GROUP BY merged)""",
    ),
    "names": (("vocab",), "SELECT token, CAST(id AS INTEGER) AS id FROM vocab WHERE kind <> 'alias'"),
    # Shift a character, or reduce the top two symbols while they form a known pair.
    "steps": (
        ("allwords", "merges"),
        """SELECT word, CAST([] AS VARCHAR[]), string_split(word, '') FROM allwords
           UNION ALL
           SELECT word,
                  CASE WHEN m.merged IS NULL THEN list_append(st, rest[1]) ELSE list_append(st[1:len(st) - 2], m.merged) END,
                  CASE WHEN m.merged IS NULL THEN rest[2:] ELSE rest END
           FROM steps LEFT JOIN merges m ON len(st) >= 2 AND m."left" = st[len(st) - 1] AND m."right" = st[len(st)]
           WHERE m.merged IS NOT NULL OR len(rest) > 0""",
    ),
    "done": (
        ("steps", "merges"),
        """SELECT word, st FROM steps LEFT JOIN merges m ON len(st) >= 2 AND m."left" = st[len(st) - 1] AND m."right" = st[len(st)]
           WHERE len(rest) = 0 AND m.merged IS NULL""",
    ),
    "pieces": (
        ("done",),
        "SELECT word, generate_subscripts(st, 1) AS k, unnest(st) AS token FROM done",
    ),
    "coded": (
        ("pieces", "names"),
        """SELECT word, list(coalesce(n.id, 1) ORDER BY k) AS ids
           FROM pieces LEFT JOIN names n ON n.token = pieces.token GROUP BY word""",
    ),
    "enc": (
        ("occ", "coded"),
        "SELECT doc_id, line_no, flatten(list(ids ORDER BY pos)) AS ids FROM occ JOIN coded USING (word) GROUP BY doc_id, line_no",
    ),
    "framed": (("enc",), "SELECT doc_id, line_no, [2] || ids || [3] AS ids FROM enc"),
    "cut": (
        ("enc",),
        f"""SELECT doc_id, line_no, CASE
              WHEN len(ids) + 1 < {LINE} THEN [2] || ids || [3]
              WHEN len(ids) + 1 = {LINE} THEN [2] || ids
              ELSE ([2] || ids)[1:{LINE - 1}] || [3] END AS ids FROM enc""",
    ),
    "whole": (("framed",), f"SELECT doc_id, line_no, line_no % {SHARDS} AS shard, ids FROM framed"),
    "sample": (("framed",), f"SELECT doc_id, line_no, line_no % {SHARDS} AS shard, ids[1:{LINE}] AS ids FROM framed"),
    "line_batch": (
        ("whole",),
        f"""SELECT shard, n // {BATCH} AS batch_id, n % {BATCH} AS row_in_batch, ids,
                   max(len(ids)) OVER (PARTITION BY shard, n // {BATCH}) AS width
            FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id, line_no) - 1 AS n FROM whole)""",
    ),
    "counts": (
        ("train_val_pairs",),
        "SELECT prev_id, next_id, count(*) AS n FROM train_val_pairs WHERE split = 'train' GROUP BY prev_id, next_id",
    ),
    "size": (("names",), "SELECT count(*) AS v FROM names"),
    "totals": (("counts",), "SELECT prev_id, sum(n) AS total FROM counts GROUP BY prev_id"),
    "scores": (
        ("counts", "totals", "size"),
        "SELECT prev_id, next_id, n, ln((n + 1) / (total + v)) AS lp FROM counts JOIN totals USING (prev_id), size",
    ),
    "logits": (("counts",), "SELECT prev_id AS group_id, next_id AS token_id, ln(n) AS logit FROM counts"),
    "prompt_words": (
        (),
        """SELECT conv_id, turn, role, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS word
           FROM (SELECT *, regexp_extract_all(lower(text),
                   '''s|''t|''re|''ve|''m|''ll|''d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+') AS w FROM conversations)""",
    ),
    "turns": (
        ("prompt_words", "coded"),
        """SELECT conv_id, turn, role, flatten(list(ids ORDER BY pos)) AS ids
           FROM prompt_words JOIN coded USING (word) GROUP BY conv_id, turn, role""",
    ),
    "allwords": (("wc",), "SELECT word FROM wc"),
    "with_prompts": (("wc", "prompt_words"), "SELECT word FROM wc UNION SELECT word FROM prompt_words"),
}

for _k in _MERGE_LIST:
    STEPS[f"p{_k}"] = (
        (f"w{_k}",),
        f"""SELECT l AS "left", r AS "right", CAST(sum(freq) AS BIGINT) AS freq, min(met * 1000 + i) AS o
            FROM (SELECT freq, met, i, a[i + 1] AS l, a[i + 2] AS r
                  FROM (SELECT freq, met, a, unnest(range(0, len(a) - 1)) AS i
                        FROM (SELECT freq, met, string_split(s[2:length(s) - 1], chr(2) || chr(1)) AS a FROM w{_k})))
            GROUP BY l, r""",
    )
    STEPS[f"b{_k}"] = ((f"p{_k}",), f"SELECT * FROM p{_k} ORDER BY freq DESC, o LIMIT 1")
    STEPS[f"w{_k + 1}"] = (
        (f"w{_k}", f"b{_k}"),
        f"""SELECT word, w{_k}.freq, met,
                   replace(s, chr(1) || "left" || chr(2) || chr(1) || "right" || chr(2), chr(1) || "left" || "right" || chr(2)) AS s
            FROM w{_k}, b{_k}""",
    )


def _packed(name: str, groups: str, source: str, where: str = "true") -> None:
    """Blocks by walking every token of a group in order."""
    STEPS[f"{name}_token"] = (
        ("enc", "cl"),
        f"""SELECT {groups}, before + k - 1 AS place, id FROM (
              SELECT {groups}, before, generate_subscripts(ids, 1) AS k, unnest(ids) AS id FROM (
                SELECT {groups}, ids, coalesce(sum(len(ids)) OVER (PARTITION BY {groups} ORDER BY doc_id, line_no
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
                FROM (SELECT doc_id, line_no, {source} line_no % {SHARDS} AS shard, enc.ids || [3] AS ids
                      FROM enc JOIN cl USING (doc_id, line_no)) WHERE {where}))""",
    )
    STEPS[f"{name}_block"] = (
        (f"{name}_token",),
        f"""SELECT {groups}, CAST(place // {BLOCK} AS BIGINT) AS block, list(id ORDER BY place) AS ids
            FROM {name}_token GROUP BY {groups}, place // {BLOCK}""",
    )


_packed("pack", "shard", "")
_packed("lang", "lang, shard", "lang,")
_packed("split", "split, shard", f"replace({_split_of()}, 'test', 'train') AS split,")

def _shuffled(source: str, columns: str) -> str:
    """``columns`` and ``position`` of the rows of ``source``: chains of equal slots, and those left at the end."""
    step = f"concat_ws(':', '{SEED}', shard, block - {BUFFER})"
    slot = f"CASE WHEN block < {BUFFER} THEN block ELSE ('0x' || substr(md5({step}), 1, 12))::BIGINT % {BUFFER} END"
    chain = f"SELECT *, lead(block) OVER (PARTITION BY shard, slot ORDER BY block) AS nxt FROM (SELECT *, {slot} AS slot FROM {source})"
    rank = f"row_number() OVER (PARTITION BY shard, nxt IS NULL ORDER BY md5('{SEED}:left:' || shard || ':' || block), block)"
    n = "max(block) OVER (PARTITION BY shard) + 1"
    return f"""SELECT {columns}, CAST(coalesce(nxt - {BUFFER}, greatest(0, {n} - {BUFFER}) + {rank} - 1) AS BIGINT) AS position FROM ({chain})"""


STEPS["train_val"] = (
    ("split_block",),
    f"""{_shuffled(f"(SELECT * FROM split_block WHERE split = 'train' AND len(ids) = {BLOCK})", "split, shard, block, ids")}
        UNION ALL SELECT 'val', shard, block, ids, block FROM split_block WHERE split = 'validation'""",
)
STEPS["train_val_pairs"] = (
    ("train_val",),
    f"""SELECT split, shard, position // {BATCH} AS batch_id, ids[i] AS prev_id, ids[i + 1] AS next_id
        FROM (SELECT *, unnest(range(1, len(ids))) AS i FROM train_val)""",
)
STEPS["losses"] = (
    ("train_val_pairs", "scores", "totals", "size"),
    """SELECT split, shard, batch_id, count(*) AS n, -avg(coalesce(lp, -ln(total + v), -ln(v))) AS nll
       FROM train_val_pairs LEFT JOIN scores USING (prev_id, next_id) LEFT JOIN totals USING (prev_id), size
       GROUP BY split, shard, batch_id""",
)
STEPS["ranked"] = (
    ("logits",),
    """SELECT *, exp(logit) / sum(exp(logit)) OVER (PARTITION BY group_id) AS prob,
              row_number() OVER (PARTITION BY group_id ORDER BY logit DESC, token_id) AS rn FROM logits""",
)


def _u(copy: str = "") -> str:
    key = f"'{SEED}:' || group_id || ':' {copy} || token_id"
    return f"((CAST('0x' || substr(md5({key}), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)"


def _merges(size: int) -> tuple[tuple[str, ...], str]:
    """Merges in order until the vocabulary has ``size`` tokens; a merge into a known token adds none."""
    steps = range(size - SPECIALS)
    listed = " UNION ALL ".join(
        f'SELECT {k} AS rank, "left", "right", "left" || "right" AS merged, freq AS pair_freq FROM b{k}' for k in steps
    )
    return (
        ("chars", *(f"b{k}" for k in steps)),
        f"""SELECT rank, "left", "right", merged, pair_freq FROM (
              SELECT *, coalesce(sum(CAST(first AS INTEGER)) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS added
              FROM (SELECT *, row_number() OVER (PARTITION BY merged ORDER BY rank) = 1 AS first FROM ({listed})))
            WHERE {SPECIALS} + (SELECT count(*) FROM chars) + added < {size}""",
    )


def sql(steps: str, final: str, words: str = "allwords", size: int = SIZE) -> str:
    """``final`` behind every step it needs, each step once and after those it reads."""
    ordered: list[str] = []
    STEPS["merges"] = _merges(size)

    def need(step: str) -> None:
        if step in ordered:
            return
        for before in STEPS[step][0]:
            need(words if before == "allwords" else before)
        ordered.append(step)

    for step in steps.split():
        need(step)
    bodies = []
    for step in ordered:
        body = STEPS[step][1]
        if step == "steps":
            bodies.append(f"steps(word, st, rest) AS ({body.replace('FROM allwords', f'FROM {words}')})")
        else:
            bodies.append(f"{step} AS MATERIALIZED ({body})")
    return f"WITH RECURSIVE {', '.join(bodies)} {final}"


def _met(name: str = "met") -> str:
    return f"""{name} // 100000000000 AS doc_id, CAST(({name} // 100000) % 1000000 AS INTEGER) AS line_no,
               CAST({name} % 100000 AS INTEGER) AS pos"""


def _pairs(step: str) -> str:
    return f"""SELECT "left", "right", freq, {_met('(o // 1000)')}, CAST(o % 1000 AS INTEGER) AS i FROM {step}"""


def _decoded(source: str, keys: str, where: str) -> str:
    """Tokens of the ids in order, specials left out; a line of specials only reads as empty."""
    return f"""SELECT {keys}, coalesce(string_agg(token, '' ORDER BY k), '') AS text
        FROM (SELECT {keys}, generate_subscripts(ids, 1) AS k, unnest(ids) AS id FROM {source}) t
        LEFT JOIN names ON names.id = t.id AND {where} GROUP BY {keys}"""


_SHOWN_BLOCK = f"CAST(shard AS INTEGER) AS shard, block, {_text('ids')} AS input_ids, CAST(len(ids) AS INTEGER) AS n"

ORACLES: dict[str, str] = {
    "doc_lines": sql("lines", "SELECT doc_id, line_no, text FROM lines"),
    "nonblank_lines": sql(
        "lines", f"SELECT * FROM (SELECT doc_id, line_no, {_strip('text')} AS text FROM lines) WHERE text <> ''"
    ),
    "drop_heading_lines": sql(
        "lines",
        f"""SELECT * FROM (SELECT doc_id, line_no, {_strip('text')} AS text FROM lines)
            WHERE text <> '' AND text NOT LIKE '=%'""",
    ),
    "dataset_splits": sql(
        "lines",
        f"""SELECT doc_id, line_no, replace({_split_of()}, 'validation', 'valid') AS split, text
            FROM (SELECT doc_id, line_no, {_strip('text')} AS text FROM lines) WHERE text <> '' AND text NOT LIKE '=%'""",
    ),
    "split_stats": sql(
        "lines",
        f"""SELECT split, count(*) AS num_lines, 'data/raw/split=' || replace(split, 'validation', 'valid') AS path,
                   'documents' AS name, 'raw' AS version, 'given tables' AS source, 'document lines by split' AS description
            FROM (SELECT {_split_of()} AS split, {_strip('text')} AS text FROM lines)
            WHERE text <> '' AND text NOT LIKE '=%' GROUP BY split""",
    ),
    "write_text_lines": sql("cl", "SELECT clean AS text, count(*) AS n FROM cl GROUP BY clean"),
    "preview_sample": sql(
        "lines",
        f"""SELECT doc_id, line_no, split, text FROM (SELECT *, {_split_of()} AS split,
              row_number() OVER (PARTITION BY {_split_of()} ORDER BY doc_id, line_no) AS rn FROM lines) WHERE rn <= 5""",
    ),
    "html_unescape": f"SELECT page_id, {_unescape('html')} AS text FROM pages",
    "strip_text": f"""SELECT doc_id, {_strip("' ' || chr(9) || chr(160) || chr(8195) || chr(10) || text || chr(12288) || chr(133) || ' ' || chr(28) || chr(10) || ' '")} AS text
        FROM documents""",
    "strip_tags": f"SELECT page_id, {_tags('html')} AS text FROM pages",
    "mask_special_chars": f"SELECT doc_id, {_mask('text')} AS text FROM documents",
    "collapse_ws": f"""SELECT doc_id, {_collapse("replace(text, ',', '   ,')")} AS text FROM documents""",
    "lowercase_text": "SELECT doc_id, lower(text) AS text FROM documents",
    "length_filter": sql(
        "lines",
        """SELECT doc_id, line_no, CAST(length(text) AS INTEGER) AS n_chars FROM lines
           WHERE length(text) > 20 AND length(text) <= 100000""",
    ),
    "null_guard": f"""SELECT * FROM (SELECT doc_id, {_clean('text')} AS clean FROM documents)
        WHERE length(clean) > 20 AND length(clean) <= 100000""",
    "clean_documents": sql("cl", "SELECT doc_id, line_no, clean FROM cl"),
    "clean_pages": sql(
        "page_lines",
        f"""SELECT * FROM (SELECT page_id, line_no, {_clean('text')} AS clean FROM page_lines)
            WHERE length(clean) > 1 AND length(clean) <= 100000""",
    ),
    "clean_toggles": sql(
        "page_lines",
        " UNION ALL ".join(
            f"""SELECT * FROM (SELECT page_id, line_no, '{name}' AS switched_off, {_clean('text', **{flag: False})} AS clean
                FROM page_lines) WHERE length(clean) > 1 AND length(clean) <= 100000"""
            for name, flag in (("remove_html", "html"), ("remove_special_chars", "special"), ("lowercase", "lower"))
        ),
    ),
    "clean_texts": f"""SELECT * FROM (SELECT doc_id, {_clean('text')} AS clean FROM documents)
        WHERE length(clean) > 20 AND length(clean) <= 100000""",
    "cleaning_report": sql(
        "lines cl",
        f"""SELECT split, count(*) AS lines_in, count(clean) AS lines_kept,
                   CAST(coalesce(sum(len(string_split(clean, ' '))), 0) AS BIGINT) AS tokens
            FROM (SELECT {_split_of('lines.doc_id')} AS split, clean FROM lines LEFT JOIN cl USING (doc_id, line_no)) GROUP BY split""",
    ),
    # The given texts hold no compatibility forms of their own.
    "nfkc_normalize": "SELECT doc_id, text FROM documents",
    "pretokenize": sql("occ", "SELECT doc_id, line_no, pos, word FROM occ"),
    "word_counts": sql("wc", f"SELECT word, freq, {_met()} FROM wc"),
    "word_filter": sql("w0", "SELECT word, freq FROM w0"),
    "alphabet": sql("chars", "SELECT CAST(idx AS INTEGER) AS idx, char FROM chars"),
    "pair_counts": sql("p0", _pairs("p0")),
    "best_pair": sql("b0", _pairs("b0")),
    "apply_merge": sql(
        "w1", "SELECT word, replace(s[2:length(s) - 1], chr(2) || chr(1), '|') AS symbols FROM w1"
    ),
    "bpe_merges": sql(
        "merges",
        "SELECT CAST(rank AS INTEGER) AS rank, \"left\", \"right\", merged, pair_freq FROM merges",
        size=SIZE,
    ),
    "vocab_table": sql("vocab", "SELECT token, CAST(id AS INTEGER) AS id, kind FROM vocab", size=SIZE),
    "encode_words": sql("done", "SELECT word, array_to_string(st, '|') AS tokens FROM done"),
    "encode_documents": sql("enc", f"SELECT doc_id, line_no, {_text('ids')} AS input_ids FROM enc"),
    "token_to_id": sql(
        "pieces names",
        """SELECT token, CAST(coalesce(id, 1) AS INTEGER) AS id
           FROM (SELECT DISTINCT token FROM pieces) LEFT JOIN names USING (token)""",
    ),
    "id_to_token": sql(
        "coded names",
        """SELECT CAST(c.id AS INTEGER) AS id, coalesce(token, '[UNK]') AS token
           FROM (SELECT DISTINCT unnest(ids) AS id FROM coded) c LEFT JOIN names ON names.id = c.id""",
    ),
    "add_special_tokens": sql(
        "enc",
        f"""SELECT doc_id, line_no, {_text(f"CASE WHEN len(ids) + 1 < {LINE} THEN [2] || ids || [3] ELSE [2] || ids END")} AS input_ids
            FROM enc""",
    ),
    "truncate_ids": sql("cut", f"SELECT doc_id, line_no, {_text('ids')} AS input_ids FROM cut"),
    "pad_ids": sql("cut", f"SELECT doc_id, line_no, {_text(f'list_resize(ids, {LINE}, 0)')} AS input_ids FROM cut"),
    "attention_mask": sql(
        "cut",
        f"""SELECT doc_id, line_no, {_text(f"list_resize(list_transform(ids, lambda x: 1), {LINE}, 0)")} AS attention_mask FROM cut""",
    ),
    "decode_ids": sql("framed names", _decoded("framed", "doc_id, line_no", "names.id > 3")),
    "roundtrip_check": sql(
        "framed names cl",
        f"""SELECT count(*) AS lines, CAST(sum(CASE WHEN text = clean THEN 1 ELSE 0 END) AS BIGINT) AS unchanged
            FROM ({_decoded("framed", "doc_id, line_no", "names.id > 3")}) JOIN cl USING (doc_id, line_no)""",
    ),
    "sql_encode": sql(
        "enc framed names cl",
        f"""SELECT doc_id, line_no, {_text('ids')} AS input_ids, text = clean AS unchanged FROM enc
            JOIN ({_decoded("framed", "doc_id, line_no", "names.id > 3")}) USING (doc_id, line_no) JOIN cl USING (doc_id, line_no)""",
    ),
    "shard_lines": sql("lines", "SELECT doc_id, line_no, CAST(line_no % 4 AS INTEGER) AS shard FROM lines"),
    "unpacked_samples": sql("sample", f"SELECT doc_id, line_no, {_text('ids')} AS input_ids FROM sample"),
    "append_eos": sql("enc", f"SELECT doc_id, line_no, {_text('ids || [3]')} AS input_ids FROM enc"),
    "pack_blocks": sql("lang_block", f"SELECT lang, {_SHOWN_BLOCK} FROM lang_block"),
    "pack_drop_last": sql("pack_block", f"SELECT {_SHOWN_BLOCK} FROM pack_block WHERE len(ids) = {BLOCK}"),
    "pack_keep_last": sql("pack_block", f"SELECT {_SHOWN_BLOCK} FROM pack_block"),
    "train_val_blocks": sql("train_val", f"SELECT split, position, {_SHOWN_BLOCK} FROM train_val"),
    "shuffle_blocks": sql(
        "pack_block",
        _shuffled("pack_block", "CAST(shard AS INTEGER) AS shard, block"),
    ),
    "batch_blocks": sql(
        "pack_block",
        f"""SELECT CAST(shard AS INTEGER) AS shard, block, block // {BATCH} AS batch_id,
                   CAST(block % {BATCH} AS INTEGER) AS row_in_batch FROM pack_block""",
    ),
    "collate_pad": sql(
        "line_batch",
        f"""SELECT CAST(shard AS INTEGER) AS shard, batch_id, CAST(row_in_batch AS INTEGER) AS row_in_batch,
                   {_text('list_resize(ids, width, 0)')} AS input_ids FROM line_batch""",
    ),
    "collate_labels": sql(
        "line_batch",
        f"""SELECT CAST(shard AS INTEGER) AS shard, batch_id, CAST(row_in_batch AS INTEGER) AS row_in_batch,
                   {_text("list_transform(list_resize(ids, width, 0), lambda x: CASE WHEN x = 0 THEN 0 ELSE 1 END)")} AS attention_mask,
                   {_text("list_transform(list_resize(ids, width, 0), lambda x: CASE WHEN x = 0 THEN -100 ELSE x END)")} AS labels
            FROM line_batch""",
    ),
    "next_token_pairs": sql(
        "pack_block",
        f"""SELECT prev_id, next_id, count(*) AS n, CAST(sum(block * {BLOCK} + i - 1) AS BIGINT) AS place_sum
            FROM (SELECT block, i, ids[i] AS prev_id, ids[i + 1] AS next_id
                  FROM (SELECT *, unnest(range(1, len(ids))) AS i FROM pack_block)) GROUP BY prev_id, next_id""",
    ),
    "pack_efficiency": sql(
        "pack_block line_batch",
        f"""SELECT mode, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(slots) AS BIGINT) AS slots,
                   round(1 - sum(tokens) / sum(slots), 6) AS padding_share FROM (
              SELECT 'packed' AS mode, sum(len(ids)) AS tokens, max(len(ids)) * count(*) AS slots
              FROM pack_block GROUP BY shard, block // {BATCH}
              UNION ALL SELECT 'unpacked', len(ids), width FROM line_batch) GROUP BY mode""",
    ),
    "bigram_table": sql("scores", "SELECT prev_id, next_id, n, round(lp, 6) AS log_prob FROM scores"),
    "masked_nll": sql(
        "losses", "SELECT split, CAST(shard AS INTEGER) AS shard, CAST(batch_id AS BIGINT) AS batch_id, n, round(nll, 6) AS nll FROM losses"
    ),
    "perplexity": sql(
        "framed scores totals size",
        """SELECT doc_id, n, round(nll, 6) AS nll, round(exp(least(nll, 20)), 6) AS perplexity FROM (
             SELECT doc_id, count(*) AS n, -avg(coalesce(lp, -ln(total + v), -ln(v))) AS nll
             FROM (SELECT doc_id, ids[i] AS prev_id, ids[i + 1] AS next_id
                   FROM (SELECT *, unnest(range(1, len(ids))) AS i FROM framed))
             LEFT JOIN scores USING (prev_id, next_id) LEFT JOIN totals USING (prev_id), size GROUP BY doc_id)""",
    ),
    "train_val_loss": sql(
        "losses",
        """SELECT split, CAST(sum(n) AS BIGINT) AS n, round(sum(n * nll) / sum(n), 6) AS nll,
                  round(exp(least(sum(n * nll) / sum(n), 20)), 6) AS perplexity FROM losses GROUP BY split""",
    ),
    "perplexity_levels": sql(
        "losses",
        """SELECT CAST(level AS INTEGER) AS level, split, CAST(shard AS INTEGER) AS shard, CAST(batch_id AS BIGINT) AS batch_id,
                  CAST(n AS BIGINT) AS n, round(nll, 6) AS nll, round(exp(least(nll, 20)), 6) AS perplexity FROM (
             SELECT grouping_id(split, shard, batch_id) AS level, split, shard, batch_id, sum(n) AS n, sum(n * nll) / sum(n) AS nll
             FROM losses GROUP BY GROUPING SETS ((split, shard, batch_id), (split), ()))""",
    ),
    "finite_loss_check": sql(
        "losses",
        """SELECT count(*) AS "groups", CAST(sum(CASE WHEN isfinite(nll) THEN 0 ELSE 1 END) AS BIGINT) AS non_finite FROM losses""",
    ),
    "softmax_temperature": sql(
        "logits",
        """SELECT group_id, token_id, round(exp(logit / 0.8) / sum(exp(logit / 0.8)) OVER (PARTITION BY group_id), 6) AS prob
           FROM logits""",
    ),
    "topk_candidates": sql(
        "logits",
        """SELECT group_id, token_id, round(logit, 6) AS logit
           FROM (SELECT *, rank() OVER (PARTITION BY group_id ORDER BY logit DESC) AS rk FROM logits) WHERE rk <= 5""",
    ),
    "nucleus_candidates": sql(
        "ranked",
        """SELECT group_id, token_id, round(logit, 6) AS logit FROM (SELECT *, coalesce(sum(prob) OVER (
             PARTITION BY group_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ranked)
           WHERE rn = 1 OR before <= 0.9""",
    ),
    "greedy_candidate": sql("ranked", "SELECT group_id, token_id, round(logit, 6) AS logit FROM ranked WHERE rn = 1"),
    "sample_candidates": sql(
        "logits",
        f"""SELECT group_id, token_id, round(logit, 6) AS logit FROM (SELECT *, row_number() OVER (
              PARTITION BY group_id ORDER BY logit - ln(-ln({_u()})) DESC, token_id) AS rn FROM logits) WHERE rn = 1""",
    ),
    "fan_out_sequences": sql(
        "logits",
        f"""SELECT group_id, copy, token_id, round(logit, 6) AS logit FROM (SELECT *, row_number() OVER (
              PARTITION BY group_id, copy ORDER BY logit - ln(-ln({_u("|| copy || ':'")})) DESC, token_id) AS rn
            FROM logits, (SELECT unnest([0, 1, 2]) AS copy)) WHERE rn = 1""",
    ),
    "repeated_ngrams": sql(
        "enc",
        """SELECT doc_id, line_no, a || ' ' || b || ' ' || c || ' ' || d AS ngram, count(*) AS n
           FROM (SELECT doc_id, line_no, ids[i] AS a, ids[i + 1] AS b, ids[i + 2] AS c, ids[i + 3] AS d
                 FROM (SELECT *, unnest(range(1, len(ids) - 2)) AS i FROM enc))
           GROUP BY doc_id, line_no, a, b, c, d HAVING count(*) > 1""",
    ),
    "token_repetition": sql(
        "enc",
        """SELECT doc_id, line_no, token_id, count(*) AS n
           FROM (SELECT doc_id, line_no, unnest(ids) AS token_id FROM enc) GROUP BY doc_id, line_no, token_id""",
    ),
    "repetition_share": sql(
        "enc",
        """SELECT doc_id, line_no, CAST(len(ids) AS INTEGER) AS tokens, CAST(len(list_distinct(ids)) AS INTEGER) AS distinct_tokens,
                  round(1 - len(list_distinct(ids)) / len(ids), 6) AS repeated_share FROM enc""",
    ),
    "prepare_prompts": sql(
        "turns",
        f"""SELECT conv_id, turn, {_text('[2] || ids || [3]')} AS input_ids,
                   {_text("list_transform([2] || ids || [3], lambda x: 1)")} AS attention_mask
            FROM turns WHERE role = 'user'""",
        "with_prompts",
    ),
    "strip_prompt": sql(
        "turns names",
        f"""SELECT q.conv_id, q.turn, coalesce(d.text, '') AS text FROM turns q
            LEFT JOIN ({_decoded("turns", "conv_id, turn", "names.id > 3")}) d ON q.conv_id = d.conv_id AND q.turn = d.turn - 1
            WHERE q.role = 'user'""",
        "with_prompts",
    ),
    "batch_predict": sql(
        "turns size",
        """SELECT conv_id, turn, string_agg(((31 * last + 7 * n) + 17 * v) % 101, ' ' ORDER BY v) AS logits
           FROM (SELECT conv_id, turn, ids[len(ids)] AS last, len(ids) + 1 AS n, unnest(range(0, (SELECT v FROM size))) AS v
                 FROM turns WHERE role = 'user') GROUP BY conv_id, turn""",
        "with_prompts",
    ),
    "next_token_draw": sql(
        "turns size",
        """, asked AS (SELECT conv_id, turn, [2] || ids AS ids FROM turns WHERE role = 'user'),
        raw AS (SELECT conv_id, turn, v, ((31 * ids[len(ids)] + 7 * len(ids)) + 17 * v) % 101 / 10.0::DOUBLE AS x, ids
                FROM (SELECT *, unnest(range(0, (SELECT v FROM size))) AS v FROM asked)),
        seen AS (SELECT conv_id, turn, id AS v, count(*) AS f FROM (SELECT conv_id, turn, unnest(ids) AS id FROM asked) GROUP BY ALL),
        grams AS (SELECT conv_id, turn, ids, unnest(range(1, len(ids) - 1)) AS i FROM asked),
        banned AS (SELECT DISTINCT conv_id, turn, ids[i + 2] AS v FROM grams WHERE ids[i] = ids[len(ids) - 1] AND ids[i + 1] = ids[len(ids)]),
        warm AS (SELECT conv_id, turn, v, x / pow(1.2, coalesce(f, 0)) / 0.8 AS y FROM raw LEFT JOIN seen USING (conv_id, turn, v)
                 ANTI JOIN banned USING (conv_id, turn, v)),
        top AS (SELECT *, exp(y - max(y) OVER (PARTITION BY conv_id, turn)) AS w
                FROM (SELECT *, rank() OVER (PARTITION BY conv_id, turn ORDER BY y DESC) AS r FROM warm) WHERE r <= 20),
        nucleus AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY conv_id, turn ORDER BY y DESC, v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
                sum(w) OVER (PARTITION BY conv_id, turn) AS total FROM top),
        noisy AS (SELECT *, y - ln(-ln((CAST('0x' || substr(md5('7:' || conv_id || ':' || turn || ':' || v), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)) AS z
                FROM nucleus WHERE earlier <= 0.9 * total)
        SELECT conv_id, turn, CAST(v AS INTEGER) AS token_id, round(y, 6) AS logit
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY z DESC, v) AS n FROM noisy) WHERE n = 1""",
        "with_prompts",
    ),
}
ORACLES["tokenizer_artifact"] = ORACLES["bpe_merges"]
ORACLES["reuse_tokenizer"] = ORACLES["vocab_table"]
ORACLES["stream_clean_encode"] = ORACLES["encode_documents"]
ORACLES["stream_pack"] = ORACLES["pack_keep_last"]
