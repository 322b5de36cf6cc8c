"""One query per operator over its whole table, and the SQL where DuckDB can say the same."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import (
    html_text,
    jaccard_join,
    mixture,
    multi_index,
    packing,
    periodic_runs,
    quality_lm,
    sharding,
    substring_dedup,
    token_files,
    trie_bpe,
    vector_codes,
)
from tokenloom.llm import quality_rules as rules
from tokenloom.llm.common import SPACE_CLASS, join_totals, staged
from tokenloom.staging import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, the two base rules, and the verdict of the whole table of thresholds."""
    judged = rules.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    q, base = F.col("quality"), F.arrays_overlap("failed_rules", F.array(F.lit("length"), F.lit("repetition")))
    return judged.select("doc_id", *[q[c].alias(c) for c in rules.COUNTS], base.alias("base_failed"), (F.size("failed_rules") == 0).alias("kept"))


def _stop_sql() -> str:
    def words(names: list[str]) -> str:
        return "(" + ", ".join(f"'{w}'" for w in names) + ")"

    every = sorted({w for v in rules.STOP_WORDS.values() for w in v})
    cases = " ".join(f"WHEN lang = '{k}' THEN b IN {words(v)}" for k, v in rules.STOP_WORDS.items())
    return f"CASE {cases} ELSE b IN {words(every)} END"


RULE_COUNTS_SQL = rf"""
d AS (SELECT doc_id, lang, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT doc_id, lang, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
bare AS (SELECT doc_id, lang, lower(trim(w, '.,;:!?()"''')) AS b FROM words),
stops AS (SELECT doc_id, count(*) FILTER (WHERE {_stop_sql()}) AS n_stop_words FROM bare GROUP BY doc_id),
tri AS (SELECT a.doc_id, a.i, a.w || ' ' || b.w || ' ' || c.w AS g FROM words a
        JOIN words b ON a.doc_id = b.doc_id AND b.i = a.i + 1 JOIN words c ON a.doc_id = c.doc_id AND c.i = a.i + 2),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM again, range(3) r(k) GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counts AS (SELECT d.doc_id, d.lang, len(ws)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_stop_words, 0)::BIGINT AS n_stop_words,
        len(regexp_extract_all(t, '[!?]{{2,}}'))::BIGINT AS n_shouts
        FROM d LEFT JOIN stops USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id))
"""


def _passes(rule: rules.Rule) -> str:
    parts = [p.strip() for p in rule.metric.split("/")]
    value = parts[0] if len(parts) == 1 else f"(CASE WHEN {parts[1]} = 0 THEN 0 ELSE {parts[0]}::DOUBLE / {parts[1]} END)"
    passes = " AND ".join(
        [f"{value} >= {rule.low}"] * (rule.low is not None) + [f"{value} <= {rule.high}"] * (rule.high is not None)
    )
    # Stop words judge no document of a language without a list; a null language is judged.
    listed = ", ".join(f"'{k}'" for k in rules.STOP_WORDS)
    return f"(coalesce(lang NOT IN ({listed}), FALSE) OR {passes})" if "n_stop_words" in rule.metric else passes


RULES_KEPT_SQL = " AND ".join(_passes(r) for r in rules.RULES)
ORACLES["op9_quality_rules"] = f"""WITH {RULE_COUNTS_SQL}
SELECT {", ".join(["doc_id", *rules.COUNTS])}, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    {RULES_KEPT_SQL} AS kept FROM counts"""


SHARDS, SHARD_SEED = 40, 20240501


@query
def op6_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot; counts are at most one apart."""
    placed = sharding.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS, SHARD_SEED)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _shuffled_sql() -> str:
    """Row numbers, the Feistel rounds on their halves as nested selects, the walk as a recursion, CRC-32 from its rule."""

    def mixed(half: str, key: int) -> str:
        p, (a, b, c) = sharding.PRIME, sharding.MULTIPLIERS
        x = f"(({half} + {key}) % {p}) * {a} % {p}"
        x = f"list_transform([{x}], lambda x: (xor(x, x >> 13) * {b}) % {p})"
        return f"list_transform({x}, lambda x: (xor(x, x >> 17) * {c}) % {p})[1]"

    def once(source: str) -> str:
        body = f"SELECT doc_id, a, b, rows, x // b AS l, x % b AS r FROM {source}"
        for i, key in enumerate(sharding.round_keys(SHARD_SEED)):
            moved = f"(l + {mixed('r', key)}) % a AS l, r" if i % 2 == 0 else f"l, (r + {mixed('l', key)}) % b AS r"
            body = f"SELECT doc_id, a, b, rows, {moved} FROM ({body})"
        return f"SELECT doc_id, a, b, rows, l * b + r AS x FROM ({body})"

    return f"""WITH RECURSIVE
    codes AS (SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    c AS (SELECT doc_id, n + 16 AS size, xor(list_reduce([4294967295::BIGINT] || list_transform(range(n), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
        lambda acc, x: xor(acc >> 8, t[(xor(acc, x) & 255) + 1])), 4294967295) AS text_crc32 FROM d, codes),
    k AS (SELECT *, row_number() OVER (ORDER BY doc_id, size, text_crc32) - 1 AS x, count(*) OVER () AS rows FROM c),
    dims AS (SELECT doc_id, x, rows, floor(sqrt(rows - 1))::BIGINT + 1 AS a FROM k),
    start AS (SELECT doc_id, x, rows, a, CASE WHEN a * (rows // a) = rows THEN rows // a ELSE rows // a + 1 END AS b FROM dims),
    walk AS ({once('start')} UNION ALL {once('(SELECT * FROM walk WHERE x >= rows)')})
    SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (x % {SHARDS})::INTEGER AS shard, x // {SHARDS} AS slot, NULL::INTEGER AS grown_shard
    FROM walk JOIN c USING (doc_id) WHERE x < rows"""


ORACLES["op6_feistel_sharding"] = _shuffled_sql()


def tokenizer_file(name: str) -> str:
    """The place of a public vocabulary file, on this machine as on the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_files() -> tuple[str, str]:
    return tokenizer_file("byte_bpe_50k.tiktoken"), tokenizer_file("byte_bpe_50k.json")


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of all documents as files, and describe what is read back."""
    path = new_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, *byte_files(), end_id=0)
    return token_files.with_crc32(token_files.read_tokens(spark, path))


@query
def op3_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    path = tokenizer_file("word_bpe_49k.json")
    rows = trie_bpe.encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), path, keep=["doc_id"])
    return trie_bpe.digests(rows, path)


@query
def op1_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    rows = html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")
    return rows.withColumn("n_chars", F.length("text").cast("long"))


@query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document under word 5-grams with similarity 0.8 or more."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLES["op4_jaccard_join"] = r"""WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END) AS s FROM d),
tok AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS c
    FROM tok a JOIN tok b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common WHERE 100 * c >= 80 * (nx + ny - c)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(min(r.y), s.doc_id)) AS component_id
FROM sets s LEFT JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, len(s.s)"""


@query
def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every 50th vector among all vectors."""
    return multi_index.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 13-word windows that earlier documents have."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = substring_dedup.remove_repeats(docs).select("doc_id", "deduped.*")
    words = F.array_remove(F.split("text", f"{SPACE_CLASS}+"), "")
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.encode(F.array_join(words, " "), "UTF-8"), 256).alias("kept_sha256"))


ORACLES["op7_substring_dedup"] = r"""WITH
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS p, unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i : i + 12], ' '))) AS g FROM d),
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY g) AS m FROM win) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM rep, range(13) r(k)),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.p) AS t, count(*) AS n FROM w ANTI JOIN gone USING (doc_id, p) GROUP BY w.doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


@query
def op8_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of at most 2048 ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack_documents(docs, *byte_files(), end_id=1, checksums=True)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_lm.classified(docs, table(spark, sf_dir, "labels")).drop("mark")


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every usable vector, the errors of its label, and a digest of the final codebooks."""
    done = vector_codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    digest = hashlib.sha256(",".join(map(str, done.codebooks.ravel().tolist())).encode()).hexdigest()
    # Errors of a label are summed in a wider type and stop at the largest long.
    totals = done.rows.groupBy("label").agg(F.count("*").alias("n_rows"), F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    joined = join_totals(done.rows, staged(totals, "label-errors"), ["label"], "n_rows")
    code = F.array_join(F.transform("code", lambda e: F.lpad(F.lower(F.hex(e.cast("long"))), 2, "0")), "")
    return joined.select(
        "vec_id", code.alias("code"), "error", F.least("total", F.lit(2**63 - 1)).cast("long").alias("label_error"), F.lit(digest).alias("codebooks_sha256")
    )


def _codes_sql(rule: vector_codes.Codes = vector_codes.Codes(), width: int = 8) -> str:
    """Rounds as a chain of tables: nearest entries by squared distance, then means; ``width`` components a part, as in the given table."""
    parts = range(rule.parts)
    cut = ", ".join(f"w[{p * width + 1}:{(p + 1) * width}]" for p in parts)
    far = " + ".join(f"(x.v[{i}] - b.v[{i}]) * (x.v[{i}] - b.v[{i}])" for i in range(1, width + 1))
    mean = ", ".join(f"(sum(v[{i}]) - (((sum(v[{i}]) % count(*)) + count(*)) % count(*)))::HUGEINT // count(*)" for i in range(1, width + 1))
    ctes = [
        f"""good AS (SELECT vec_id, label, list_transform(embedding, lambda c: floor({rule.scale} * c::DOUBLE)::BIGINT) AS w FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""",
        f"x AS MATERIALIZED (SELECT vec_id, label, unnest(range({rule.parts})) AS p, unnest([{cut}]) AS v FROM good)",
        "firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM good)",
        f"b0 AS MATERIALIZED (SELECT p, e, v FROM x JOIN firsts USING (vec_id) WHERE e < {rule.entries})",
    ]
    for r in range(rule.rounds + 1):
        ctes.append(
            f"""a{r} AS MATERIALIZED (SELECT vec_id, label, p, min(d * 256 + e) % 256 AS e, min(d * 256 + e) // 256 AS d, any_value(v) AS v
            FROM (SELECT x.vec_id, x.label, x.p, x.v, b.e, {far} AS d FROM x JOIN b{r} b ON x.p = b.p) GROUP BY vec_id, label, p)"""
        )
        if r < rule.rounds:
            ctes.append(
                f"""b{r + 1} AS MATERIALIZED (SELECT o.p, o.e, coalesce(n.v, o.v) AS v FROM b{r} o
                LEFT JOIN (SELECT p, e, [{mean}]::BIGINT[] AS v FROM a{r} GROUP BY p, e) n ON o.p = n.p AND o.e = n.e)"""
            )
    last = f"a{rule.rounds}"
    return f"""WITH {", ".join(ctes)},
    digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rule.rounds}),
    c AS (SELECT vec_id, label, string_agg(lpad(lower(hex(e::BIGINT)), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM {last} GROUP BY vec_id, label)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM c, digest"""


ORACLES["op11_vector_codes"] = _codes_sql()


def looped_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: with h the CRC-32 of the decimal id and g = floor(h / 10), the words of a text whose h ends in 0 repeat
    from word g % n on, with a period that leaves three to ten times its length; all other texts as they are."""
    words = F.array_remove(F.split("text", f"{SPACE_CLASS}+"), "")
    h = F.crc32(F.col("doc_id").cast("string"))
    n, g = F.size("ws"), F.expr("h div 10")
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("ws"))
    rows = rows.withColumn("a", F.expr("CASE WHEN size(ws) > 0 THEN cast((h div 10) % size(ws) AS int) END"))
    rows = rows.withColumn("p", (F.lit(1) + F.call_function("div", n - F.col("a"), F.lit(3) + g % 8)).cast("int"))
    place = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    looped = F.array_join(F.transform(place, lambda i: F.get("ws", i)), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), looped).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, and what is left when each keeps one period."""
    rows = periodic_runs.find_runs(looped_texts(table(spark, sf_dir, "documents")), keep=["doc_id"])
    rows = periodic_runs.with_strongest(rows.select("doc_id", "periodic.runs", "periodic.collapsed"), "runs")
    best, spelled = F.col("strongest"), F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n")))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.start.alias("start"),
        best.length.alias("length"),
        best.period.alias("period"),
        F.call_function("div", best.length * 1000, best.period).alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(spelled, ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


# A run of 24 words or more, and of three periods, has 16 words or more that the word a period on equals, so nine 8-word windows
# in a row with an equal one a period on. A stretch that a shorter period has too isn't a run of the longer one.
ORACLES["op12_periodic_runs"] = r"""WITH
codes AS (SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS ws,
    xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
        lambda acc, x: xor(acc >> 8, t[(xor(acc, x) & 255) + 1])), 4294967295) AS h FROM documents, codes),
g AS (SELECT *, len(ws) AS n, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM d),
m AS MATERIALIZED (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: ws[(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END) + 1]) ELSE ws END AS ws FROM g),
w8 AS (SELECT doc_id, unnest(range(n - 7)) AS i, unnest(list_transform(range(n - 7), lambda i: hash(ws[i + 1 : i + 8]))) AS k FROM m WHERE n >= 24),
again AS MATERIALIZED (SELECT doc_id, i, k FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM w8) WHERE c > 1),
eq AS (SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM again x JOIN again y ON x.doc_id = y.doc_id AND x.k = y.k AND x.i < y.i),
isl AS (SELECT doc_id, q, min(i) AS s, max(i) + 8 + q AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS z FROM eq) GROUP BY doc_id, q, z),
runs AS MATERIALIZED (SELECT doc_id, s AS start, e - s AS length, min(q) AS period FROM isl GROUP BY doc_id, s, e HAVING e - s >= greatest(24, 3 * min(q))),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1),
spelled AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
w AS (SELECT doc_id, unnest(range(n)) AS i, unnest(ws) AS w FROM m WHERE doc_id IN (SELECT doc_id FROM runs)),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT m.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
    (length * 1000 // period)::BIGINT AS exponent_milli, sha256(coalesce(s.t, '')) AS runs_sha256,
    sha256(coalesce(kept.t, array_to_string(ws, ' '))) AS collapsed_sha256
FROM m LEFT JOIN best USING (doc_id) LEFT JOIN spelled s USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@query
def op13_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mixture of sources takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows = mixture.mix(docs, keep=["doc_id"])
    return rows.select("doc_id", *[F.col(f"mix.{c}").alias(c) for c in ("size", "source_size", "target", "taken")])


def _mixture_sql(plan: mixture.Mixture = mixture.Mixture()) -> str:
    up, down, most = *plan.share, plan.share[1] * plan.epochs
    weights = f"[{', '.join(map(str, plan.weights))}]"
    return rf"""WITH
    d AS (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS size,
        md5('{plan.seed}|' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
    s AS (SELECT source, sum(size) AS n, {weights}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(plan.weights)}) + 1] AS w FROM d GROUP BY source),
    r AS (SELECT *, sum(n) OVER () AS total, sum(w) OVER () AS all_w,
        coalesce(sum(n) OVER (ORDER BY n::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lighter,
        coalesce(sum(w) OVER (ORDER BY n::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM s),
    h AS (SELECT *, ({up} * total - {most} * lighter) * w > {most} * n * (all_w - used) AS held FROM r),
    f AS (SELECT *, {up} * total - {most} * coalesce(sum(n) FILTER (WHERE held) OVER (), 0) AS rest, sum(w) FILTER (WHERE NOT held) OVER () AS free_w FROM h),
    t AS (SELECT source, n, CASE WHEN held THEN ({plan.epochs} * n)::DOUBLE ELSE (rest * w)::DOUBLE / ({down} * free_w)::DOUBLE END AS target,
        CASE WHEN held THEN {plan.epochs} * n ELSE rest * w // ({down} * free_w) END AS budget FROM f),
    p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
    SELECT doc_id, size::BIGINT AS size, n::BIGINT AS source_size, target,
        ((budget // greatest(n, 1)) * size + greatest(0, least(size, budget % greatest(n, 1) - before)))::BIGINT AS taken
    FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source"""


ORACLES["op13_source_mixture"] = _mixture_sql()
