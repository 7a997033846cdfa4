"""The operators applied to their whole tables, under the names of the contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import (
    arrow_sequences,
    assignment_lexing,
    bm25_packing,
    cross_parsing,
    feistel_pseudonyms,
    host_paths,
    hyperminhash,
    importance_resampling,
    learned_partitions,
    pattern_grammar,
    periodic_runs,
    prefix_tries,
    suffix_decontamination,
)
from tarmac.llm.tables import table

VOCABULARY = "word_bpe_49k.json"


#: The key of the registered queries; a real corpus has one of its own, kept apart from the data.
PSEUDONYM_KEY = "tarmac"


def op1_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every vec_id divisible by 20, among all rows of ``embeddings``."""
    return learned_partitions.search(table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 20 == 0)


def op2_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all ``documents``."""
    return hyperminhash.groups(table(spark, sf_dir, "documents"))


def op3_pattern_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all ``documents``, learned from ``labels`` outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return pattern_grammar.score(docs, pattern_grammar.learn(docs, table(spark, sf_dir, "labels")))


def op4_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all ``documents`` that ``benchmark`` items hold, and the longest match of each document."""
    found = suffix_decontamination.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return suffix_decontamination.report(found)


def op6_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with personal data pseudonymised under a fixed key."""
    return feistel_pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op5_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of 4096 tokens, a row per piece."""
    return bm25_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), end_id=2)


def op7_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all ``pages``."""
    return host_paths.extract(table(spark, sf_dir, "pages"))


def op8_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights and selection of all ``documents`` towards those of quality 1."""
    target = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return importance_resampling.resample(table(spark, sf_dir, "documents"), target)


def op9_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all ``documents``, written to sequence files and read back."""
    manifest = arrow_sequences.write_sequences(
        table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), end_id=1
    )
    return arrow_sequences.read_documents(manifest)


def op10_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all ``documents``, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return cross_parsing.predict(docs, cross_parsing.learn(docs))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all ``documents``, one in ten of which the contract makes periodic."""
    docs = periodic_runs.with_planted_periods(table(spark, sf_dir, "documents"))
    return periodic_runs.report(periodic_runs.detect(docs))


def op12_assignment_lexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all ``documents``."""
    return assignment_lexing.report(assignment_lexing.scan(table(spark, sf_dir, "documents")))


def op13_prefix_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors of ``embeddings``."""
    return prefix_tries.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_learned_partitions": op1_learned_partitions,
    "op2_hyperminhash": op2_hyperminhash,
    "op3_pattern_grammar": op3_pattern_grammar,
    "op4_suffix_arrays": op4_suffix_arrays,
    "op5_bm25_packing": op5_bm25_packing,
    "op6_feistel_pseudonyms": op6_feistel_pseudonyms,
    "op7_host_paths": op7_host_paths,
    "op8_importance_resampling": op8_importance_resampling,
    "op9_arrow_sequences": op9_arrow_sequences,
    "op10_cross_parsing": op10_cross_parsing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_assignment_lexing": op12_assignment_lexing,
    "op13_prefix_tries": op13_prefix_tries,
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sh AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS s
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c
    FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
    WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, r) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reach.doc_id, e.y FROM reach JOIN e ON e.x = reach.r),
c AS (SELECT doc_id, MIN(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""

_WORDS = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"

_PASSAGES = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(COALESCE({_LOWER}, ''), {_WORDS}) AS ws FROM documents),
b AS (SELECT item_id, ws, least(len(ws), 10) AS size
    FROM (SELECT item_id, regexp_extract_all(COALESCE({_LOWER}, ''), {_WORDS}) AS ws FROM benchmark) WHERE len(ws) > 0),
win AS (
    SELECT DISTINCT item_id, size, array_to_string(ws[i:i+size-1], ' ') AS g
    FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS i FROM b)),
sizes AS (SELECT DISTINCT size FROM b),
grams AS (
    SELECT doc_id, i, size, array_to_string(ws[i:i+size-1], ' ') AS g
    FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, sizes)),
found AS (SELECT doc_id, i, win.size, item_id FROM grams JOIN win USING (g, size)),
hit AS (SELECT doc_id, COUNT(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, COUNT(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id),
spots AS (
    SELECT item, COALESCE(CAST(item_id AS VARCHAR), '') AS name, size, j, array_to_string(ws[j:j+size-1], ' ') AS g
    FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS j FROM (
        SELECT row_number() OVER () AS item, * FROM (SELECT DISTINCT item_id, ws, size FROM b)))),
diagonals AS (
    SELECT doc_id, item, name, size, i, j, i - row_number() OVER (PARTITION BY doc_id, item, i - j ORDER BY i) AS island
    FROM grams JOIN spots USING (g, size)),
longest AS (
    SELECT doc_id, item, name, MIN(i) - 1 AS doc_start, MIN(j) - 1 AS item_start, COUNT(*) + MIN(size) - 1 AS length
    FROM diagonals GROUP BY doc_id, item, name, i - j, island),
best AS (
    SELECT doc_id, COUNT(*) AS n_matches,
        arg_min({{'n': length, 'd': doc_start, 'name': name, 's': item_start}}, (-length, doc_start, name, item_start)) AS m
    FROM longest GROUP BY doc_id)
SELECT d.doc_id, COALESCE(n_matches, 0) AS n_matches, m.n AS longest_words, m.d AS longest_doc_start,
    m.name AS longest_item, m.s AS longest_item_start, CAST(len(ws) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
    sha256(COALESCE(names, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN best USING (doc_id)"""

# CRC-32 of the id's decimal digits: a byte is mixed in, then eight bits are shifted out
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295::BIGINT)"""

_RUNS = f"""
WITH w AS (
    SELECT row_number() OVER () AS r, doc_id, {_CRC32} AS h,
        regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT *, (h // 10) % greatest(len(ws), 1) AS a FROM w),
p AS (SELECT *, 1 + (len(ws) - a) // (3 + (h // 10) % 8) AS p FROM g),
d AS MATERIALIZED (
    SELECT r, doc_id, CASE WHEN h % 10 = 0
        THEN list_transform(range(len(ws)), lambda i: CASE WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % p + 1] END)
        ELSE ws END AS ws FROM p),
fives AS MATERIALIZED (
    SELECT r, len(ws) AS n, unnest(range(len(ws) - 4)) AS i, ws FROM d WHERE len(ws) >= 6),
grams AS MATERIALIZED (SELECT r, n, i, array_to_string(ws[i + 1:i + 5], ' ') AS g FROM fives),
met AS (
    SELECT y.r, y.i, y.i - x.i AS q FROM grams x JOIN grams y
    ON x.r = y.r AND x.g = y.g AND x.i < y.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (
    SELECT r, q, MIN(i) - q AS s, COUNT(*) + 4 + q AS l
    FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM met)
    GROUP BY r, q, island HAVING COUNT(*) + 4 + q >= greatest(6, 4 * q)),
runs AS MATERIALIZED (SELECT r, s, l, MIN(q) AS q FROM stretches GROUP BY r, s, l),
told AS (
    SELECT r, COUNT(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
        arg_min({{'s': s, 'l': l, 'q': q}}, {{'l': -l, 's': s, 'q': q}}) AS best
    FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs),
places AS (SELECT r, unnest(range(len(ws))) AS i, unnest(ws) AS word FROM d WHERE r IN (SELECT r FROM runs)),
collapsed AS (
    SELECT r, string_agg(word, ' ' ORDER BY i) AS kept FROM places ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, COALESCE(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period,
    (1000 * best.l) // best.q AS exponent_milli, sha256(COALESCE(lines, '')) AS runs_sha256,
    sha256(COALESCE(kept, array_to_string(ws, ' '), '')) AS collapsed_sha256
FROM d LEFT JOIN told USING (r) LEFT JOIN collapsed USING (r)"""


def _vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Lloyd rounds one after the other; squared distances by inner products of whole doubles, which are exact."""
    steps = [
        f"""
kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
        list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
part AS MATERIALIZED (
    SELECT r, k, v[k * len(v) // {parts} + 1:(k + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) t(k)),
long AS MATERIALIZED (SELECT r, k, unnest(range(len(x))) AS place, unnest(x) AS value FROM part),
book0 AS MATERIALIZED (SELECT k, r - 1 AS entry, x AS c FROM part WHERE r <= {entries})"""
    ]
    for n in range(rounds + 1):
        steps.append(f"""
met{n} AS MATERIALIZED (
    SELECT r, k, arg_min(entry, (d, entry)) AS entry, MIN(d) AS d FROM (
        SELECT r, k, entry, list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS d
        FROM part JOIN book{n} USING (k)) GROUP BY r, k)""")
        if n < rounds:
            steps.append(f"""
mean{n} AS (
    SELECT k, entry, list(m ORDER BY place) AS c FROM (
        SELECT k, entry, place, floor(SUM(value) / COUNT(*)) AS m FROM long JOIN met{n} USING (r, k) GROUP BY k, entry, place)
    GROUP BY k, entry),
book{n + 1} AS MATERIALIZED (
    SELECT k, entry, COALESCE(mean{n}.c, book{n}.c) AS c FROM book{n} LEFT JOIN mean{n} USING (k, entry))""")
    return f"""
WITH {",".join(steps)},
digest AS (
    SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY k, entry)) AS sha
    FROM book{rounds}),
coded AS (
    SELECT r, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY k) AS code, CAST(SUM(d) AS BIGINT) AS error
    FROM met{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


#: The others have no SQL form (vocabularies, automata, graphs, HTML, noise, lookarounds) and are tested by brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_hyperminhash": _NEAR_DUPLICATES,
    "op4_suffix_arrays": _PASSAGES,
    "op11_periodic_runs": _RUNS,
    "op13_prefix_tries": _vector_codes(),
}
