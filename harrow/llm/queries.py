"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_coding, chat_format, graph_search, line_dedup, mixing, ngram_join, phrase_fingerprint, piece_coding, substring_dedup, token_alignment, toxicity, turn_repair, warc_bundles
from .common import shared_dir, small_batches, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.kept_digest(substring_dedup.dedup_table(_table(spark, sf_dir, "documents")))


def op2_phrase_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_fingerprint.compare_edits(_table(spark, sf_dir, "documents"))


def op3_piece_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_coding.encode(_table(spark, sf_dir, "documents"), keep=["doc_id"], check=True)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "source", "mix_epoch", "mix_slot", "mix_place")


def op5_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = written(warc_bundles.bundles(_table(spark, sf_dir, "pages")), shared_dir(spark), "bundles")
    return warc_bundles.read(bundles).drop("url")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(_table(spark, sf_dir, "documents")).drop("n_checked")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.read_back(chat_format.format_conversations(turns))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_passages(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_all(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(graph_search.usable(_table(spark, sf_dir, "embeddings")), folder := shared_dir(spark), "vectors")
    index = written(graph_search.build_index(rows, 20), folder, "index")
    return graph_search.search_index(index, rows.filter("vec_id % 20 = 0"), 20)


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.audited(_table(spark, sf_dir, "conversations"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(_table(spark, sf_dir, "documents"), groups=False)


def op13_byte_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_coding.encode(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_substring_dedup, op2_phrase_fingerprint, op3_piece_coding, op4_mixing, op5_warc_bundles, op6_ngram_join, op7_chat_format, op8_line_dedup, op9_toxicity, op10_graph_search, op11_turn_repair, op12_token_alignment, op13_byte_coding)}


WORDS = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"

OP1_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
firsts AS (SELECT k, min(doc_id) AS low FROM windows GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN firsts USING (k) WHERE low < doc_id),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) a WHERE NOT EXISTS (FROM gone g WHERE g.doc_id = a.doc_id AND g.p = a.p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

# Base32 takes 20 bits, which are five hex digits, to four letters.
OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), r AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS s, min(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(s, (5 * (i // 4) + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) % 32 + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id > f THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > f THEN f END AS refers_to
FROM r"""

OP6_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS g FROM d),
x AS (SELECT doc_id, unnest(g) AS k, len(g) AS n FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, a AS b FROM edges UNION SELECT r.a, l.b FROM reach r JOIN edges l ON r.b = l.a)
SELECT doc_id, len(g) AS n_shingles, coalesce(c, doc_id) AS component_id FROM s LEFT JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) USING (doc_id)"""

OP7_SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
p AS (SELECT *, coalesce(lag(role) OVER w, '') AS before, row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS last FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(23 + 2 * length(role || text) - length(regexp_replace(role || text, '[\\\\<\\[]', '', 'g')))::BIGINT AS formatted_chars,
  bool_and((before, role) IN (('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user'))) AND NOT bool_or(last AND role NOT IN ('user', 'assistant')) AS valid
FROM p GROUP BY conv_id"""


# Pairs of lines with words that follow each other, their first place each, and the lines that go with a later one.
OP8_SQL = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
f AS (SELECT doc_id, l, list_filter(range(1, len(l) + 1), lambda i: regexp_matches(l[i], '[^ \\t\\x0B\\f\\r]')) AS filled FROM d),
p AS (SELECT doc_id, filled[k] AS i, filled[k + 1] AS j, array_to_string(list_slice(l, filled[k], filled[k + 1]), chr(10)) AS pair FROM (SELECT doc_id, l, filled, unnest(range(1, len(filled))) AS k FROM f WHERE len(filled) > 1)),
o AS (SELECT *, min({'doc_id': doc_id, 'i': i}) OVER (PARTITION BY pair) AS low FROM p),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS n FROM o WHERE doc_id <> low.doc_id OR i > low.i + 1),
r AS (SELECT doc_id, n, l[n] || CASE WHEN n < len(l) THEN chr(10) ELSE '' END AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS n FROM d)),
kept AS (SELECT doc_id, string_agg(line, '' ORDER BY n) AS t FROM r WHERE NOT EXISTS (FROM gone g WHERE g.doc_id = r.doc_id AND g.n = r.n) GROUP BY doc_id)
SELECT doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(t, '') END AS text, (coalesce(strlen(d.text), 0) - coalesce(strlen(t), 0))::BIGINT AS n_removed FROM d LEFT JOIN kept USING (doc_id)"""


# CRC-32 bit by bit: a byte joins the first of its eight steps. A way is (cost, edits, repaired turns, each behind a newline); the best one from
# each state on, w0 to w3, is known from behind a row to before it.
_INSERT = "{{'c': {0}.c + 5, 'a': 'I' || {0}.a, 'r': chr(10) || '{1}:' || {0}.r}}"
_BEST = "list_min([{}, {}])"
_EDIT = "CASE WHEN {0} THEN {{'c': {1}.c + {2}, 'a': '{3}' || {1}.a, 'r': {4} || {1}.r}} END"
_NEXT = {0: ("w2", "user"), 1: ("w2", "user"), 2: ("w3", "assistant"), 3: ("w2", "user")}
_KEEP = {0: "CASE WHEN ini = 's' THEN w1 WHEN ini = 'u' THEN w2 END", 1: "CASE WHEN ini = 'u' THEN w2 END", 2: "CASE WHEN ini = 'a' THEN w3 END", 3: "CASE WHEN ini = 'u' THEN w2 END"}


def _ways(state: int) -> str:
    to, role = _NEXT[state]
    keep = f"({_KEEP[state]})"
    delete = _EDIT.format("true", f"w{state}", 2, "D", "''")
    return f"list_min([{delete}, {_EDIT.format(f'good AND {keep} IS NOT NULL', keep, 'late', 'K', 'own')}, {_EDIT.format('good', to, '1 + late', 'R', f"chr(10) || '{role}:' || text")}]) AS r{state}"


OP11_SQL = f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
c AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, strlen(key) + 1), lambda i: [ascii(key[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295) % 20 AS f FROM k),
d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE f <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS ini, regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g') AS bare FROM d),
s AS (SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini NOT IN ('su', 'ua', 'au') AS ill FROM o),
t AS (SELECT conv_id, i, ini, text, chr(10) || role || ':' || text AS own, blank, dup, turn, coalesce(ill, false) AS ill, NOT blank AND NOT dup AS good, CASE WHEN NOT blank AND NOT dup AND right(bare, 1) NOT IN ('.', '!', '?') THEN 5 ELSE 0 END AS late FROM s),
n AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (late > 0) AS truncated, count(*) FILTER (ill) AS illegal FROM t GROUP BY conv_id),
z AS (SELECT {{'c': 0::BIGINT, 'a': '', 'r': ''}} AS z0),
e AS (SELECT {_INSERT.format('z0', 'assistant')} AS z2, z0 FROM z),
w AS (SELECT conv_id, n AS i, z0 AS w0, {_INSERT.format('z2', 'user')} AS w1, z2 AS w2, z0 AS w3 FROM n, e
  UNION ALL SELECT conv_id, i, {_BEST.format('r0', _INSERT.format('b2', 'user'))}, {_BEST.format('r1', _INSERT.format('b2', 'user'))}, b2, {_BEST.format('r3', _INSERT.format('r2', 'user'))}
  FROM (SELECT *, {_BEST.format('r2', _INSERT.format('r3', 'assistant'))} AS b2 FROM (SELECT w.conv_id, w.i - 1 AS i, {', '.join(map(_ways, range(4)))} FROM w JOIN t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i)))
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w0.c, 0) AS cost, coalesce(w0.a, '') AS audit, sha256(coalesce(substr(w0.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM a.conv_id AND w.i = 0"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1_SQL, "op5_warc_bundles": OP5_SQL, "op6_ngram_join": OP6_SQL, "op7_chat_format": OP7_SQL, "op8_line_dedup": OP8_SQL, "op11_turn_repair": OP11_SQL}
