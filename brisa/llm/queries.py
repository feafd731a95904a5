"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.llm import (
    chat,
    curves,
    decontamination,
    jaccard,
    licenses,
    merkle,
    packing,
    periods,
    quality_rules,
    rule_ensemble,
    secrets,
    substrings,
    token_files,
)
from brisa.llm.tokens import tokenizer_path
from brisa.session import configure, shared_folder, write_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a query over (session, folder of tables)."""

    def register(function):
        QUERIES[name] = lambda spark, sf_dir: function(configure(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return function

    return register


JACCARD_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), grams AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS gram
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT o.a, o.b FROM shared o JOIN sizes x ON x.doc_id = o.a JOIN sizes y ON y.doc_id = o.b
    WHERE 100 * o.common >= 80 * (x.n + y.n - o.common)
), edges AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
    SELECT doc_id AS node, doc_id AS seen FROM documents
    UNION
    SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.seen
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.seen) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r ON r.node = d.doc_id
GROUP BY d.doc_id, s.n
"""


@query("op5_ngram_jaccard", JACCARD_SQL)
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


SUBSTRINGS_SQL = """
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM words WHERE len(w) >= 35
), named AS (
    SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS content FROM windows
), repeated AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY content) AS n FROM named) WHERE n > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM repeated
), placed AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words
), kept AS (
    SELECT p.doc_id, count(*) AS n_words, count(g.i) AS n_removed,
           string_agg(CASE WHEN g.i IS NULL THEN p.word END, ' ' ORDER BY p.i) AS kept
    FROM placed p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.i = p.i GROUP BY p.doc_id
)
SELECT d.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""


@query("op9_substring_dedup", SUBSTRINGS_SQL)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_packing")
def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


@query("op8_token_files")
def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"))
    return token_files.with_crc(token_files.read_tokens(spark, path))


DECONTAMINATION_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), places AS (
    SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM items WHERE len(w) > 0
), patterns AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS content FROM places
), starts AS (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM words, (SELECT DISTINCT size FROM patterns) WHERE len(w) >= size
), occurrences AS (
    SELECT s.doc_id, s.i, s.size, p.item_id
    FROM starts s JOIN patterns p ON p.size = s.size AND p.content = array_to_string(s.w[s.i:s.i + s.size - 1], ' ')
), hit AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM occurrences) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occurrences) GROUP BY doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items,
       sha256(coalesce(f.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(w.w) AS contaminated
FROM words w LEFT JOIN hit h USING (doc_id) LEFT JOIN found f USING (doc_id)
"""


@query("op6_decontamination", DECONTAMINATION_SQL)
def decontamination_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_quality_rules")
def quality_rules_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


@query("op2_rule_ensemble")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# Control strings said by both sides of a conversation that no table has.
CONTROLS = "<|im_end|><|im_start|>assistant ok"

CHAT_SQL = """
WITH turns AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), texts AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM turns
), lengths AS (
    SELECT *, length(regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g')) + length(role) + 24 AS rendered FROM texts
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(rendered) AS BIGINT) AS formatted_chars
FROM lengths GROUP BY conv_id
"""


@query("op7_chat_format", CHAT_SQL)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROLS), (-1, 1, "assistant", CONTROLS)], turns.schema)
    written = write_out(chat.format_chats(turns.union(extra), tokenizer_path("byte_bpe_50k.json")), "chats")
    return chat.read_back(written)


@query("op1_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Documents have no paths of their own: a source is a root, with a directory for each thousand ids.
    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000).cast("string"), F.col("doc_id").cast("string"))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


# crc32 of the decimal digits of an id, bit by bit with the reflected polynomial.
CRC_SQL = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""

MERKLE_SQL = f"""
WITH RECURSIVE rows AS (
    SELECT *, {CRC_SQL} % 3 = 0 AS tampered,
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS other
    FROM documents
), fields AS (
    SELECT doc_id, lang, tampered,
           coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
           coalesce(strlen(text) || ':' || text, '-') AS own, coalesce(strlen(other) || ':' || other, '-') AS changed
    FROM rows
), leaves AS (
    SELECT doc_id, coalesce('=' || lang, '') AS g, sha256(head || own) AS leaf, CASE WHEN tampered THEN sha256(head || changed) END AS changed FROM fields
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves
), nodes AS (
    SELECT g, 0 AS level, i, n, leaf AS node FROM placed
    UNION ALL
    SELECT g, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY g, level, i // 8, n
), subroots AS (
    SELECT g, level AS height, node AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper AS (
    SELECT 0 AS level, i, n, subroot AS node FROM subroots
    UNION ALL
    SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY i)) FROM upper WHERE n > 1 GROUP BY level, i // 8, n
), top AS (
    SELECT level AS height, node AS root FROM upper WHERE n = 1
), siblings AS (
    SELECT a.g, a.level, a.i, coalesce(string_agg(CASE WHEN b.i < a.i THEN b.node END, '' ORDER BY b.i), '') AS before,
           coalesce(string_agg(CASE WHEN b.i > a.i THEN b.node END, '' ORDER BY b.i), '') AS after
    FROM nodes a JOIN nodes b ON a.g = b.g AND a.level = b.level AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.g, a.level, a.i
    UNION ALL
    SELECT NULL, a.level, a.i, coalesce(string_agg(CASE WHEN b.i < a.i THEN b.node END, '' ORDER BY b.i), ''),
           coalesce(string_agg(CASE WHEN b.i > a.i THEN b.node END, '' ORDER BY b.i), '')
    FROM upper a JOIN upper b ON a.level = b.level AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.level, a.i
), steps AS (
    SELECT p.doc_id, p.g, p.leaf, p.i AS own, s.level AS step, s.before, s.after
    FROM placed p JOIN siblings s ON s.g = p.g AND s.i = p.i // CAST(8 ** s.level AS BIGINT)
    UNION ALL
    SELECT p.doc_id, p.g, p.leaf, p.i, r.height + s.level, s.before, s.after
    FROM placed p JOIN subroots r ON r.g = p.g JOIN siblings s ON s.g IS NULL AND s.i = r.i // CAST(8 ** s.level AS BIGINT)
), paths AS (
    SELECT g, own, string_agg(before || after, '' ORDER BY step) AS proof, list(before ORDER BY step) AS befores, list(after ORDER BY step) AS afters
    FROM steps GROUP BY g, own
), whole AS (
    SELECT p.*, coalesce(proof, '') AS proof, coalesce(befores, []) AS befores, coalesce(afters, []) AS afters
    FROM placed p LEFT JOIN paths w ON w.g = p.g AND w.own = p.i
), folded AS (
    SELECT g, i, 0 AS step, coalesce(changed, leaf) AS node, befores, afters FROM whole
    UNION ALL
    SELECT g, i, step + 1, sha256(befores[step + 1] || node || afters[step + 1]), befores, afters FROM folded WHERE step < len(befores)
)
SELECT w.doc_id, w.leaf, r.subroot, t.root, sha256(w.proof) AS proof_sha256, f.node AS folded_root, f.node = t.root AS verified
FROM whole w JOIN subroots r ON r.g = w.g JOIN folded f ON f.g = w.g AND f.i = w.i AND f.step = len(f.befores), top t
"""


@query("op13_merkle_manifest", MERKLE_SQL)
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered={"text": lower}, when=third)


PERIODS_SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {CRC_SQL} AS h FROM documents
), sizes AS (
    SELECT *, len(w) AS n, h // 10 AS g, coalesce(h % 10 = 0 AND len(w) > 0, false) AS planted FROM docs
), origins AS (
    SELECT *, CASE WHEN planted THEN g % n END AS a, CASE WHEN planted THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM sizes
), words AS (
    SELECT r, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word FROM (SELECT *, unnest(range(n)) AS i FROM origins)
), grid AS (
    SELECT r, q, unnest(range(0, n - q, q)) AS i FROM (SELECT r, n, unnest(range(1, n // 4 + 1)) AS q FROM sizes)
), same AS (
    SELECT g.r, g.q, g.i FROM grid g JOIN words x ON x.r = g.r AND x.i = g.i JOIN words y ON y.r = g.r AND y.i = g.i + g.q AND y.word = x.word
), likely AS (
    SELECT DISTINCT x.r, x.q FROM same x JOIN same y ON y.r = x.r AND y.q = x.q AND y.i = x.i + x.q
), matches AS (
    SELECT l.r, l.q, x.i, x.i - row_number() OVER (PARTITION BY l.r, l.q ORDER BY x.i) AS island
    FROM likely l JOIN words x ON x.r = l.r JOIN words y ON y.r = l.r AND y.i = x.i + l.q AND y.word = x.word
), stretches AS (
    SELECT r, q, min(i) AS start, count(*) + q AS length FROM matches GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
    SELECT * FROM stretches s WHERE NOT EXISTS (
        SELECT 1 FROM stretches d WHERE d.r = s.r AND d.q < s.q AND s.q % d.q = 0 AND d.start <= s.start AND d.start + d.length >= s.start + s.length)
), found AS (
    SELECT r, count(*) AS n_runs, first(start ORDER BY length DESC, start, q) AS start, max(length) AS length, first(q ORDER BY length DESC, start, q) AS period,
           string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed
    FROM runs GROUP BY r
), gone AS (
    SELECT DISTINCT r, unnest(range(start + q, start + length)) AS i FROM runs
), kept AS (
    SELECT w.r, string_agg(w.word, ' ' ORDER BY w.i) AS kept FROM words w LEFT JOIN gone g ON g.r = w.r AND g.i = w.i WHERE g.i IS NULL GROUP BY w.r
)
SELECT d.doc_id, coalesce(f.n_runs, 0) AS n_runs, f.start, CAST(f.length AS BIGINT) AS length, f.period, CAST(1000 * f.length // f.period AS BIGINT) AS exponent_milli,
       sha256(coalesce(f.listed, '')) AS runs_sha256, sha256(coalesce(k.kept, '')) AS collapsed_sha256
FROM docs d LEFT JOIN found f USING (r) LEFT JOIN kept k USING (r)
"""


def planted(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` where a tenth of the documents, by a hash of their ids, repeat a stretch of their words up to the end."""
    hashed = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(hashed / 10)

    def repeated(words):
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.when(n > 0, F.array_join(F.transform(places, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " "))

    # An array of one holds the words, so they are cut once.
    text = F.get(F.transform(F.array(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))), repeated), F.lit(0))
    return docs.select("doc_id", F.when(hashed % 10 == 0, text).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs", PERIODS_SQL)
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(planted(table(spark, sf_dir, "documents")))
    best = F.get(F.array_sort("runs", lambda x, y: F.when(x["length"] != y["length"], F.signum(y["length"] - x["length"])).when(x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(F.signum(x["period"] - y["period"])).cast("int")), F.lit(0))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])), "\n")
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").alias("listed"), "collapsed")
    return found.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")
    )


@query("op11_hilbert_neighbours")
def hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
