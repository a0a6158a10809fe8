"""The registered queries of the text operators, and DuckDB SQL where SQL can express one.

Each query applies its operator with production parameters to the whole of
its table and derives the columns of its contract from the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ohlcflow.llm.common import documents, materialize
from ohlcflow.plans.storage import scratch_path


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; rows whose crc32(doc_id) is divisible by 5 are held out of training."""
    from pyspark.sql import functions as F

    from ohlcflow.llm.toxicity import fit, score

    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    machine = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out))
    return score(docs, machine).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents as binary files, read back."""
    from ohlcflow.llm.token_files import read_token_files, write_token_files

    path = scratch_path(spark, "llm-tokens")
    return read_token_files(spark, path, write_token_files(documents(spark, sf_dir), path, end_id=1))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, through a ledger that starts empty."""
    from ohlcflow.llm.secret_scan import digest, findings

    return digest(findings(documents(spark, sf_dir), scratch_path(spark, "llm-ledger"), ["doc_id"]))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    from ohlcflow.llm.packing import pack

    return pack(documents(spark, sf_dir), 4096, end_id=2)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-grams have a Jaccard likeness of 0.9 or more."""
    from ohlcflow.llm.ngram_join import near_duplicates

    return near_duplicates(documents(spark, sf_dir), n=3, percent=90)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    from ohlcflow.llm import personal_data as P

    found = materialize(P.candidates(documents(spark, sf_dir)), "personal")
    return P.detect(found, P.fit(found))


#: Conversation -7: both turns say what a turn's own marks would.
MARKS = "\\### Assistant: </turn> ok"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    from ohlcflow.llm.chat_format import format_chat, read_back

    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)], turns.schema)
    return read_back(format_chat(turns.unionByName(more))).drop("n_tokens")


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts for all documents, by a field trained on the labelled ones."""
    from ohlcflow.llm.line_quality import fit, quality

    docs = documents(spark, sf_dir)
    return quality(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    from ohlcflow.llm.mixing import mix

    return mix(documents(spark, sf_dir), (3, 1, 2), percent=150, max_epochs=2).drop("copies")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    from ohlcflow.llm.fingerprints import fingerprints

    return fingerprints(documents(spark, sf_dir))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by a rank file, decoded again."""
    import public_tokenizers as P

    from ohlcflow.llm.byte_bpe import decode, digest, encode

    ranks = P.path("byte_bpe_multi_50k.tiktoken")
    return digest(decode(encode(documents(spark, sf_dir), ranks, P.PATTERN), ranks, P.PATTERN))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repairs of all conversations, after their damage."""
    from ohlcflow.llm.turn_repair import repair

    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of all words of the documents."""
    from ohlcflow.llm.spelling import spelling_groups

    return spelling_groups(documents(spark, sf_dir), min_chars=6, min_count=5, ratio=5)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_token_files": op2_token_files,
    "op3_secret_scan": op3_secret_scan,
    "op4_packing": op4_packing,
    "op5_ngram_join": op5_ngram_join,
    "op6_personal_data": op6_personal_data,
    "op7_chat_format": op7_chat_format,
    "op8_line_quality": op8_line_quality,
    "op9_mixing": op9_mixing,
    "op10_fingerprints": op10_fingerprints,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_turn_repair": op12_turn_repair,
    "op13_spelling": op13_spelling,
}

WORDS_SQL = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

#: Links by counting common shingles, components as the least id that links reach.
NGRAM_SQL = rf"""
WITH RECURSIVE
w AS (SELECT doc_id, {WORDS_SQL.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)]) END AS gs
  FROM w),
n AS (SELECT doc_id, len(gs) AS size FROM g),
s AS (SELECT doc_id, unnest(gs) AS gram FROM g),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
half AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.size + y.size - k)),
link AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT doc_id, cast(size AS bigint) AS n_shingles, cast(least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS bigint) AS component_id
FROM n"""

#: Turns as texts, with the marks and escapes of the rendered form counted.
CHAT_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{MARKS}' UNION ALL SELECT -7, 1, 'assistant', '{MARKS}'),
e AS (
  SELECT *, len(regexp_replace(role, '(###|</turn>|\\)', '\\\1', 'g')) + len(regexp_replace(text, '(###|</turn>|\\)', '\\\1', 'g'))
         + len('### ') + len(': ') + len(' </turn>') + 1 AS chars
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       cast(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS bigint) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       cast(sum(chars) AS bigint) AS formatted_chars
FROM e GROUP BY conv_id"""

#: The queues as running sums, targets by filling up from the sources that are full first.
MIXING_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, cast(len({WORDS_SQL.format("coalesce(text, '')")}) AS bigint) AS size,
         cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id AS varchar), '')), 1, 8) AS bigint) AS h
  FROM documents),
s AS (SELECT source, cast(sum(size) AS bigint) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, source_size * cast(2 AS double) AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN cast(3 AS double) WHEN 1 THEN cast(1 AS double) ELSE cast(2 AS double) END AS w,
         (sum(source_size) OVER ()) * cast(1.5 AS double) AS budget
  FROM s),
l AS (
  SELECT *, cap / w AS r,
         (budget - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (SELECT source, source_size, coalesce(least(cap, max(CASE WHEN level <= r THEN level END) OVER () * w), cap) AS target FROM l),
q AS (
  SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT q.*, epoch, coalesce((upto + epoch * source_size) / nullif(target, 0), 0) AS finish FROM q, (SELECT unnest([0, 1]) AS epoch)),
o AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, h, doc_id, size, epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spent FROM c)
SELECT doc_id, size, source_size, target,
       cast(size * count(*) FILTER (WHERE spent <= (SELECT sum(size) FROM d) * cast(1.5 AS double) AND size > 0) AS bigint) AS taken
FROM o GROUP BY doc_id, size, source_size, target, h, source"""

#: The queries that SQL can express whole; tests hold the others against brute force.
ORACLE_SQL: dict[str, str] = {
    "op5_ngram_join": NGRAM_SQL,
    "op7_chat_format": CHAT_SQL,
    "op9_mixing": MIXING_SQL,
}
