"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed: its blob is the SHA-256 of
its text. The ledger (Parquet, appended to) has, for each blob, the
rule versions it was scanned with and what they found. A scan ships the text
of each distinct blob once, compressed, drops the (blob, rule version) pairs
the ledger has, scans the rest and appends; findings are joined back to all
paths that hold the blob. A blob held by a third of all paths is one row after
the map side, and the join back is a shuffled join that AQE can split.

Defined cases: a null text is the empty blob, without findings; null ids and
repeated rows each get their blob's findings; an empty table gives none.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ohlcflow.llm.common import chunks, of_kind, record_batch, span_digest
from ohlcflow.plans.storage import path_exists

Spans = list[tuple[int, int]]
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: Literals of which the keyword of an assignment has one.
_WORDS = ("passw", "secret", "token", "api")


def _assign(text: str) -> Spans:
    low = text.lower()
    if not any(w in low for w in _WORDS):
        return []
    return [m.span() for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]


def _pattern(pattern: str, literal: str = "") -> Callable[[str], Spans]:
    find = re.compile(pattern).finditer
    return lambda text: [m.span() for m in find(text)] if literal in text else []


#: Rules by name: (version, scanner). The first three are the base kinds; a changed rule gets a new version.
#: Runs are greedy, so a run with too few characters has no longer match further on: the lengths can stand in the patterns.
RULES: dict[str, tuple[int, Callable[[str], Spans]]] = {
    "assign": (1, _assign),
    "access": (1, _pattern(r"AKIA[A-Z0-9]{16,}", "AKIA")),
    "hex": (1, _pattern(r"[0-9a-f]{24,}")),
    "private_key": (1, _pattern(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", "PRIVATE KEY-----")),
    "web_token": (1, _pattern(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "eyJ")),
    "code_host": (1, _pattern(r"gh[pousr]_[A-Za-z0-9]{36,}", "gh")),
    "chat_bot": (1, _pattern(r"xox[abprs]-[A-Za-z0-9-]{10,}", "xox")),
}
BASE = ["assign", "access", "hex"]
_LEDGER = "blob binary, rules array<string>, findings array<struct<rule: string, start: long, end: long>>"


def rule_versions(rules: dict | None = None) -> list[str]:
    return [f"{name}@{version}" for name, (version, _) in (rules or RULES).items()]


def scan(text: str, rules: list[str], known: dict | None = None) -> list[dict]:
    """Findings of the named rule versions in a text, in code points."""
    known = known or RULES
    return [{"rule": r, "start": a, "end": b} for r in rules for a, b in known[r.partition("@")[0]][1](text)]


def blob_id(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def blobs(texts: DataFrame) -> DataFrame:
    """(blob, data): each distinct text once, zstd-compressed before it is shuffled."""

    def address(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack, schema = zstandard.ZstdCompressor(level=1).compress, pa.schema([("blob", pa.binary()), ("data", pa.binary())])
        seen: set[bytes] = set()  # of this task: 32 bytes a text of a bounded split
        for _, part in chunks(batches):
            rows = []
            for text in part:
                raw = text.encode()
                if (blob := hashlib.sha256(raw).digest()) not in seen:
                    seen.add(blob)
                    rows.append((blob, pack(raw)))
            if rows:
                yield record_batch(schema, list(zip(*rows, strict=True)))

    return texts.select("text").mapInArrow(address, "blob binary, data binary").dropDuplicates(["blob"])


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(path)


def scan_new(texts: DataFrame, ledger: str, rules: dict | None = None) -> None:
    """Scans what the ledger at path ``ledger`` lacks and appends it there."""
    spark, rules = texts.sparkSession, rules or RULES
    wanted = F.array(*map(F.lit, rule_versions(rules)))
    found = blobs(texts)
    if path_exists(spark, ledger):
        done = read_ledger(spark, ledger).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
        found = found.join(done, "blob", "left")
    else:
        found = found.withColumn("done", F.array().cast("array<string>"))
    todo = found.select("blob", "data", F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>"))).alias("rules")).where(F.size("rules") > 0)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        finding = pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        schema = pa.schema([("blob", pa.binary()), ("rules", pa.list_(pa.string())), ("findings", pa.list_(finding))])
        for batch in batches:
            keys, data, names = batch.columns
            todo = names.to_pylist()
            hits = [scan(unpack(x.as_py()).decode(), r, rules) for x, r in zip(data, todo, strict=True)]
            yield record_batch(schema, [keys.to_pylist(), todo, hits])

    todo.mapInArrow(look, _LEDGER).write.mode("append").parquet(ledger)


def findings(versions: DataFrame, ledger: str, columns: list[str], rules: dict | None = None) -> DataFrame:
    """``columns`` of every version (path, commit, ...) with its blob and the findings of the current rule versions.

    Versions may come in any number of tables over time; only what the ledger
    has not seen is scanned.
    """
    spark = versions.sparkSession
    scan_new(versions, ledger, rules)
    current = F.array(*map(F.lit, rule_versions(rules)))
    known = (
        read_ledger(spark, ledger)
        .select("blob", F.filter("findings", lambda f: F.array_contains(current, f["rule"])).alias("found"))
        .where(F.size("found") > 0)
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("found")).alias("findings"))
    )
    names = versions.select(*[F.col(c) for c in columns], blob_id("text").alias("blob"))
    none = F.array().cast("array<struct<rule: string, start: long, end: long>>")
    return names.join(known, "blob", "left").withColumn("findings", F.coalesce("findings", none))


def digest(found: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """The contract's columns from ``findings``."""
    kinds = kinds or list(RULES)
    at = F.array(*map(F.lit, rule_versions()))
    spans = F.transform("findings", lambda f: F.struct((F.array_position(at, f["rule"]) - 1).cast("int").alias("kind"), f["start"].alias("start"), f["end"].alias("end")))
    found = found.withColumn("_spans", spans)
    base = F.filter("_spans", lambda s: s["kind"] < len(BASE))
    return found.select(
        "doc_id",
        *[of_kind("_spans", k).alias(f"n_{name}") for k, name in enumerate(BASE)],
        F.sha2(span_digest(base, kinds, by_start=True), 256).alias("base_sha256"),
        span_digest(F.col("_spans"), kinds, by_start=True).alias("spans"),
    )
