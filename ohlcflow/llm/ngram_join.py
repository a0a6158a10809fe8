"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

Texts are sets of distinct word n-grams (64-bit hashes for the filters; the
verification compares the n-grams themselves). The join finds every
pair with a Jaccard likeness at or above a threshold:

1. Equal texts (same word sequence) are one class, one row from here on.
2. All n-grams are counted over all documents in a table of fixed width (hashed
   counts); a set's n-grams are ordered rarest first. Any order that is the same
   for all sets gives the same pairs, so shared counts cost time, not results.
3. Two sets that reach the threshold share one of their first n-grams (prefix
   filter), which the smaller one has so early that sets as large as itself could
   still agree. Classes are joined on prefix n-grams, from such an early one to any,
   with the length and positional filters in the join condition.
4. Candidate pairs, made distinct, pass a suffix filter (by bits, not by
   partitioning the suffixes on a pivot): both sets' n-grams are also kept as bits of a short parity vector, and the vectors' Hamming distance bounds
   the sets' difference from below.
5. What is left is verified on the texts.

Where one n-gram heads the sets of many classes, the pairs among them would
grow with the square of the group: such a group first joins every member
with its leaders only, links that hold make components, and then only
pairs of members of different components are joined. No link between components is
lost, and a group of near copies costs a few pairs for each member.

Defined cases: a text without words (null, empty, blank) has no set, links
with nothing and is its own component; a text of fewer words than n is one
n-gram; rows with equal ids are one node; rows with a null id
belong to the component of the documents with the same text (null if there are
none) and link no others. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohlcflow.llm.common import chunks, connected_components, discard, free_name, map_batches, materialize, record_batch

#: Width of the table of hashed counts (one byte each when broadcast), and rows it travels in.
WIDTH, BLOCKS = 1 << 22, 32
#: Tables of counts that are added up at once.
FAN_IN = 64
#: A group of more members than this joins by components.
SMALL_GROUP = 32
#: Leaders of a large group.
LEADERS = 4
#: Hashes of words that a Python worker remembers.
MEMO = 100_000
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


class _WordHash(dict):
    def __missing__(self, w: bytes) -> int:
        import xxhash

        if len(self) > MEMO:
            self.clear()
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


_HASH = _WordHash()


def word_hashes(memo: dict, parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, parts), np.uint64, len(parts))


def gram_hashes(w: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of a word sequence in turn; of the whole sequence if it is shorter, none if it is empty."""
    n = min(n, len(w))
    if not n:
        return w
    h = np.full(len(w) - n + 1, n, np.uint64)
    for k in range(n):
        h = (h ^ w[k : len(w) - n + 1 + k]) * _MIX[0]
        h ^= h >> np.uint64(29)
    for m in _MIX[3:]:
        h = (h ^ (h >> np.uint64(32))) * m
    return h ^ (h >> np.uint64(29))


def split(text: str) -> list[bytes]:
    """Words after lower-casing A-Z; both concern ASCII only, as they do for bytes."""
    return text.encode().lower().split()


def grams(text: str, n: int) -> set[tuple[bytes, ...]]:
    """The set of n-grams itself."""
    w = split(text)
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def rarity(docs: DataFrame, n: int) -> np.ndarray:
    """Classes of frequency (a byte for each of ``WIDTH`` hash values) of the n-grams of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        seen = np.zeros(WIDTH, np.uint32)
        for _, texts in chunks(batches):
            got = [np.unique(gram_hashes(word_hashes(_HASH, split(t)), n)) for t in texts]
            if got:
                at, times = np.unique(np.concatenate(got) % np.uint64(WIDTH), return_counts=True)
                seen[at.astype(np.int64)] += times.astype(np.uint32)
        pack, task = zstandard.ZstdCompressor(level=1).compress, TaskContext.get().partitionId()
        schema = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])
        blocks = [pack(x.tobytes()) for x in seen.reshape(BLOCKS, -1)]
        yield record_batch(schema, [list(range(BLOCKS)), [task] * BLOCKS, blocks])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        total = np.zeros(WIDTH // BLOCKS, np.uint32)
        for x in rows["counts"]:
            total += np.frombuffer(unpack(x), np.uint32)
        return pd.DataFrame({"block": rows["block"][:1], "part": rows["part"][:1], "counts": [zstandard.ZstdCompressor(level=1).compress(total.tobytes())]})

    schema = "block int, part int, counts binary"
    texts = docs.select("text")
    parts, tasks = map_batches(texts, count, schema), texts.rdd.getNumPartitions()
    while True:  # sums of ``FAN_IN`` tables each, over and over
        tasks = -(-tasks // FAN_IN)
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("block", "part").applyInPandas(add, schema)
        if tasks <= 1:
            break
    total = parts.collect()
    import zstandard

    out = np.zeros((BLOCKS, WIDTH // BLOCKS), np.uint32)
    for r in total:
        out[r.block] = np.frombuffer(zstandard.ZstdDecompressor().decompress(r.counts), np.uint32)
    return np.minimum(255, np.log2(out.reshape(-1) + 1.0) * 8).astype(np.uint8)


def bit_vector(hashes: np.ndarray) -> bytes:
    """Parities of the hashes' low bits, over a power of two of about as many bits as there are hashes."""
    width = max(64, 1 << (max(1, len(hashes)) - 1).bit_length())
    odd = np.bincount((hashes % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def distance_bound(a: bytes, b: bytes) -> int:
    """At most the size of the symmetric difference of the two sets; the longer vector is folded to the shorter."""
    if len(a) < len(b):
        a, b = b, a
    x, size = int.from_bytes(a, "little"), len(a)
    while size > len(b):
        size //= 2
        x = (x >> 8 * size) ^ (x & ((1 << 8 * size) - 1))
    return (x ^ int.from_bytes(b, "little")).bit_count()


def signatures(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, size, key, prefix, bits): size and identity of every set, its prefix rarest first, its bit vector."""
    classes = docs.sparkSession.sparkContext.broadcast(rarity(docs, n))  # WIDTH bytes

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        schema = pa.schema([("doc_id", pa.int64()), ("size", pa.int64()), ("key", pa.binary()), ("prefix", pa.list_(pa.int64())), ("bits", pa.binary())])
        common = classes.value
        for (ids,), texts in chunks(batches):
            rows = []
            for doc, text in zip(ids, texts, strict=True):
                parts = split(text)
                h = np.unique(gram_hashes(word_hashes(_HASH, parts), n))
                if not len(h):
                    rows.append((doc, 0, None, None, None))
                    continue
                rare = np.lexsort((h, common[(h % np.uint64(WIDTH)).astype(np.int64)]))
                first = len(h) - -(-percent * len(h) // 100) + 1
                rows.append((doc, len(h), hashlib.sha256(b" ".join(parts)).digest()[:16], h[rare[:first]].astype(np.int64), bit_vector(h)))
            yield record_batch(schema, list(zip(*rows, strict=True)))

    return map_batches(docs.select("doc_id", "text"), sign, "doc_id long, size long, key binary, prefix array<long>, bits binary")


def _near(a: str, b: str, percent: int):
    """Length and positional filter: the n-grams that two sets can still share from a common one on are enough."""
    need = F.ceil(F.lit(percent) * (F.col(f"{a}.size") + F.col(f"{b}.size")) / F.lit(100.0 + percent) - 1e-9)
    left = F.least(F.col(f"{a}.size") - F.col(f"{a}.pos"), F.col(f"{b}.size") - F.col(f"{b}.pos"))
    return (100 * F.least(F.col(f"{a}.size"), F.col(f"{b}.size")) >= percent * F.greatest(F.col(f"{a}.size"), F.col(f"{b}.size"))) & (left >= need)


def _ordered(a: str, b: str):
    """The first one is the smaller set, of equally large ones that of the lesser id."""
    return (F.col(f"{a}.size") < F.col(f"{b}.size")) | ((F.col(f"{a}.size") == F.col(f"{b}.size")) & (F.col(f"{a}.rep") < F.col(f"{b}.rep")))


def shared_grams(classes: DataFrame, percent: int) -> DataFrame:
    """(rep, size, pos, gram, heads_pair, members) of the prefix n-grams that two classes or more have and some class may head a pair with.

    At the rarest n-gram that two like sets share, the smaller one has as many left as any
    set as large as itself would need (``heads_pair``), which is a shorter prefix than that
    which finds smaller partners. An n-gram that no class has so early, as those of a
    template that unlike pages fill in, makes no pair and is dropped before the join.
    """
    first = classes.select("rep", "size", F.posexplode("prefix").alias("pos", "gram"))
    need = F.ceil(F.lit(2 * percent) * F.col("size") / F.lit(100.0 + percent) - 1e-9)
    first = first.withColumn("heads_pair", F.col("size") - F.col("pos") >= need)
    # a row for each n-gram and task: numbers of members, not the members
    groups = first.groupBy("gram").agg(F.count("*").alias("members"), F.count_if("heads_pair").alias("heads"))
    return first.join(groups.where("members > 1 and heads > 0").drop("heads"), "gram")


def _suffix_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs whose bit vectors leave the threshold possible."""
    info = classes.select("rep", "size", "bits")
    both = pairs.distinct()
    for side in "ab":
        both = both.join(info.select(F.col("rep").alias(side), F.col("size").alias(f"n{side}"), F.col("bits").alias(f"v{side}")), side)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for na, nb, va, vb in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True):
                # shared s, difference d: s = (na + nb - d) / 2, and 100 s >= percent (na + nb - s)
                s = (na + nb - distance_bound(va, vb)) // 2
                ok.append(100 * s >= percent * (na + nb - s))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return map_batches(both.select("a", "b", "na", "nb", "va", "vb"), pick, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs that reach the threshold, by the n-grams of their texts."""
    for side in "ab":
        pairs = pairs.join(texts.select(F.col("rep").alias(side), F.col("text").alias(f"t{side}")), side)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sets = None, None
        for batch in batches:
            ok = []
            for k in range(batch.num_rows):
                ta, tb = batch.column(2)[k].as_py(), batch.column(3)[k].as_py()
                if ta != last:
                    last, sets = ta, grams(ta, n)
                other = grams(tb, n)
                shared = len(sets & other)
                ok.append(100 * shared >= percent * (len(sets) + len(other) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return map_batches(pairs.select("a", "b", "ta", "tb"), check, "a long, b long")


def links(docs: DataFrame, n: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """(signatures with their class ``rep``, links): enough links between classes to connect whatever the threshold connects.

    Between classes of a small group these are all links; in a large group, links
    inside a component found already are left out.
    """
    signed = materialize(signatures(docs, n, percent), "grams")
    named = signed.where("doc_id is not null and size > 0")
    classes = materialize(
        named.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("size").alias("size"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits")), "classes"
    )
    shared = materialize(shared_grams(classes, percent), "shared")
    small, large = shared.where(F.col("members") <= SMALL_GROUP), shared.where(F.col("members") > SMALL_GROUP)

    def pair(x: DataFrame, y: DataFrame, on) -> DataFrame:
        joined = x.alias("x").join(y.alias("y"), on & _near("x", "y", percent))
        return joined.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))

    same = F.col("x.gram") == F.col("y.gram")
    pairs = pair(small.where("heads_pair"), small, same & _ordered("x", "y"))
    # a leader for each part of a large group, so that one odd leader does not stand for all
    slot = F.pmod(F.xxhash64("rep"), F.lit(LEADERS))
    leaders = large.groupBy("gram", slot.alias("slot")).agg(F.min(F.struct("rep", "size", "pos")).alias("l")).select("gram", "l.rep", "l.size", "l.pos")
    pairs = pairs.unionAll(pair(large, leaders, same & (F.col("x.rep") != F.col("y.rep"))))
    likely = materialize(_suffix_filter(pairs, classes, percent), "likely")
    members = likely.select(F.col("a").alias("id")).union(likely.select("b")).union(large.select("rep")).distinct()
    texts = materialize(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(members, F.col("doc_id") == F.col("id"), "left_semi")
        .select(F.col("doc_id").alias("rep"), "text")
        .distinct(),
        "texts",
    )
    found = materialize(_verified(likely, texts, n, percent), "links")
    out = found
    if not large.isEmpty():
        placed, rest = _across(large, connected_components(found), percent)
        more = _suffix_filter(rest.join(likely, ["a", "b"], "left_anti"), classes, percent)
        out = found.unionAll(materialize(_verified(more, texts, n, percent), "links"))
        discard(placed)
    discard(classes, shared, likely, texts)
    return signed, out


def _across(large: DataFrame, component: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(members with their components, pairs of members of a group that are in different ones): joined by (n-gram, component), never all members with all."""
    placed = large.join(component, F.col("rep") == F.col("node"), "left").withColumn("component", F.coalesce("component", "rep"))
    placed = materialize(placed.select("gram", "rep", "size", "pos", "heads_pair", "component"), "placed")
    # the filters hold for two components if they can hold for some pair of their members
    span = [F.min("size").alias("lo"), F.max("size").alias("hi"), F.max(F.col("size") - F.col("pos")).alias("left")]
    parts = placed.groupBy("gram", "component").agg(*span)
    mixed = parts.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    # the smaller one of a pair is a member that may head it; those are few where a group's n-gram is common to unlike texts
    heads = placed.where("heads_pair")
    p, q = heads.groupBy("gram", "component").agg(*span).join(mixed, "gram").alias("p"), parts.join(mixed, "gram").alias("q")
    length = (100 * F.col("p.hi") >= percent * F.col("q.lo")) & (100 * F.col("q.hi") >= percent * F.col("p.lo"))
    need = F.ceil(F.lit(percent) * (F.col("p.lo") + F.col("q.lo")) / F.lit(100.0 + percent) - 1e-9)
    place = F.least("p.left", "q.left") >= need
    two = p.join(q, (F.col("p.gram") == F.col("q.gram")) & (F.col("p.component") != F.col("q.component")) & length & place)
    two = two.select(F.col("p.gram").alias("g"), F.col("p.component").alias("c"), F.col("q.component").alias("d"))
    x = heads.alias("x").join(two, (F.col("x.gram") == F.col("g")) & (F.col("x.component") == F.col("c")))
    both = x.join(placed.alias("y"), (F.col("y.gram") == F.col("g")) & (F.col("y.component") == F.col("d")) & _ordered("x", "y") & _near("x", "y", percent))
    return placed, both.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    signed, found = links(docs, n, percent)
    names = signed.where("doc_id is not null and size > 0").groupBy("key").agg(F.min("doc_id").alias("rep"))
    same_id = signed.where("doc_id is not null and size > 0").select("key", "doc_id").distinct()
    # rows with equal ids are one node: their classes are linked
    both = same_id.join(names, "key").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    twice = same_id.groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1").select("doc_id")
    extra = both.join(twice, F.col("a") == F.col("doc_id"), "left_semi")
    component = connected_components(found.unionAll(extra))
    whole = names.join(component, F.col("rep") == F.col("node"), "left").select(F.col("key").alias("_key"), F.coalesce("component", "rep").alias("component_id"))
    out = signed.join(whole, F.col("key") == F.col("_key"), "left")
    return out.select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def distinct_documents(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each component, that of the least id (then place in the table), columns unchanged.

    Where ids do not tell all rows apart, rows are told apart by a number of their
    own: rows with equal ids are compared like any others, and rows with a null id,
    which come last, too. Rows without words are linked with nothing and all stay.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("_n"))
    if ids.where("doc_id is null or _n > 1").isEmpty():
        kept = near_duplicates(docs, n, percent).where("component_id = doc_id").select(F.col("doc_id").alias("_kept"))
        return docs.join(kept, F.col("doc_id") == F.col("_kept"), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
    row = free_name(docs, "_row_of_join")
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "join-docs")
    group = near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"), n, percent)
    ids = numbered.select(F.col(row).alias("_row"), F.col("doc_id").alias("_id"))
    first = F.min(F.struct(F.col("_id").isNull().alias("null"), "_id", "_row")).alias("first")
    kept = group.join(ids, F.col("doc_id") == F.col("_row")).groupBy("component_id").agg(first).select(F.col("first._row").alias("_kept"))
    return numbered.join(kept, F.col(row) == F.col("_kept"), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
