"""Bar messages: one JSON object per bar in a ``value`` column.

Works on any DataFrame with a ``value`` column (string or UTF-8 bytes): a
batch read of files, a streaming file source, or a Kafka source when its
connector is on the classpath.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import BAR_FIELDS, RAW_BAR_SCHEMA

_PARSED, _REJECT, _CORRUPT = "_msg", "_reject", "_corrupt"
#: Stream order of a message: the splits in order, and the position inside one.
SPLIT, POSITION = ("_file", "_start"), "_position"
#: Offsets of a topic partition that make one split.
OFFSETS_PER_SPLIT = 1 << 16
#: Text of a message as :func:`encode_messages` writes it, without escapes, with a symbol
#: and a date of the calendar (no 29 February).
_WRITTEN_WITH_KEY = (
    r'^\{"symbol":"[^"\\]++","date":"(?:1[6-9]|[2-9]\d)\d\d-'
    r'(?:(?:0[1-9]|1[0-2])-(?:0[1-9]|1\d|2[0-8])|(?:0[13-9]|1[0-2])-(?:29|30)|(?:0[13578]|1[02])-31)"'
    r'(?:,"(?:open|high|low|close|volume)":(?:"[^"\\]*+"|null))*+\}$'
)


def encode_messages(bars: DataFrame) -> DataFrame:
    """Bars -> ``value`` = JSON object with all seven fields as strings (NULL written as null)."""
    fields = F.struct(*[F.col(c).cast("string").alias(c) for c in BAR_FIELDS])
    return bars.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def written_with_key(value: str = "value") -> Column:
    """True only of messages that decode to a bar with symbol and date, or are rejected.

    Tells by the text, without a parse, for messages in the usual form; others are
    false, whatever they hold.
    """
    return F.coalesce(F.col(value).cast("string").rlike(_WRITTEN_WITH_KEY), F.lit(False))


def _parsed(df: DataFrame) -> DataFrame:
    """The input with one parsed struct column ``_msg`` and ``_reject``.

    The value is parsed once: the generator keeps the optimizer from copying
    the parse into the filter and into every field.
    """
    schema = StructType([*RAW_BAR_SCHEMA.fields, StructField(_CORRUPT, StringType())])
    text = F.col("value").cast("string")
    parse = F.from_json(text, schema, {"columnNameOfCorruptRecord": _CORRUPT})
    out = df.select("*", F.explode(F.array(parse)).alias(_PARSED))
    # one JSON object and nothing behind it; the parser itself stops at the object's end
    whole = F.trim(text).startswith("{") & F.trim(text).endswith("}")
    reject = F.col(_PARSED).isNull() | F.col(f"{_PARSED}.{_CORRUPT}").isNotNull() | ~F.coalesce(whole, F.lit(False))
    return out.withColumn(_REJECT, reject)


def decode_messages(
    messages: DataFrame, keep: tuple[str, ...] = (), max_messages: int | None = None
) -> DataFrame:
    """JSON ``value`` -> seven nullable string columns.

    Unknown keys are ignored, absent keys are NULL (an object without any of
    the keys is a row of NULLs); rows that are not one JSON object go to
    :func:`message_rejects` instead. ``keep`` carries extra input columns (e.g.
    a source offset). ``max_messages`` bounds the read (a falsy value means
    unlimited): messages with their stream order (:func:`message_table`,
    :func:`topic_order`) are cut there by :func:`first_messages`, malformed ones
    counted; of others any ``max_messages`` decoded rows are taken.
    """
    if max_messages and {*SPLIT, POSITION} <= set(messages.columns):
        messages, max_messages = first_messages(messages, max_messages), None
    out = _parsed(messages).filter(~F.col(_REJECT)).select(
        *[F.col(f"{_PARSED}.{c}").alias(c) for c in BAR_FIELDS], *keep
    )
    return out.limit(max_messages) if max_messages else out


def message_rejects(messages: DataFrame) -> DataFrame:
    """Input rows whose ``value`` is not one JSON object."""
    return _parsed(messages).filter(_REJECT).drop(_PARSED, _REJECT)


def message_table(spark: SparkSession, path: str) -> DataFrame:
    """Message files as a table: ``value`` and its stream order, by file path,
    then by the line's place in the file."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias(SPLIT[0]),
        F.col("_metadata.file_block_start").alias(SPLIT[1]),
        # rises along the lines of one split, which a single task reads
        F.monotonically_increasing_id().alias(POSITION),
    )


def topic_order(messages: DataFrame) -> DataFrame:
    """A topic read (``partition``, ``offset``, perhaps ``topic``) with its stream order:
    by partition, then by offset."""
    return messages.withColumns(
        {
            SPLIT[0]: F.concat_ws("/", F.col("topic") if "topic" in messages.columns else F.lit(""), F.format_string("%010d", F.col("partition").cast("long"))),
            SPLIT[1]: F.floor(F.col("offset") / OFFSETS_PER_SPLIT) * OFFSETS_PER_SPLIT,
            POSITION: F.col("offset"),
        }
    )


def first_messages(
    messages: DataFrame, max_messages: int, split: Sequence[str] = SPLIT, position: str = POSITION
) -> DataFrame:
    """The first ``max_messages`` rows in the order (``split``, ``position``); the same on every run.

    Rows are counted per split and the counts summed up in order (one row a
    split). Splits that end before the bound are taken whole, each where it is
    read; only the one split that holds the bound (a file split, or 65536
    offsets) is sorted and cut.
    """
    if max_messages <= 0:
        return messages.limit(0)
    counts = messages.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"))
    along = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("_upto", F.sum("_n").over(along))
    bound = F.lit(max_messages)
    cut = counts.filter((F.col("_upto") > bound) & (F.col("_upto") - F.col("_n") < bound)).first()
    if cut is None and counts.filter(F.col("_upto") > bound).isEmpty():
        return messages
    whole = counts.filter(F.col("_upto") <= bound).select(*[F.col(c).alias(f"_whole{c}") for c in split])
    same = [F.col(c).eqNullSafe(F.col(f"_whole{c}")) for c in split]
    taken = messages.join(whole, same, "left_semi")
    if cut is None:  # the bound lies between two splits
        return taken
    part = messages
    for c in split:
        part = part.filter(F.col(c).eqNullSafe(F.lit(cut[c])))
    return taken.unionByName(part.orderBy(position).limit(max_messages - (cut["_upto"] - cut["_n"])))
