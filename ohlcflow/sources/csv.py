"""Price-CSV scan: files with a header record, columns mapped by header *name*.

Each file's first record is its header. ``Date`` or ``date`` (the capitalised name
wins), ``Open``/``open`` ... are picked by name, extra columns are ignored
and a column the header lacks gets a default (date ``""``, numbers ``"0"``).

Spark's CSV reader with an explicit schema maps by *position*, a schema-less
multi-file read applies one file's header to all files, and without its
multi-line mode it cuts quoted cells at line breaks. So the reader only reads:
every file comes whole to one task, where its records are parsed one after the
other and its own header is applied. The data are read once, no file is opened
on the driver, and files of any headers mix in one scan. A task holds one file
at a time (a price file is one symbol's), and its rows leave in batches of
``BATCH_ROWS``. The symbol comes from a ``symbol=<name>`` directory level or from
``{symbol: path}`` pairs; one file may serve several symbols.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BAR_FIELDS, CSV_MISSING_DEFAULTS

# Header names accepted per field, in priority order (fixed values).
HEADER_NAMES = {
    "date": ["Date", "date"],
    "open": ["Open", "open"],
    "high": ["High", "high"],
    "low": ["Low", "low"],
    "close": ["Close", "close"],
    "volume": ["Volume", "volume"],
}
#: Parsed rows that leave a task at once.
BATCH_ROWS = 10_000
#: Longest cell accepted, in characters (the parser's own limit is 131,072).
MAX_CELL_CHARS = 1 << 30
#: Files of a symbol -> file map that one reader pattern names.
FILES_IN_PATTERN = 1000
# Absolute paths that are their own URI but for the scheme, and such URIs.
_NAME = "[A-Za-z0-9_=][A-Za-z0-9_.=-]*"
_PLAIN_PATH = re.compile(rf"(?:file:/*)?((?:/{_NAME})+)")
_PLAIN_URI = re.compile(rf"([a-z][a-z0-9+.-]*:(?://[A-Za-z0-9_.:-]*)?)/({_NAME}(?:/{_NAME})*)")
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_PARSED = "_file string, " + ", ".join(f"{f} string" for f in BAR_FIELDS[1:])


def _plain(uri: str) -> str:
    return re.sub(r"^file:/+", "/", uri)


def _positions(header: list[str]) -> dict[str, int]:
    """Field -> cell position; of equal names the last cell counts."""
    last = {name: k for k, name in enumerate(header)}
    found = {field: [last[n] for n in names if n in last] for field, names in HEADER_NAMES.items()}
    return {field: at[0] for field, at in found.items() if at}


def bar_records(text: str) -> Iterator[list[str | None]]:
    """The six bar cells of every record behind the header of one file's ``text``.

    Quoted cells may hold commas, doubled quotes and line breaks. Blank records
    are skipped; empty cells and cells that a short record lacks are None. A
    file whose first line is blank has a header without names.
    """
    csv.field_size_limit(MAX_CELL_CHARS)
    records = csv.reader(io.StringIO(text, newline=""))
    header = next(records, None)
    if header is None:
        return
    at = _positions(header)
    cells = [(at.get(f), CSV_MISSING_DEFAULTS[f]) for f in BAR_FIELDS[1:]]
    for record in records:
        if record and (len(record) > 1 or record[0].strip()):
            yield [default if k is None else (record[k] or None) if k < len(record) else None for k, default in cells]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(name, pa.string()) for name in ("_file", *BAR_FIELDS[1:])])

    def batch(file: str, rows: list[list[str | None]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in ([file] * len(rows), *zip(*rows, strict=True))], schema=schema)

    for some in batches:
        for file, text in zip(*some.columns, strict=True):
            rows = []
            for row in bar_records(text.as_py()):
                rows.append(row)
                if len(rows) == BATCH_ROWS:
                    yield batch(file.as_py(), rows)
                    rows = []
            if rows:
                yield batch(file.as_py(), rows)


def _uri_of(spark: SparkSession, path: str) -> str:
    """``path`` as ``_metadata.file_path`` shows it (qualified and encoded)."""
    hp = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(hp).toUri().toString()


def _literal(spark: SparkSession, uri: str) -> str:
    """A path that names this one file even if its name has pattern characters."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()
    return re.sub(r"([\\\[\]{}*?,])", r"\\\1", path)


def _uris_of(spark: SparkSession, paths: Iterable[str]) -> dict[str, str]:
    """:func:`_uri_of` of each path; plain names share one call to the file system."""
    own = _uri_of(spark, "/").removesuffix("/")
    uris = {}
    for path in paths:
        m = _PLAIN_PATH.fullmatch(path)
        uris[path] = (own if m[0] == m[1] else "file://") + m[1] if m else _uri_of(spark, path)
    return uris


def _present(spark: SparkSession, uris: Iterable[str]) -> list[str]:
    """Patterns that name those of the files that exist.

    The reader resolves a pattern of many names at once; each is asked before
    whether it finds any file, as a reader takes no pattern that finds none.
    """
    plain, patterns = {}, []
    for uri in uris:
        if m := _PLAIN_URI.fullmatch(uri):
            plain.setdefault(m[1], []).append(m[2])
        else:
            patterns.append(_literal(spark, uri))
    for root, names in plain.items():
        for k in range(0, len(names), FILES_IN_PATTERN):
            patterns.append(f"{root}/{{{','.join(names[k : k + FILES_IN_PATTERN])}}}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def found(pattern: str) -> bool:
        path = hadoop.Path(pattern)
        return bool(path.getFileSystem(conf).globStatus(path))

    return [p for p in patterns if found(p)]


def _unescaped(name: Column) -> Column:
    """Percent-escapes decoded (a plus sign stays one); NULL if one is malformed."""
    return F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def scan_csv(
    spark: SparkSession,
    path: str | None = None,
    symbol_files: Mapping[str, str] | None = None,
    keep_file: bool = False,
) -> DataFrame:
    """Read price CSVs into the seven raw string bar columns.

    Either ``path`` (a directory, optionally with ``symbol=...`` levels) or
    ``symbol_files`` (symbol -> file); files that do not exist contribute no
    rows. The first record of a file is its header whatever it says: a file
    without a recognised name there, or with a blank first line, gives a row of
    defaults for each further record. With ``path``, the symbol of a file is the
    last ``symbol=`` level of its path (percent-escapes decoded), NULL for the
    default partition; a symbol is never taken for a number.
    """
    pairs: list[tuple[str, str]] = []
    if symbol_files is None:
        where = [path]
    else:
        uris = _uris_of(spark, symbol_files.values())
        pairs = [(uris[p], s) for s, p in symbol_files.items()]
        where = _present(spark, dict.fromkeys(u for u, _ in pairs))
    if not where:
        return spark.createDataFrame([], ",".join(f"{c} string" for c in [*BAR_FIELDS, *["_file"] * keep_file]))
    files = spark.read.schema("value string").text(where, wholetext=True, recursiveFileLookup=symbol_files is None)
    bars = files.select("_metadata.file_path", "value").mapInArrow(_parse, _PARSED)
    if symbol_files is None:
        level = F.regexp_extract("_file", r"/symbol=([^/]*)/(?!.*/symbol=)", 1)
        folder = _unescaped(level)  # the path is a URI, and the folder's name is escaped itself
        name = F.coalesce(_unescaped(folder), folder)
        bars = bars.withColumn("symbol", F.when((level != "") & (level != DEFAULT_PARTITION), name))
    else:
        table = spark.createDataFrame([(_plain(u), s) for u, s in pairs], "_path string, symbol string")
        # the map came from the driver's memory; the bars are not sorted for it
        bars = bars.join(F.broadcast(table), F.regexp_replace("_file", r"^file:/+", "/") == F.col("_path"))
    return bars.select(*BAR_FIELDS, *["_file"] * keep_file)
