"""Large CSV files by many tasks, quoted line breaks included, with a reject channel.

Spark reads a file with line breaks inside quotes in one task, because only the
quotes from its beginning tell which line breaks end a record. Here each task
counts the quotes of a byte range; the sum of the ranges before, modulo two, tells
whether a range starts inside quotes. That small table is written once. A task
then reads its range from the first record that starts in it to the end of the last one,
and hands on whole records with their file, byte position and number of fields.
Spark's own CSV parser (``from_csv``) makes columns of them.

A record is accepted if it has the schema's number of fields, parses, and meets the
checks given (a number where one is expected). Everything else is kept as text in the
reject table with its reason: accepted and rejected lines add up to the lines of the files. Empty
lines are not records.

Quotes are counted, so each one must open, close or stand doubled in a quoted field, as
in the registry's files; after a stray one in a file, the records up to the next quote are
joined and rejected for their number of fields.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketscope.session import shared_dir, ship_package
from marketscope.sources import files
from marketscope.sources import schemas as S

RANGE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
# What a range's last record is read on by, beyond the range.
TAIL_BYTES = 64 << 10
# Small ranges share a task up to about so many bytes; files too small for MIN_TASKS such tasks go by single ranges.
TASK_BYTES, MIN_TASKS = 32 << 20, 64
QUOTE, NEWLINE, RETURN = 34, 10, 13
CORRUPT = "__ms_corrupt"

# Reasons of the reject table (fixed values).
MISSING_FIELDS, EXTRA_FIELDS, UNREADABLE = "campos a menos", "campos a mais", "ilegivel"


@dataclass(frozen=True)
class Dialect:
    """How the records of a file look; ``header`` drops a file's first record."""

    sep: str
    encoding: str
    header: bool


REGISTRY = Dialect(";", "ISO-8859-1", False)
COMPANY = Dialect(",", "UTF-8", True)


# ---------------------------------------------------------------------- ranges
def byte_ranges(spark: SparkSession, path: str, pattern: str = "*", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, start, stop, inside): the byte ranges of the files, and whether each starts inside quotes.

    The counts are taken once; the table of ranges is written to the shared folder.
    """
    ship_package(spark)
    found = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
             .where("length > 0").select("path", "length"))          # a listing: no content is read
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = (found.select("path", "length", start.alias("start"))
              .select("path", "start", F.least(F.col("start") + range_bytes, F.col("length")).alias("stop")))
    before = F.sum("quotes").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    counted = _spread(ranges).mapInArrow(_count_quotes, "path string, start long, stop long, quotes long")
    target = shared_dir(spark, "csv_ranges")
    counted.select("path", "start", "stop", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside")).write.mode("overwrite").parquet(target)
    return spark.read.schema("path string, start long, stop long, inside boolean").parquet(target)


def _spread(ranges: DataFrame) -> DataFrame:
    """A task for each range; small ranges of large files share tasks, so that tasks and the files they write grow with
    the bytes, whatever the ranges' size."""
    count, size = ranges.agg(F.count(F.lit(1)), F.sum(F.col("stop") - F.col("start"))).first()
    tasks = max(MIN_TASKS, 2 * ranges.sparkSession.sparkContext.defaultParallelism, -(-(size or 0) // TASK_BYTES))
    return ranges.repartition(max(min(count, tasks), 1))


def _count_quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        quotes = []
        for path, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
            n = 0
            with files.open_input(path) as fh:
                fh.seek(start)
                while start < stop and (block := fh.read(min(BLOCK_BYTES, stop - start))):
                    n += block.count(b'"')
                    start += len(block)
            quotes.append(n)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(quotes, pa.int64())], names=["path", "start", "stop", "quotes"])


# --------------------------------------------------------------------- records
def range_records(fh, start: int, stop: int, inside: bool, sep: str, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple]:
    """(positions, field counts, records) of the records that start in [start, stop), block by block.

    The last record is read to its end, wherever that lies. Line ends are not part of a record.
    """
    at = start
    begun = start == 0
    if start:
        fh.seek(start - 1)
        begun = fh.read(1) == b"\n" and not inside
    else:
        fh.seek(0)
    held, held_fields = b"", 0                       # the record begun but not ended, and the separators in it
    while True:
        block = fh.read(min(block_bytes, stop - at if at < stop else TAIL_BYTES))
        if not block:
            if begun and held and at - len(held) < stop:
                yield _block(held, np.array([0]), np.array([len(held)]), np.array([held_fields + 1]), at - len(held))
            return
        a = np.frombuffer(block, dtype=np.uint8)
        outside = ((np.cumsum(a == QUOTE) + inside) & 1) == 0
        ends = np.flatnonzero((a == NEWLINE) & outside)
        seps = np.flatnonzero((a == ord(sep)) & outside)
        inside = not outside[-1]
        data, base, shift = held + block, at - len(held), len(held)
        at += len(block)
        if not begun:
            if not len(ends):
                held = b""
                if at >= stop:
                    return
                continue
            first, begun = int(ends[0]) + 1, True    # the rest of a record that began in an earlier range
            ends, seps = ends[1:], seps[seps >= first]
            data, base, shift = data[shift + first:], base + shift + first, -first
            held_fields = 0
        if base >= stop:
            return
        closes = ends + shift
        starts = np.concatenate(([0], closes[:-1] + 1)) if len(closes) else closes
        if len(closes):
            upto = np.searchsorted(seps, ends)
            counts = np.diff(upto, prepend=0) + 1
            counts[0] += held_fields
            mine = base + starts < stop
            yield _block(data, starts[mine], closes[mine], counts[mine], base)
            held, held_fields = data[closes[-1] + 1:], len(seps) - int(upto[-1])
            if base + int(closes[-1]) + 1 >= stop:
                return
        else:
            held, held_fields = data, held_fields + len(seps)


def _block(data: bytes, starts: np.ndarray, closes: np.ndarray, counts: np.ndarray, base: int) -> tuple:
    a = np.frombuffer(data, dtype=np.uint8)
    ends = closes - ((closes > starts) & (a[np.maximum(closes - 1, 0)] == RETURN))
    some = ends > starts
    starts, ends, counts = starts[some], ends[some], counts[some]
    edges = np.stack((starts, ends), axis=1).ravel().astype(np.int32)          # start, end, start, end, ...
    runs = pa.Array.from_buffers(pa.binary(), max(len(edges) - 1, 0), [None, pa.py_buffer(edges), pa.py_buffer(data)])
    return base + starts, counts, runs.take(pa.array(np.arange(0, len(runs), 2)))


def records(spark: SparkSession, path: str, pattern: str = "*", dialect: Dialect = REGISTRY,
            range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(arquivo, posicao, campos, registro): every record as text, with its file, byte position and number of fields."""
    sep, header = dialect.sep, dialect.header

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, stop, inside in zip(*(c.to_pylist() for c in batch.columns)):
                with files.open_input(path) as fh:
                    first = header and start == 0
                    for places, counts, texts in range_records(fh, start, stop, inside, sep):
                        if first and len(places):
                            places, counts, texts, first = places[1:], counts[1:], texts[1:], False
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path.rsplit("/", 1)[-1]] * len(places), pa.string()), pa.array(places, pa.int64()),
                             pa.array(counts, pa.int32()), texts], names=["arquivo", "posicao", "campos", "registro"])

    ranges = byte_ranges(spark, path, pattern, range_bytes)
    raw = _spread(ranges).mapInArrow(read, "arquivo string, posicao long, campos int, registro binary")
    return raw.withColumn("registro", F.decode("registro", dialect.encoding))


# ----------------------------------------------------------- columns and rejects
def parsed(rows: DataFrame, columns: list[str], dialect: Dialect, checks: dict[str, Column] | None = None,
           pad_short: bool = False) -> DataFrame:
    """``rows`` with the text columns and ``motivo``: why a record is rejected, null where it is accepted.

    ``checks``: reason -> condition over the text columns that rejects a record. ``pad_short`` accepts
    records with too few fields; the fields they lack are null.
    """
    ddl = ", ".join(f"`{c}` STRING" for c in [*columns, CORRUPT])
    options = {"sep": dialect.sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": CORRUPT}
    out = rows.withColumn("r", F.from_csv("registro", ddl, options)).select("arquivo", "posicao", "campos", "registro", "r.*")
    short = F.col("campos") < len(columns)
    reason = (F.when(short & F.lit(not pad_short), MISSING_FIELDS).when(F.col("campos") > len(columns), EXTRA_FIELDS)
              .when(F.col(CORRUPT).isNotNull() & ~short, UNREADABLE))
    for name, bad in (checks or {}).items():
        reason = reason.when(bad, name)
    return out.withColumn("motivo", reason).drop(CORRUPT)


@dataclass(frozen=True)
class Load:
    """A load: the accepted rows, the rejected records (arquivo, posicao, campos, motivo, registro), and their counts."""

    accepted: DataFrame
    rejected: DataFrame

    def counts(self) -> DataFrame:
        """(arquivo, motivo, linhas): accepted (motivo null) and rejected records of each file."""
        every = self.rejected.select("arquivo", "motivo").unionByName(self.accepted.select("arquivo", F.lit(None).cast("string").alias("motivo")))
        return every.groupBy("arquivo", "motivo").agg(F.count(F.lit(1)).cast("bigint").alias("linhas"))


def load(spark: SparkSession, path: str, columns: list[str], target: str, dialect: Dialect = REGISTRY, pattern: str = "*",
         checks: dict[str, Column] | None = None, range_bytes: int = RANGE_BYTES, pad_short: bool = False) -> Load:
    """Read the files once and write both tables under ``target`` (one folder each)."""
    rows = parsed(records(spark, path, pattern, dialect, range_bytes), columns, dialect, checks, pad_short)
    taken = F.col("motivo").isNull()
    keep_text = F.when(~taken, F.col("registro")).alias("registro")
    (rows.select("arquivo", "posicao", "campos", "motivo", keep_text, *[F.col(f"`{c}`") for c in columns], taken.alias("aceito"))
     .write.mode("overwrite").partitionBy("aceito").parquet(target))
    ddl = ", ".join([*(f"`{n}` {t}" for n, t in (("arquivo", "STRING"), ("posicao", "LONG"), ("campos", "INT"), ("motivo", "STRING"),
                                                 ("registro", "STRING"))), *(f"`{c}` STRING" for c in columns), "aceito BOOLEAN"])
    table = spark.read.schema(ddl).parquet(target)
    return Load(table.where("aceito").select("arquivo", *[F.col(f"`{c}`") for c in columns]),
                table.where("NOT aceito").select("arquivo", "posicao", "campos", "motivo", "registro"))


def load_registry_csv(spark: SparkSession, path: str, table: str, target: str, range_bytes: int = RANGE_BYTES,
                      pattern: str | None = None, pad_short: bool = False) -> Load:
    """S1 with rejects: the table's files under ``path``; blanks as ''."""
    names = S.REGISTRY_SCHEMAS[table].names
    got = load(spark, path, names, target, REGISTRY, pattern or "*" + S.REGISTRY_SUFFIX[table], None, range_bytes, pad_short)
    return Load(got.accepted.na.fill(""), got.rejected)


def read_registry_split(spark: SparkSession, path: str, table: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """S1 read by byte ranges: the rows of ``registry.read_registry_csv``, many tasks to a file; padded or cut lines as there."""
    names = S.REGISTRY_SCHEMAS[table].names
    rows = parsed(records(spark, path, "*" + S.REGISTRY_SUFFIX[table], REGISTRY, range_bytes), names, REGISTRY)
    return rows.select(*names).na.fill("")


def bad_number(column: str, number: str = "DECIMAL(28,6)") -> Column:
    """Neither missing nor a number."""
    from marketscope.sources.registry import PANDAS_NA_VALUES

    text = F.col(f"`{column}`")
    return text.isNotNull() & ~F.trim(text).isin(PANDAS_NA_VALUES) & F.expr(f"try_cast(`{column}` AS {number})").isNull()


BAD_VALUE = "valor invalido"


def load_sales_csv(spark: SparkSession, path: str, target: str, dialect: Dialect = COMPANY,
                   range_bytes: int = RANGE_BYTES) -> Load:
    """S4 with rejects: sales history; NA spellings are NULL, a value that is no number rejects its line."""
    from marketscope.sources.registry import na_to_null

    names = S.VENDAS_SCHEMA.names
    got = load(spark, path, names, target, dialect, checks={BAD_VALUE: bad_number("valor")}, range_bytes=range_bytes)
    keys = [na_to_null(c) for c in names if c != "valor"]
    return Load(got.accepted.select("arquivo", *keys, F.expr("try_cast(valor AS DECIMAL(28,6))").alias("valor")), got.rejected)


def load_leads_csv(spark: SparkSession, path: str, target: str, range_bytes: int = RANGE_BYTES) -> Load:
    """S5 with rejects."""
    from marketscope.sources.registry import na_to_null

    names = S.LEADS_SCHEMA.names
    got = load(spark, path, names, target, COMPANY, range_bytes=range_bytes)
    return Load(got.accepted.select("arquivo", *[na_to_null(c) for c in names]), got.rejected)
