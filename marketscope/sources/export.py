"""Write DataFrames in the registry's file layout (used to build test inputs).

Each Spark partition writes one file named like the registry's own
(``<prefix>.<part>.D<snapshot><suffix>``), or one zip archive holding that
file. Writing happens on the executors; the driver only receives one
(file, rows) line per partition. File names depend only on the partition id
and a temporary name is renamed into place, so a retried or speculative task
rewrites the same file instead of adding one.

Files are written through ``pyarrow.fs``: ``path`` may be local (tests) or
a shared filesystem URI visible to every executor.
"""

from __future__ import annotations

import csv
import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketscope.sources import files

SNAPSHOT = "D30610"   # 10/06/2023 in the registry's DYMMDD form


def registry_file_name(part: int, suffix: str, snapshot: str = SNAPSHOT, prefix: str = "K3241") -> str:
    return f"{prefix}.K03200Y{part}.{snapshot}{suffix}"


def _csv_bytes(pdf: pd.DataFrame, header: bool, sep: str, encoding: str) -> bytes:
    buf = io.StringIO()
    pdf.to_csv(buf, sep=sep, header=header, index=False, quoting=csv.QUOTE_ALL if not header else csv.QUOTE_MINIMAL,
               lineterminator="\n")
    return buf.getvalue().encode(encoding)


def write_registry_files(df: DataFrame, path: str, suffix: str, snapshot: str = SNAPSHOT,
                         archive: str | None = None, encoding: str = "latin-1",
                         prefix: str = "K3241") -> DataFrame:
    """Write ``df`` as headerless ``;`` latin-1 files, one per partition.

    With ``archive`` (e.g. ``"Empresas"``) each file goes into its own zip
    ``<archive><part>.zip``. Returns the (file, rows) summary, already
    computed.
    """
    files.make_dirs(path)
    columns = df.columns

    def write(it):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        name = registry_file_name(part, suffix.replace("*", str(part)), snapshot, prefix)
        target = files.join(path, f"{archive}{part}.zip" if archive else name)
        tmp = target + ".tmp"
        out = files.open_output(tmp)
        zf = zipfile.ZipFile(out, "w", compression=zipfile.ZIP_DEFLATED) if archive else None
        fh = zf.open(name, "w", force_zip64=True) if zf else out
        n = 0
        try:
            for pdf in it:   # Arrow batches, never the whole partition at once
                pdf = pdf[columns].astype(object).where(pdf[columns].notna(), "")
                fh.write(_csv_bytes(pdf, header=False, sep=";", encoding=encoding))
                n += len(pdf)
        finally:
            fh.close()
            if zf:
                zf.close()
                out.close()
        files.move(tmp, target)
        yield pd.DataFrame({"arquivo": [target.rsplit("/", 1)[-1]], "linhas": [n]})

    # Partitions stream through pandas one at a time; the summary is tiny.
    summary = df.mapInPandas(write, "arquivo string, linhas long")
    rows = summary.collect()
    spark = df.sparkSession
    return spark.createDataFrame(rows, "arquivo string, linhas long")


def write_header_csv(df: DataFrame, path: str) -> str:
    """Comma CSV with a header (the company's own files), Spark's own writer."""
    df.write.mode("overwrite").options(header="true", sep=",", quote='"', escape='"').csv(path)
    return path


def blank_to_empty(df: DataFrame) -> DataFrame:
    """NULL -> '' on every string column (registry convention before export)."""
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in df.columns])
