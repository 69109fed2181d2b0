import os

from pyspark.sql import functions as F

from marketscope.sources import fixtures
from marketscope.sources.export import write_registry_files
from marketscope.sources import schemas as S
from marketscope.streaming import ingest


def test_incremental_ingest_is_exactly_once(spark, tmp):
    raw = fixtures.raw_tables(spark, "/root/testdata/sf0.001")["estabelecimento"]
    src, target, ckpt = (os.path.join(tmp, d) for d in ("drop", "table", "ckpt"))
    heads = raw.where(F.col("matriz_filial") == "1")
    branches = raw.where(F.col("matriz_filial") != "1")
    suffix = S.REGISTRY_SUFFIX["estabelecimento"]

    write_registry_files(heads.repartition(2), src, suffix, prefix="A")
    ingest.ingest(spark, src, "estabelecimento", target, ckpt)
    assert spark.read.parquet(target).count() == heads.count()

    # a second drop lands next to the first: only the new files are read
    write_registry_files(branches.repartition(3), src, suffix, prefix="B")
    ingest.ingest(spark, src, "estabelecimento", target, ckpt)
    # and a rerun with nothing new adds nothing
    ingest.ingest(spark, src, "estabelecimento", target, ckpt)
    got = sorted(map(tuple, spark.read.parquet(target).collect()))
    assert got == sorted(map(tuple, raw.collect()))
