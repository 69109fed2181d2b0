"""What reaches the disk and what moves: Bloom filters, clustered files, snapshots, atomic replace, plans."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marketscope.operators import kpis, market
from marketscope.operators.semijoin import bloom_filter, bloom_semi_join, may_contain
from marketscope.plans import queries
from marketscope.sources import fixtures, tables

SF = "/root/testdata/sf0.001"


def scanned_rows(df):
    """Rows the leaves of an executed plan gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())
               if leaves.apply(i).metrics().contains("numOutputRows"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "1024")
    yield
    spark.conf.set(key, old)


def test_bloom_semi_join_is_exact_and_filters_before_the_exchange(spark, no_broadcast, tmp):
    spark.range(50_000).selectExpr("cast(id as string) as cnpj", "id as v").write.parquet(tmp + "/big")
    big = spark.read.parquet(tmp + "/big")
    keys = spark.range(0, 60_000, 613).selectExpr("cast(id as string) as cnpj").unionByName(spark.sql("select cast(null as string) as cnpj"))
    got = bloom_semi_join(big, keys, "cnpj")
    assert sorted(r.v for r in got.collect()) == [i for i in range(0, 50_000, 613)]
    passed = big.where(may_contain(bloom_filter(keys.where("cnpj is not null"), "cnpj"), F.col("cnpj"))).count()
    assert 82 <= passed < 2500
    lines = plan_of(got).split("\n")
    exchange = next(i for i, x in enumerate(lines) if "Exchange" in x)
    assert "subquery" in lines[exchange + 1].lower() and "Filter" in lines[exchange + 1]
    assert bloom_semi_join(big, keys.where("false"), "cnpj").count() == 0


def test_client_codes_thin_out_the_active_rows(spark, no_broadcast):
    m = queries.model(spark, SF)
    plan = plan_of(market.client_codes(m.active, m.inputs.vendas))
    before = plan[plan.index("SortMergeJoin"):]
    assert "might" not in before and "subquery" in before[:before.rindex("Exchange")].lower()


def test_targets_and_star_do_not_move_big_tables_by_code(spark, no_broadcast):
    m = queries.model(spark, SF)
    for df in (m.targets, m.star(m.fact_base_table)):
        plan = plan_of(df)
        for key in ("cnae_fiscal", "municipio", "porte_empresa", "id_regime_tributario"):
            assert f"hashpartitioning({key}" not in plan, plan
    assert plan_of(m.targets).count("BroadcastHashJoin") == 1


def test_point_lookups_skip_row_groups(spark, tmp):
    e = spark.range(40_000).select(F.format_string("%014d", "id").alias("cnpj"), F.sha1(F.col("id").cast("string")).alias("nome"),
                                   F.repeat(F.sha1(F.col("id").cast("string")), 5).alias("filler"))
    for bloom in ((), ("nome",)):
        path = f"{tmp}/t{len(bloom)}"
        tables.write_table(e, path, sort_by="cnpj", files=4, bloom=bloom, row_group_bytes=256 << 10)
        groups = [pq.ParquetFile(f).metadata.row_group(i).num_rows for f in glob.glob(path + "/*.parquet")
                  for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
        assert len(groups) >= 20
        by_id = scanned_rows(spark.read.parquet(path).where("cnpj = '00000000012345'"))
        assert 0 < by_id <= 2 * max(groups)
        name = e.where("id = 777" if "id" in e.columns else "cnpj = '00000000000777'").first()["nome"]
        by_name = scanned_rows(spark.read.parquet(path).where(F.col("nome") == name))
        absent = scanned_rows(spark.read.parquet(path).where(F.col("nome") == name[:-1] + "x"))
        if bloom:                       # one of many row groups, none for a name nobody has (1 % false positives)
            assert 0 < by_name <= 3 * max(groups) and absent <= 2 * max(groups)
        else:
            assert by_name > 10 * max(groups)


def test_clustered_layout_skips_files(spark):
    path = queries.clustered_path(spark, "/root/testdata/sf0.01")
    read = 0
    files = glob.glob(path.removeprefix("file:") + "/*.parquet")
    for f in files:
        t = pq.read_table(f, columns=["uf", "municipio", "cep"]).to_pydict()
        read += all(min(t[c]) <= hi and max(t[c]) >= lo for c, lo, hi in (("uf", "U3", "U3"), ("municipio", "0003", "0003"), ("cep", "72", "73"))) if t["uf"] else 0
    assert 100 < len(files) <= 200 and 0 < read < 0.1 * len(files)


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(a, b) for a in (0, 1, 5, 70000, None) for b in (0, 3, -4)], "a long, b long")
    got = {(r.a, r.b): r.z for r in df.select("a", "b", tables.interleaved([F.col("a"), F.col("b")], 16).alias("z")).collect()}

    def want(a, b):
        a, b = (max(0, min(x or 0, 0xFFFF)) for x in (a, b))
        return sum(((a >> i & 1) << (2 * i + 1)) | ((b >> i & 1) << (2 * i)) for i in range(16))

    assert got == {k: want(*k) for k in got}


def test_snapshot_reload_replaces_its_own_rows_only(spark, tmp):
    path = tmp + "/snapshots"
    one, two = spark.createDataFrame([(1,), (2,)], "v int"), spark.createDataFrame([(3,)], "v int")
    for df, day in ((one, "a"), (two, "b"), (one, "b"), (two, "b")):
        tables.write_snapshot(df, path, F.lit(day))
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "a"), (3, "b")]


def test_replace_is_all_or_nothing(spark, tmp):
    name = tables.catalog_name("t", tmp)
    tables.replace_table(spark.createDataFrame([(1,), (2,)], "v long"), name, tmp)
    broken = spark.range(1, 3).select(F.when(F.col("id") == 2, F.raise_error("boom")).otherwise(F.col("id")).cast("long").alias("v"))
    with pytest.raises(Exception, match="boom"):
        tables.replace_table(broken, name, tmp)
    assert sorted(r.v for r in spark.table(name).collect()) == [1, 2]
    with pytest.raises(ValueError):
        tables.replace_table(spark.createDataFrame([("x",)], "w string"), name, tmp)
    got = tables.replace_table(spark.createDataFrame([(7,)], "v long"), name, tmp)
    assert [r.v for r in got.collect()] == [7] and [r.v for r in spark.table(name).collect()] == [7]
    assert len([d for d in glob.glob(tmp + "/*") if glob.glob(d + "/_SUCCESS") and "ms_t" in d]) <= 2     # the old copy is gone


def test_counts_read_no_column(spark, tmp):
    spark.range(1000).selectExpr("id", "cast(id as string) as s").write.parquet(tmp + "/t")
    df = spark.read.parquet(tmp + "/t").agg(F.count(F.lit(1)))
    df.collect()
    assert "ReadSchema: struct<>" in df._jdf.queryExecution().executedPlan().toString() and df.first()[0] == 1000
    assert plan_of(queries.s15_row_counts(spark, SF)).count("ReadSchema: struct<>") >= 1


def test_sums_table_gives_the_measures_of_direct_aggregates(spark):
    m = queries.model(spark, SF)
    star = m.star(m.fact_base_table)
    sums = m.sums_table

    def rows(df):
        return sorted(map(repr, df.select(sorted(df.columns)).collect()))

    assert rows(kpis.measures_of(sums, "total")) == rows(kpis.kpis(star))
    assert rows(kpis.measures_of(sums, "atividade", kpis.ACTIVITY)) == rows(kpis.kpis(star, kpis.ACTIVITY))
    assert rows(kpis.segment_volume_of(sums)) == rows(kpis.volume_by_size_segment(star))
    assert rows(kpis.rollup_of(sums)) == rows(kpis.market_rollup(star))
    none = kpis.sums_table(star.where("false"))
    assert kpis.measures_of(none, "total").first()["empresas"] == 0
    assert plan_of(kpis.sums_table(star)).count("fato_base") <= 1            # one pass


def test_model_writes_once(spark):
    assert queries.model(spark, SF) is queries.model(spark, SF + "/")
    reg, inp = fixtures.load(spark, SF)
    m = queries.model(spark, SF)
    assert m.registry is reg and m.inputs is inp and m.similar_table is m.similar_table
