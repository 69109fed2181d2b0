import pytest
from pyspark.sql import functions as F

from marketscope.functions import (
    SECTIONS, division, lenient_bigint, lenient_real, section_of, size_or_unknown, tax_regime,
)
from marketscope.operators.similarity import explode_codes
from marketscope.sources.registry import snapshot_date


def one_col(spark, values, col="v"):
    return spark.createDataFrame([(v,) for v in values], f"{col} string")


def test_lenient_real(spark):
    vals = ["1000,50", "", "abc", "1.234,56", "-3,5x", "1e3", " 7 ", ".5", None]
    out = one_col(spark, vals).select(lenient_real("v").alias("r")).collect()
    assert [r.r for r in out] == [1000.5, 0.0, 0.0, 1.234, -3.5, 1000.0, 7.0, 0.5, 0.0]


def test_lenient_bigint(spark):
    out = one_col(spark, ["00000000000191", "12.5", "x", ""]).select(lenient_bigint("v").alias("r")).collect()
    assert [r.r for r in out] == [191, 12, 0, 0]


def test_sections_fixture_rows(spark):
    codes = ["01", "03", "04", "05", "33", "34", "35", "47", "48", "97", "98", "99"]
    df = one_col(spark, [c + "00000" for c in codes])
    sigla, _ = section_of(division("v"))
    got = [r.s for r in df.select(sigla.alias("s")).collect()]
    assert got == ["A", "A", None, "B", "C", None, "D", "G", None, "T", None, "U"]


def test_sections_every_division(spark):
    df = spark.range(0, 100).select(F.col("id").cast("int").alias("d"))
    sigla, desc = section_of(F.col("d"))
    got = {r.d: (r.s, r.x) for r in df.select("d", sigla.alias("s"), desc.alias("x")).collect()}
    expected = {}
    for lo, hi, s, x in SECTIONS:
        for d in range(lo, hi + 1):
            expected[d] = (s, x)
    gaps = [0, 4, 34, 40, 44, 48, 54, 57, 67, 76, 83, 89, 98]
    for d in range(100):
        assert got[d] == expected.get(d, (None, None))
    assert all(got[g] == (None, None) for g in gaps)
    assert len(SECTIONS) == 21


def test_division_strict_vs_lenient(spark):
    df = one_col(spark, ["ab1234"])
    assert df.select(division("v", lenient=True).alias("d")).first().d is None
    with pytest.raises(Exception):
        df.select(division("v").alias("d")).collect()


def test_tax_regime_and_size(spark):
    df = spark.createDataFrame([("S", "S"), ("N", "S"), ("N", "N")], "opcao_mei string, opcao_simples string")
    assert [r.t for r in df.select(tax_regime().alias("t")).collect()] == [1, 2, 3]
    sz = one_col(spark, [None, "", "01"], "porte_empresa").select(size_or_unknown().alias("p")).collect()
    assert [r.p for r in sz] == ["00", "", "01"]


def test_explode_codes(spark):
    df = spark.createDataFrame([("1", ""), ("2", "a"), ("3", "a,b"), ("4", "a, b")],
                               "cnpj string, cnae_fiscal_secundaria string")
    rows = sorted((r.cnpj, r.cnae_fiscal_secundaria) for r in explode_codes(df).collect())
    assert rows == [("2", "a"), ("3", "a"), ("3", "b"), ("4", " b"), ("4", "a")]


def test_snapshot_date(spark):
    df = one_col(spark, ["K3241.K03200Y0.D30610.EMPRECSV", "K3241.K03200Y0.D3061.EMPRECSV", "K3241.X.E30610.EMPRECSV"])
    assert [r.d for r in df.select(snapshot_date(F.col("v")).alias("d")).collect()] == ["10/06/2023", None, None]
