"""Star view and coverage measures.

The BI model names its measures but ships no formulas; the definitions here
are inferred from the names and captions:

* atendidos (served)    = facts with atual_cliente = 1
* potencial (potential) = facts with atual_cliente = 0
* cobertura (coverage)  = atendidos / (atendidos + potencial)
* leads                 = facts with possui_lead = 1
* pct_leads             = leads / facts

All measures are plain aggregate expressions, so a group-by computes them in
one pass with partial aggregation before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def measures() -> list[Column]:
    served = F.sum(F.col("atual_cliente")).cast("bigint")
    potential = F.sum(1 - F.col("atual_cliente")).cast("bigint")
    leads = F.sum(F.col("possui_lead")).cast("bigint")
    rows = F.count(F.lit(1)).cast("bigint")
    return [
        served.alias("atendidos"),
        potential.alias("potencial"),
        F.try_divide(served.cast("double"), (served + potential).cast("double")).alias("cobertura"),
        leads.alias("leads"),
        F.try_divide(leads.cast("double"), rows.cast("double")).alias("pct_leads"),
        rows.alias("empresas"),
    ]


def star_view(fact: DataFrame, dim_porte: DataFrame, dim_regime: DataFrame, dim_cnae: DataFrame,
              municipality: DataFrame) -> DataFrame:
    """B1: the fact with its four dimensions; ``municipality`` has a row for each (``dims.municipality_names``),
    because the dimension's grain is the postal code. Pass written dimensions through ``tables.small``:
    then nothing is dealt by an activity or municipality that a third of the companies share."""
    cnae = dim_cnae.select(F.col("codigo").alias("cnae_fiscal"), F.col("descricao").alias("descricao_cnae"),
                           "sigla_secao", "desc_secao")
    return (fact.join(F.broadcast(dim_porte), "porte_empresa", "left")
            .join(F.broadcast(dim_regime), "id_regime_tributario", "left")
            .join(cnae, "cnae_fiscal", "left")
            .join(municipality, "municipio", "left"))


def kpis(star: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Coverage measures, overall or by the given columns."""
    return star.groupBy(*(by or [])).agg(*measures())


SEGMENT, ACTIVITY, REGION = (["porte_empresa", "descricao_porte_empresa", "sigla_secao", "desc_secao"],
                             ["cnae_fiscal", "sigla_secao", "desc_secao"], ["uf", "sigla_secao"])


def sums_table(star: DataFrame) -> DataFrame:
    """Sums of the star view by every grouping the measures use, in one pass.

    Columns: conjunto (which grouping), the grouping columns (null where not of it), clientes, leads,
    empresas. Sums can be added up further; the shares are derived from them.
    """
    columns = sorted({*SEGMENT, *ACTIVITY, *REGION})
    sets = {"total": [], "atividade": ACTIVITY, "segmento": SEGMENT, "regiao": REGION, "uf": ["uf"]}
    grouped = star.groupingSets([[F.col(c) for c in by] for by in sets.values()], *[F.col(c) for c in columns])
    which = F.grouping_id(*columns)
    summed = grouped.agg(which.alias("g"), F.sum("atual_cliente").cast("bigint").alias("clientes"),
                         F.sum("possui_lead").cast("bigint").alias("leads"), F.count(F.lit(1)).cast("bigint").alias("empresas"))
    name = F.lit(None).cast("string")
    for label, by in sets.items():       # a bit of grouping_id is set for each column not grouped by, the first the highest
        bits = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in by)
        name = F.when(F.col("g") == bits, label).otherwise(name)
    return summed.select(name.alias("conjunto"), *columns, "clientes", "leads", "empresas")


def measures_of(sums: DataFrame, grouping: str, by: list[str] | None = None) -> DataFrame:
    """B2/B3 from :func:`sums_table`; without any company one row of empty measures."""
    rows = sums.where(F.col("conjunto") == grouping).groupBy(*(by or [])).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("clientes", "leads", "empresas")])
    total = F.coalesce("empresas", F.lit(0).cast("bigint"))
    return rows.select(
        *(by or []), F.col("clientes").alias("atendidos"), (F.col("empresas") - F.col("clientes")).alias("potencial"),
        F.try_divide(F.col("clientes").cast("double"), F.col("empresas").cast("double")).alias("cobertura"), "leads",
        F.try_divide(F.col("leads").cast("double"), F.col("empresas").cast("double")).alias("pct_leads"), total.alias("empresas"))


def segment_volume_of(sums: DataFrame) -> DataFrame:
    """B4 from :func:`sums_table`."""
    return sums.where("conjunto = 'segmento'").select(*SEGMENT, "empresas")


def rollup_of(sums: DataFrame) -> DataFrame:
    """B6 from :func:`sums_table`: by state and section, by state, in all."""
    level = F.when(F.col("conjunto") == "total", 3).when(F.col("conjunto") == "uf", 1).otherwise(0)
    return sums.where(F.col("conjunto").isin("regiao", "uf", "total")).select(
        *REGION, "clientes", "leads", F.col("empresas").alias("mercado"), level.cast("int").alias("nivel"))


def volume_by_size_segment(star: DataFrame) -> DataFrame:
    """Active target companies by size and section."""
    return (star.groupBy("porte_empresa", "descricao_porte_empresa", "sigla_secao", "desc_secao")
            .agg(F.count(F.lit(1)).cast("bigint").alias("empresas")))


def potential_revenue_by_region(star: DataFrame, top: DataFrame) -> DataFrame:
    """By state, the prospects and the sum over them of their most similar
    customer's recommended-item value."""
    # Money is summed exactly (cents as decimal), so the result does not
    # depend on the order in which partitions are added up.
    cents = F.col("valor").cast("decimal(28,2)")
    value = top.groupBy(F.col("cnpj").alias("cnpj_mais_similar")).agg(F.sum(cents).alias("valor_cliente"))
    # One customer may be the most similar of a third of all prospects: they are
    # counted per state and customer before the join.
    counted = (star.where((F.col("atual_cliente") == 0) & F.col("cnpj_mais_similar").isNotNull())
               .groupBy("uf", "cnpj_mais_similar").agg(F.count(F.lit(1)).alias("n")))
    revenue = F.col("valor_cliente") * F.col("n").cast("decimal(18,0)")
    return (counted.join(value, "cnpj_mais_similar", "left")
            .groupBy("uf")
            .agg(F.sum("n").cast("bigint").alias("prospects"),
                 F.coalesce(F.sum(revenue), F.lit(0)).cast("double").alias("receita_potencial")))


def market_rollup(star: DataFrame) -> DataFrame:
    """Customers vs leads vs market, subtotals by state and section."""
    return (star.rollup("uf", "sigla_secao")
            .agg(F.sum("atual_cliente").cast("bigint").alias("clientes"),
                 F.sum("possui_lead").cast("bigint").alias("leads"),
                 F.count(F.lit(1)).cast("bigint").alias("mercado"),
                 F.grouping_id().cast("int").alias("nivel")))
