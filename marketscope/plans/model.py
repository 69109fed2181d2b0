"""The market model: every intermediate and gold frame, built lazily once.

One object per (registry, inputs) pair; each property is a lazy DataFrame
plan, so a query pulls in only the stages it needs and Catalyst prunes the
rest. The properties named ``..._table`` (fact base, similarity, and the small code
lists and dimensions that joins on skewed keys use) are written once to the shared
folder, at first use: whatever reads them later starts from the copy, with its
measured size. Nothing here collects.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketscope.operators import dims, enrich, kpis, market, recommend, similarity
from marketscope.session import shared_dir
from marketscope.sources import tables
from marketscope.sources.registry import Inputs, Registry


class MarketModel:
    def __init__(self, spark: SparkSession, registry: Registry, inputs: Inputs,
                 drop_blank_codes: bool = False, active: DataFrame | None = None):
        self.spark = spark
        if active is not None:      # e.g. the written bronze table
            self.__dict__["active"] = active
        self.registry = registry
        self.inputs = inputs
        self.drop_blank_codes = drop_blank_codes

    # ------------------------------------------------------------ bronze/silver
    @cached_property
    def active(self) -> DataFrame:
        return market.active(self.registry.estabelecimento)

    @cached_property
    def client_codes(self) -> DataFrame:
        return market.client_codes(self.active, self.inputs.vendas, self.drop_blank_codes)

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_dir(self.spark, name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def client_codes_table(self) -> DataFrame:
        return self._stored(self.client_codes, "clientes_cnaes")

    @cached_property
    def targets(self) -> DataFrame:
        return market.target_market(self.active, tables.small(self.client_codes_table))

    # -------------------------------------------------------------------- gold
    @cached_property
    def fact_base(self) -> DataFrame:
        r, i = self.registry, self.inputs
        return enrich.fact_base(self.active, self.targets, r.empresas, r.simples, i.leads, i.vendas)

    @cached_property
    def fact_base_table(self) -> DataFrame:
        """The fact without similarity, written once to the shared folder: the
        similarity (codes, roles) and the final fact read this copy instead
        of re-running the target and enrichment joins."""
        return self._stored(self.fact_base, "fato_base")

    @cached_property
    def secondary(self) -> DataFrame:
        """Exploded secondary codes of the fact companies only (the target rows
        are selected before exploding). A loaded ``cnae_secundaria`` table
        may be set here instead."""
        estab = self.registry.estabelecimento.join(
            self.fact_base_table.select("cnpj").distinct(), "cnpj", "left_semi")
        return similarity.explode_codes(estab)

    @cached_property
    def codes(self) -> DataFrame:
        return similarity.company_codes(self.fact_base_table, self.secondary)

    @cached_property
    def clients(self) -> DataFrame:
        return self.fact_base_table.where(F.col("atual_cliente") == 1).select("cnpj")

    @cached_property
    def prospects(self) -> DataFrame:
        return market.prospects(self.fact_base_table).select("cnpj")

    @cached_property
    def similar(self) -> DataFrame:
        return similarity.most_similar(self.codes, self.clients, self.prospects)

    @cached_property
    def similar_table(self) -> DataFrame:
        """The most similar customers, written once: the fact and the recommendations read this copy."""
        return self._stored(self.similar, "similares")

    @cached_property
    def fact(self) -> DataFrame:
        return enrich.attach_similarity(self.fact_base_table, self.similar_table)

    @cached_property
    def top_products(self) -> DataFrame:
        return recommend.top_products(self.inputs.vendas)

    @cached_property
    def dim_cnae(self) -> DataFrame:
        return dims.dim_activity(self.registry.cnae)

    @cached_property
    def dim_municipio(self) -> DataFrame:
        return dims.dim_municipality(self.registry.estabelecimento, self.registry.municipio)

    @cached_property
    def dim_cnae_table(self) -> DataFrame:
        return self._stored(self.dim_cnae, "dim_cnae")

    @cached_property
    def municipality_names_table(self) -> DataFrame:
        return self._stored(dims.municipality_names(self.dim_municipio), "municipios")

    def star(self, fact: DataFrame) -> DataFrame:
        """B1: a fact with its dimensions; the fact does not move."""
        return kpis.star_view(fact, self.dim_porte, self.dim_regime, tables.small(self.dim_cnae_table),
                              tables.small(self.municipality_names_table))

    @cached_property
    def sums_table(self) -> DataFrame:
        """The measures' sums by every grouping, one pass over the fact, written once."""
        return self._stored(kpis.sums_table(self.star(self.fact_base_table)), "somas")

    @cached_property
    def dim_porte(self) -> DataFrame:
        return dims.dim_size(self.spark)

    @cached_property
    def dim_regime(self) -> DataFrame:
        return dims.dim_regime(self.spark)
