"""Registry lookups: company profile, city/postal search, partners.

``SELECT a.*, b.*`` over tables sharing column names is spelled with explicit
select lists: a later duplicate name gets a ``_1``/``_2`` suffix, so nothing
is lost and the result can be written. Point filters sit above left joins;
Catalyst pushes them into the preserved side's scan, and a filter on a
looked-up column turns that left join into an inner join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketscope.sources import schemas as S
from marketscope.sources.registry import Registry


def star(*parts: tuple[str, list[str]]) -> list[Column]:
    """Columns of ``alias.*`` for each (alias, columns), later duplicates suffixed."""
    seen: dict[str, int] = {}
    out = []
    for alias, columns in parts:
        for c in columns:
            n = seen.get(c)
            name = c if n is None else f"{c}_{n + 1}"
            seen[c] = 0 if n is None else n + 1
            out.append(F.col(f"{alias}.`{c}`").alias(name))
    return out


# label tables of a profile: (table, key column); the last one is joined but not
# selected, as in the source query (it can repeat rows)
PROFILE_LABELS = [("natureza_juridica", "te.natureza_juridica"), ("motivo", "t.motivo_situacao_cadastral"),
                  ("municipio", "t.municipio"), ("cnae", "t.cnae_fiscal"), ("pais", "t.pais"),
                  ("qualificacao_socio", "te.qualificacao_responsavel")]


def _label(table: str) -> Column:
    return F.col(f"lab_{table}.descricao")


def _profile_joins(r: Registry) -> DataFrame:
    out = r.estabelecimento.alias("t").join(r.empresas.alias("te"), F.col("te.cnpj_basico") == F.col("t.cnpj_basico"), "left")
    for table, key in PROFILE_LABELS:
        out = out.join(getattr(r, table).alias(f"lab_{table}"), F.col(f"lab_{table}.codigo") == F.col(key), "left")
    return out


def _profile_columns() -> list[Column]:
    labels = [_label(table).alias(key.split(".")[1] + "_") for table, key in PROFILE_LABELS if table not in ("pais", "qualificacao_socio")]
    return (star(("te", S.EMPRESAS_TABLE_COLUMNS), ("t", S.ESTABELECIMENTO_TABLE_COLUMNS)) + labels
            + [F.coalesce(_label("pais"), F.lit("")).alias("pais_")])


def company_profile(r: Registry, cnpj: str) -> DataFrame:
    """One establishment with company, nature, reason, city, code, country labels."""
    return _profile_joins(r).where(F.col("t.cnpj") == cnpj).select(*_profile_columns())


def city_postal_lookup(r: Registry, city: str, uf: str, cep_prefix: str, limit: int = 100) -> DataFrame:
    """Profile rows in a city and state whose postal code starts
    with a prefix; the first ``limit`` by id (LIMIT needs a total order)."""
    cond = ((_label("municipio") == city) & (F.col("t.uf") == uf)
            & F.col("t.cep").startswith(cep_prefix))
    return (_profile_joins(r).where(cond).select(*_profile_columns())
            .orderBy("cnpj").limit(limit))


def companies_by_legal_nature(r: Registry, natures: list[str]) -> DataFrame:
    """Companies of some legal natures, their establishments and partners."""
    te, t, ts = r.empresas.alias("te"), r.estabelecimento.alias("t"), r.socios.alias("ts")
    return (te.where(F.col("natureza_juridica").isin(natures))
            .join(t, F.col("t.cnpj_basico") == F.col("te.cnpj_basico"), "left")
            .join(ts, F.col("ts.cnpj") == F.col("t.cnpj"), "left")
            .select(*star(("t", S.ESTABELECIMENTO_TABLE_COLUMNS), ("te", S.EMPRESAS_TABLE_COLUMNS),
                          ("ts", S.SOCIOS_TABLE_COLUMNS))))


def _partners_with_company(r: Registry) -> DataFrame:
    ts, te = r.socios.alias("ts"), r.empresas.alias("te")
    return ts.join(te, F.col("te.cnpj_basico") == F.col("ts.cnpj_basico"), "left")


def companies_of_partner_id(r: Registry, partner_id: str) -> DataFrame:
    """Company names and partner rows for one partner id."""
    return (_partners_with_company(r).where(F.col("ts.cnpj_cpf_socio") == partner_id)
            .select(F.col("te.razao_social"), *star(("ts", S.SOCIOS_TABLE_COLUMNS))))


def companies_of_partner_name(r: Registry, name: str) -> DataFrame:
    """Partner rows and their companies for one partner name."""
    return (_partners_with_company(r).where(F.col("ts.nome_socio") == name)
            .select(*star(("ts", S.SOCIOS_TABLE_COLUMNS), ("te", S.EMPRESAS_TABLE_COLUMNS))))


def partners_of(r: Registry, cnpj: str) -> DataFrame:
    """Partners of one company (full id) with the company row."""
    return (_partners_with_company(r).where(F.col("ts.cnpj") == cnpj)
            .select(*star(("ts", S.SOCIOS_TABLE_COLUMNS), ("te", S.EMPRESAS_TABLE_COLUMNS))))
