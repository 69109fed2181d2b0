"""DuckDB oracle SQL for the named queries.

Written independently of the Spark code (different formulations where one
exists: window ``row_number`` for arg-max, ``IN`` subqueries for semi-joins)
over the same fixture views as :mod:`marketscope.sources.fixtures`, which
are spelled here as CTEs over the driver's pre-registered tables. Every
query string is self-contained: it carries the CTEs it needs, in dependency
order.
"""

from __future__ import annotations

import re

from marketscope.functions.sections import REGIME_ROWS, SECTIONS, SIZE_ROWS
from marketscope.sources import fixtures as FX
from marketscope.sources import schemas as S
from marketscope.sources.manifest import ARCHIVE_FAMILIES


def K(x: str) -> str:
    return f"lpad(CAST(CAST(({x} - {x} % 2) / 2 AS BIGINT) AS VARCHAR), 8, '0')"


def C(x: str) -> str:
    return f"({K(x)} || CASE WHEN {x} % 2 = 0 THEN '0001' ELSE '0002' END || '00')"


def _values(rows, cols) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(cols)})"


def _select(mapping: dict[str, str], columns: list[str]) -> str:
    return ",\n    ".join(f"{mapping.get(c, chr(39) * 2)} AS {c}" for c in columns)


NUMERIC_PREFIX = r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)"


def lenient_real_sql(x: str) -> str:
    return (f"coalesce(TRY_CAST(regexp_extract(trim(replace({x}, ',', '.')), '{NUMERIC_PREFIX}', 1) "
            f"AS DOUBLE), 0.0)")


_ESTAB = {
    "cnpj_basico": K("k"),
    "cnpj_ordem": "CASE WHEN k % 2 = 0 THEN '0001' ELSE '0002' END",
    "cnpj_dv": "'00'",
    "matriz_filial": "CASE WHEN k % 2 = 0 THEN '1' ELSE '2' END",
    "nome_fantasia": "name",
    "situacao_cadastral": "CASE WHEN balance > 0 THEN '02' ELSE '08' END",
    "motivo_situacao_cadastral": "'00'",
    "cnae_fiscal": "lpad(CAST(1 + 4 * nation AS VARCHAR), 2, '0') || '0000' || segment",
    "cnae_fiscal_secundaria": "coalesce(lst, '')",
    "municipio": "lpad(CAST(nation AS VARCHAR), 4, '0')",
    "uf": "'U' || CAST(nation % 5 AS VARCHAR)",
    "cep": "CAST(70000000 + (k % 40) * 100000 AS VARCHAR)",
    "cnpj": C("k"),
}
_EMP = {
    "cnpj_basico": K("k"),
    "razao_social": "upper(name)",
    "natureza_juridica": "CASE nation % 3 WHEN 0 THEN '2062' WHEN 1 THEN '2143' ELSE '2330' END",
    "qualificacao_responsavel": "lpad(CAST(nation AS VARCHAR), 2, '0')",
    "porte_empresa": "CASE k % 8 WHEN 0 THEN '01' WHEN 2 THEN '03' WHEN 4 THEN '05' ELSE '' END",
    "capital_social_str": "replace(CAST(CAST(balance AS DECIMAL(18,2)) AS VARCHAR), '.', ',')",
}
_SIMPLES = {
    "cnpj_basico": K("k"),
    "opcao_simples": "CASE WHEN k % 4 = 0 THEN 'S' ELSE 'N' END",
    "opcao_mei": "CASE WHEN k % 10 = 0 THEN 'S' ELSE 'N' END",
}
_SOCIO = {
    "cnpj_basico": "lpad(CAST(s_suppkey AS VARCHAR), 8, '0')",
    "nome_socio": "s_name",
    "cnpj_cpf_socio": "lpad(CAST(s_suppkey % 10 AS VARCHAR), 14, '0')",
    "qualificacao_socio": "lpad(CAST(s_nationkey AS VARCHAR), 2, '0')",
}

_SECTION_CASE = (
    "CASE " + " ".join(f"WHEN d BETWEEN {lo} AND {hi} THEN '{{}}'".format(s)
                       for lo, hi, s, _ in SECTIONS) + " END")
_SECTION_DESC = (
    "CASE " + " ".join(f"WHEN d BETWEEN {lo} AND {hi} THEN '{{}}'".format(desc)
                       for lo, hi, _, desc in SECTIONS) + " END")

# name -> SQL body. Order matters only for readability; dependencies are
# resolved by scanning each body for the names it references.
CTES: dict[str, str] = {
    "sec": f"""SELECT ck, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS lst
    FROM (SELECT o_custkey AS ck, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey
          UNION ALL SELECT {FX.SUPPLIER_BASE} + l_suppkey, l_partkey FROM lineitem) t
    JOIN part ON p_partkey = l_partkey GROUP BY ck""",
    "company": f"""SELECT c_custkey AS k, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
    substr(c_mktsegment, 1, 1) AS segment FROM customer
    UNION ALL SELECT {FX.SUPPLIER_BASE} + s_suppkey, s_name, s_nationkey, s_acctbal,
    substr('{FX.SEGMENTS}', 1 + s_suppkey % 5, 1) FROM supplier""",
    "estabelecimento": f"""SELECT
    {_select(_ESTAB, S.ESTABELECIMENTO_TABLE_COLUMNS)}
    FROM company LEFT JOIN sec ON k = ck""",
    "empresas_raw": f"""SELECT
    {_select(_EMP, S.EMPRESAS_COLUMNS)}
    FROM company WHERE k % 2 = 0 AND k % 14 <> 0""",
    "empresas": f"""SELECT {', '.join(S.EMPRESAS_TABLE_COLUMNS[:-1])},
    {lenient_real_sql('capital_social_str')} AS capital_social
    FROM empresas_raw""",
    "simples": f"""SELECT
    {_select(_SIMPLES, S.SIMPLES_COLUMNS)}
    FROM company WHERE k % 2 = 0 AND k % 22 <> 0""",
    "socios_original": f"""SELECT
    {_select(_SOCIO, S.SOCIOS_COLUMNS)}
    FROM supplier""",
    "socios": """SELECT e.cnpj AS cnpj, so.*
    FROM socios_original so JOIN estabelecimento e ON e.cnpj_basico = so.cnpj_basico
    WHERE e.matriz_filial = '1'""",
    "municipio": """SELECT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS codigo, n_name AS descricao
    FROM nation WHERE n_nationkey < 24""",
    "cnae": """SELECT codigo, 'Atividade ' || codigo AS descricao
    FROM (SELECT DISTINCT cnae_fiscal AS codigo FROM estabelecimento) x""",
    "natureza_juridica": _values(FX.NATUREZA_ROWS, S.CODE_COLUMNS),
    "motivo": _values(FX.MOTIVO_ROWS, S.CODE_COLUMNS),
    "pais": _values(FX.PAIS_ROWS, S.CODE_COLUMNS),
    "qualificacao_socio": _values(FX.QUALIFICACAO_ROWS, S.CODE_COLUMNS),
    "vendas": f"""SELECT CAST(l.l_partkey AS VARCHAR) AS "it-codigo", p.p_brand AS familia,
    p.p_type AS familia_comercial, {C('o.o_custkey')} AS cnpj, c.c_name AS cliente,
    CAST(l.l_extendedprice AS DECIMAL(18,2)) AS valor
    FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part p ON l.l_partkey = p.p_partkey
    JOIN customer c ON c.c_custkey = o.o_custkey""",
    "leads": f"""SELECT {C('u')} AS cnpj, data FROM (
      SELECT CASE WHEN user_id % 2 = 0 THEN user_id ELSE {FX.SUPPLIER_BASE} + (user_id - 1) // 2 END AS u,
             CAST(CAST(ts AS DATE) AS VARCHAR) AS data
      FROM events WHERE event_type = 'signup') e""",
    # ---------------------------------------------------------- model stages
    "ativos": """SELECT cnpj, cnae_fiscal, municipio, cnpj_basico, nome_fantasia
    FROM estabelecimento WHERE situacao_cadastral = '02'""",
    "clientes_cnaes": """SELECT DISTINCT cnae_fiscal AS cnae FROM ativos
    WHERE cnpj IN (SELECT cnpj FROM vendas WHERE cnpj IS NOT NULL) AND cnae_fiscal IS NOT NULL""",
    "cnpjs_alvo": """SELECT DISTINCT cnpj FROM ativos
    WHERE cnae_fiscal IN (SELECT cnae FROM clientes_cnaes) AND cnpj IS NOT NULL""",
    "fato_base": """SELECT a.cnpj, a.cnae_fiscal, a.municipio, a.cnpj_basico, a.nome_fantasia,
    em.razao_social, coalesce(em.porte_empresa, '00') AS porte_empresa,
    CAST(CASE WHEN si.cnpj_basico IS NULL THEN NULL WHEN si.opcao_mei = 'S' THEN 1
              WHEN si.opcao_simples = 'S' THEN 2 ELSE 3 END AS INTEGER) AS id_regime_tributario,
    CAST(CASE WHEN a.cnpj IN (SELECT cnpj FROM leads WHERE cnpj IS NOT NULL) THEN 1 ELSE 0 END AS INTEGER) AS possui_lead,
    CAST(CASE WHEN a.cnpj IN (SELECT cnpj FROM vendas WHERE cnpj IS NOT NULL) THEN 1 ELSE 0 END AS INTEGER) AS atual_cliente
    FROM ativos a
    LEFT JOIN empresas em ON em.cnpj_basico = a.cnpj_basico
    LEFT JOIN simples si ON si.cnpj_basico = a.cnpj_basico
    WHERE a.cnpj IN (SELECT cnpj FROM cnpjs_alvo)""",
    "cnae_secundaria": """SELECT cnpj, unnest(string_split(cnae_fiscal_secundaria, ',')) AS cnae_fiscal_secundaria
    FROM estabelecimento WHERE cnae_fiscal_secundaria <> ''""",
    "empresa_cnaes": """SELECT DISTINCT cnpj, code FROM (
      SELECT cnpj, cnae_fiscal AS code FROM fato_base WHERE cnae_fiscal IS NOT NULL
      UNION ALL
      SELECT cnpj, cnae_fiscal_secundaria AS code FROM cnae_secundaria
      WHERE cnpj IN (SELECT cnpj FROM fato_base) AND cnae_fiscal_secundaria IS NOT NULL) u""",
    "pares": """SELECT p.cnpj, c.cnpj AS cliente, count(*) AS k, max(nc.n) AS n
    FROM empresa_cnaes p
    JOIN empresa_cnaes c ON p.code = c.code
    JOIN (SELECT cnpj, count(*) AS n FROM empresa_cnaes GROUP BY cnpj) nc ON nc.cnpj = c.cnpj
    WHERE p.cnpj IN (SELECT cnpj FROM fato_base WHERE atual_cliente = 0)
      AND c.cnpj IN (SELECT cnpj FROM fato_base WHERE atual_cliente = 1)
    GROUP BY p.cnpj, c.cnpj""",
    "representantes": """SELECT min(cnpj) AS cnpj FROM (
      SELECT ec.cnpj, max(f.atual_cliente) AS lado, string_agg(DISTINCT ec.code, ',' ORDER BY ec.code) AS conjunto
      FROM empresa_cnaes ec JOIN fato_base f ON f.cnpj = ec.cnpj GROUP BY ec.cnpj) x
    GROUP BY lado, conjunto""",
    "similares": """SELECT pr.cnpj, b.cliente AS cnpj_mais_similar, coalesce(b.sim, 0.0) AS similaridade
    FROM (SELECT DISTINCT cnpj FROM fato_base WHERE atual_cliente = 0) pr
    LEFT JOIN (
      SELECT cnpj, cliente, sim FROM (
        SELECT cnpj, cliente, CAST(k AS DOUBLE) / CAST(n AS DOUBLE) AS sim,
               row_number() OVER (PARTITION BY cnpj ORDER BY CAST(k AS DOUBLE) / CAST(n AS DOUBLE) DESC, cliente) AS rn
        FROM pares) r WHERE rn = 1) b ON b.cnpj = pr.cnpj""",
    "fato_empresas": """SELECT f.*, s.cnpj_mais_similar, s.similaridade
    FROM fato_base f LEFT JOIN similares s ON s.cnpj = f.cnpj""",
    "vendas_item": """SELECT cnpj, "it-codigo", familia, familia_comercial,
    CAST(coalesce(sum(valor), 0) AS DOUBLE) AS valor
    FROM vendas
    WHERE cnpj IS NOT NULL AND "it-codigo" IS NOT NULL AND familia IS NOT NULL AND familia_comercial IS NOT NULL
    GROUP BY cnpj, "it-codigo", familia, familia_comercial""",
    "top5": """SELECT cnpj, "it-codigo", familia, familia_comercial, valor FROM (
      SELECT *, row_number() OVER (PARTITION BY cnpj ORDER BY valor DESC, "it-codigo", familia, familia_comercial) AS rn
      FROM vendas_item) r WHERE rn <= 5""",
    "dim_cnae": f"""SELECT codigo, descricao, {_SECTION_CASE} AS sigla_secao, {_SECTION_DESC} AS desc_secao
    FROM (SELECT codigo, descricao, CAST(substr(codigo, 1, 2) AS INTEGER) AS d FROM cnae) x""",
    "dim_municipio": """SELECT g.municipio, (SELECT max(descricao) FROM municipio WHERE codigo = g.municipio) AS descricao_municipio,
    g.uf, g.cep
    FROM (SELECT municipio, uf, cep FROM ativos_local WHERE uf IS NOT NULL GROUP BY municipio, uf, cep) g
    WHERE EXISTS (SELECT 1 FROM municipio WHERE codigo = g.municipio)""",
    "ativos_local": """SELECT municipio, uf, cep FROM estabelecimento WHERE situacao_cadastral = '02'""",
    "dim_porte_empresa": _values(SIZE_ROWS, ["porte_empresa", "descricao_porte_empresa"]),
    "dim_regime_tributario": _values(REGIME_ROWS, ["id_regime_tributario", "descricao_regime_tributario"]),
}


def _deps(name: str, seen: list[str], visiting: frozenset = frozenset()) -> None:
    body = CTES[name]
    for other in CTES:
        if (other != name and other not in seen and other not in visiting
                and re.search(rf"\b{re.escape(other)}\b", body)):
            _deps(other, seen, visiting | {name})
    if name not in seen:
        seen.append(name)


def with_ctes(sql: str) -> str:
    """Prefix ``sql`` with every fixture/model CTE it (transitively) references."""
    order: list[str] = []
    for name in CTES:
        if re.search(rf"\b{re.escape(name)}\b", sql):
            _deps(name, order)
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS (\n    {CTES[n]}\n)" for n in order) + "\n" + sql


def star_sql(*parts: tuple[str, list[str]]) -> str:
    """``a.*, b.*`` with later duplicate names suffixed ``_1``, ``_2``."""
    seen: dict[str, int] = {}
    out = []
    for alias, columns in parts:
        for c in columns:
            n = seen.get(c)
            name = c if n is None else f"{c}_{n + 1}"
            seen[c] = 0 if n is None else n + 1
            out.append(f'{alias}."{c}" AS "{name}"')
    return ", ".join(out)


_REGIME_CASE = ("CAST(CASE WHEN si.opcao_mei = 'S' THEN 1 WHEN si.opcao_simples = 'S' THEN 2 "
                "ELSE 3 END AS INTEGER)")
_PROFILE_FROM = "FROM estabelecimento t LEFT JOIN empresas te ON te.cnpj_basico = t.cnpj_basico"


def _label(table: str, key: str) -> str:
    return f"(SELECT max(descricao) FROM {table} WHERE codigo = {key})"


_PROFILE_SELECT = star_sql(("te", S.EMPRESAS_TABLE_COLUMNS), ("t", S.ESTABELECIMENTO_TABLE_COLUMNS)) + f""",
    {_label('cnae', 't.cnae_fiscal')} AS cnae_fiscal_,
    {_label('municipio', 't.municipio')} AS municipio_,
    coalesce({_label('pais', 't.pais')}, '') AS pais_,
    {_label('motivo', 't.motivo_situacao_cadastral')} AS motivo_situacao_cadastral_,
    {_label('natureza_juridica', 'te.natureza_juridica')} AS natureza_juridica_"""
_STAR_FROM = """FROM fato_empresas f
    LEFT JOIN dim_porte_empresa dp ON dp.porte_empresa = f.porte_empresa
    LEFT JOIN dim_regime_tributario dr ON dr.id_regime_tributario = f.id_regime_tributario
    LEFT JOIN (SELECT codigo, descricao AS descricao_cnae, sigla_secao, desc_secao FROM dim_cnae) dc
           ON dc.codigo = f.cnae_fiscal
    LEFT JOIN (SELECT municipio, min(descricao_municipio) AS descricao_municipio, min(uf) AS uf
               FROM dim_municipio GROUP BY municipio) dm ON dm.municipio = f.municipio"""
_STAR_SELECT = """f.*, dp.descricao_porte_empresa, dr.descricao_regime_tributario, dc.descricao_cnae,
    dc.sigla_secao, dc.desc_secao, dm.descricao_municipio, dm.uf"""
_MEASURES = """CAST(sum(atual_cliente) AS BIGINT) AS atendidos,
    CAST(sum(1 - atual_cliente) AS BIGINT) AS potencial,
    CAST(sum(atual_cliente) AS DOUBLE) / NULLIF(CAST(count(*) AS DOUBLE), 0) AS cobertura,
    CAST(sum(possui_lead) AS BIGINT) AS leads,
    CAST(sum(possui_lead) AS DOUBLE) / NULLIF(CAST(count(*) AS DOUBLE), 0) AS pct_leads,
    CAST(count(*) AS BIGINT) AS empresas"""

QUERY_SQL: dict[str, str] = {
    "p1_active_establishments": "SELECT * FROM ativos",
    "e1_full_id": "SELECT cnpj_basico, cnpj_ordem, cnpj_dv, cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj FROM estabelecimento",
    "e3_capital": f"SELECT cnpj_basico, capital_social_str, {lenient_real_sql('capital_social_str')} AS capital_social FROM empresas_raw",
    "e4_tax_regime": f"SELECT cnpj_basico, opcao_simples, opcao_mei, {_REGIME_CASE} AS id_regime_tributario FROM simples si",
    "e7_membership_flags": """SELECT a.cnpj,
    CAST(CASE WHEN a.cnpj IN (SELECT cnpj FROM leads WHERE cnpj IS NOT NULL) THEN 1 ELSE 0 END AS INTEGER) AS possui_lead,
    CAST(CASE WHEN a.cnpj IN (SELECT cnpj FROM vendas WHERE cnpj IS NOT NULL) THEN 1 ELSE 0 END AS INTEGER) AS atual_cliente
    FROM ativos a""",
    "e9_sections": f"""SELECT codigo, d AS divisao, {_SECTION_CASE} AS sigla_secao, {_SECTION_DESC} AS desc_secao
    FROM (SELECT codigo, CAST(substr(codigo, 1, 2) AS INTEGER) AS d FROM cnae) x""",
    "e11_id_as_bigint": "SELECT cnpj, CAST(cnpj AS BIGINT) AS cnpj_int FROM estabelecimento",
    "j1_company_enrichment": """SELECT a.*, em.razao_social, coalesce(em.porte_empresa, '00') AS porte_empresa
    FROM ativos a LEFT JOIN empresas em ON em.cnpj_basico = a.cnpj_basico""",
    "j2_regime_enrichment": f"""SELECT a.cnpj, a.cnpj_basico,
    CASE WHEN si.cnpj_basico IS NULL THEN NULL ELSE {_REGIME_CASE} END AS id_regime_tributario
    FROM ativos a LEFT JOIN simples si ON si.cnpj_basico = a.cnpj_basico""",
    "j4_client_codes": "SELECT * FROM clientes_cnaes",
    "j5_target_market": "SELECT * FROM cnpjs_alvo",
    "j6_prospects": "SELECT * FROM fato_base WHERE atual_cliente = 0",
    "j8_partner_head_office": "SELECT * FROM socios",
    "a1_sales_by_item": "SELECT * FROM vendas_item",
    "a2_distinct_clients": """SELECT DISTINCT 'vendas' AS origem, cnpj FROM vendas WHERE cnpj IS NOT NULL
    UNION ALL SELECT DISTINCT 'leads' AS origem, cnpj FROM leads WHERE cnpj IS NOT NULL""",
    "g1_explode_codes": "SELECT * FROM cnae_secundaria",
    "g2_company_codes": "SELECT * FROM empresa_cnaes",
    "g3_code_signature": """SELECT cnpj, string_agg(DISTINCT code, ',' ORDER BY code) AS codigos,
    CAST(count(*) AS BIGINT) AS n_codigos FROM empresa_cnaes GROUP BY cnpj""",
    "w1_top5_products": "SELECT * FROM top5",
    "d1_dim_activity": "SELECT * FROM dim_cnae",
    "d2_dim_municipality": "SELECT * FROM dim_municipio",
    "d3_dim_size": """SELECT d.porte_empresa, d.descricao_porte_empresa,
    CAST((SELECT count(*) FROM fato_base f WHERE f.porte_empresa = d.porte_empresa) AS BIGINT) AS empresas
    FROM dim_porte_empresa d""",
    "d4_dim_regime": """SELECT d.id_regime_tributario, d.descricao_regime_tributario,
    CAST((SELECT count(*) FROM fato_base f WHERE f.id_regime_tributario = d.id_regime_tributario) AS BIGINT) AS empresas
    FROM dim_regime_tributario d""",
    "m0_similarity_pairs": """SELECT cnpj, cliente, CAST(k AS BIGINT) AS intersecao, CAST(n AS BIGINT) AS n_cliente,
    CAST(k AS DOUBLE) / CAST(n AS DOUBLE) AS similaridade FROM pares
    WHERE cnpj IN (SELECT cnpj FROM representantes) AND cliente IN (SELECT cnpj FROM representantes)""",
    "m0_set_members": """SELECT cnpj, min(cnpj) OVER (PARTITION BY lado, conjunto) AS representante,
    CAST(lado AS INTEGER) AS cliente, CAST(n AS BIGINT) AS n_codigos FROM (
      SELECT ec.cnpj, max(f.atual_cliente) AS lado, count(DISTINCT ec.code) AS n,
             string_agg(DISTINCT ec.code, ',' ORDER BY ec.code) AS conjunto
      FROM empresa_cnaes ec JOIN fato_base f ON f.cnpj = ec.cnpj GROUP BY ec.cnpj) x""",
    "m1_most_similar": "SELECT * FROM similares",
    "m2_fact_companies": "SELECT * FROM fato_empresas",
    "q1_company_profile": f"SELECT {_PROFILE_SELECT}\n    {_PROFILE_FROM}\n    WHERE t.cnpj = '00000003000100'",
    "q2_city_postal_lookup": f"""SELECT {_PROFILE_SELECT}
    {_PROFILE_FROM}
    WHERE t.municipio IN (SELECT codigo FROM municipio WHERE descricao = 'NATION_3') AND t.uf = 'U3' AND t.cep LIKE '72%'
    ORDER BY t.cnpj LIMIT 100""",
    "q3_legal_nature": f"""SELECT {star_sql(("t", S.ESTABELECIMENTO_TABLE_COLUMNS), ("te", S.EMPRESAS_TABLE_COLUMNS),
                                              ("ts", S.SOCIOS_TABLE_COLUMNS))}
    FROM empresas te
    LEFT JOIN estabelecimento t ON t.cnpj_basico = te.cnpj_basico
    LEFT JOIN socios ts ON ts.cnpj = t.cnpj
    WHERE te.natureza_juridica = '2143' OR te.natureza_juridica = '2330'""",
    "q4a_by_partner_id": f"""SELECT te.razao_social, {star_sql(("ts", S.SOCIOS_TABLE_COLUMNS))}
    FROM socios ts LEFT JOIN empresas te ON te.cnpj_basico = ts.cnpj_basico
    WHERE ts.cnpj_cpf_socio = '00000000000003'""",
    "q4b_by_partner_name": f"""SELECT {star_sql(("ts", S.SOCIOS_TABLE_COLUMNS), ("te", S.EMPRESAS_TABLE_COLUMNS))}
    FROM socios ts LEFT JOIN empresas te ON te.cnpj_basico = ts.cnpj_basico
    WHERE ts.nome_socio = 'Supplier#000000003'""",
    "q5_partners_of": f"""SELECT {star_sql(("ts", S.SOCIOS_TABLE_COLUMNS), ("te", S.EMPRESAS_TABLE_COLUMNS))}
    FROM socios ts LEFT JOIN empresas te ON te.cnpj_basico = ts.cnpj_basico
    WHERE ts.cnpj = '00000003000100'""",
    "b1_star_view": f"SELECT {_STAR_SELECT}\n    {_STAR_FROM}",
    "b2_kpis_overall": f"SELECT {_MEASURES} FROM fato_empresas",
    "b3_coverage_by_activity": f"""SELECT cnae_fiscal, sigla_secao, desc_secao, {_MEASURES}
    FROM (SELECT {_STAR_SELECT} {_STAR_FROM}) s GROUP BY cnae_fiscal, sigla_secao, desc_secao""",
    "b4_volume_by_size_segment": f"""SELECT porte_empresa, descricao_porte_empresa, sigla_secao, desc_secao,
    CAST(count(*) AS BIGINT) AS empresas
    FROM (SELECT {_STAR_SELECT} {_STAR_FROM}) s
    GROUP BY porte_empresa, descricao_porte_empresa, sigla_secao, desc_secao""",
    "b5_potential_revenue_by_region": f"""SELECT s.uf, CAST(count(*) AS BIGINT) AS prospects,
    CAST(coalesce(sum(v.valor_cliente), 0) AS DOUBLE) AS receita_potencial
    FROM (SELECT {_STAR_SELECT} {_STAR_FROM}) s
    LEFT JOIN (SELECT cnpj, sum(CAST(valor AS DECIMAL(28,2))) AS valor_cliente FROM top5 GROUP BY cnpj) v
           ON v.cnpj = s.cnpj_mais_similar
    WHERE s.atual_cliente = 0 AND s.cnpj_mais_similar IS NOT NULL
    GROUP BY s.uf""",
    "b6_market_rollup": f"""SELECT uf, sigla_secao, CAST(sum(atual_cliente) AS BIGINT) AS clientes,
    CAST(sum(possui_lead) AS BIGINT) AS leads, CAST(count(*) AS BIGINT) AS mercado,
    CAST(grouping(uf, sigla_secao) AS INTEGER) AS nivel
    FROM (SELECT {_STAR_SELECT} {_STAR_FROM}) s
    GROUP BY ROLLUP (uf, sigla_secao)""",
    "b7_products_for_prospects": """SELECT s.cnpj, s.cnpj_mais_similar, s.similaridade, t."it-codigo", t.familia,
    t.familia_comercial, t.valor
    FROM similares s JOIN top5 t ON t.cnpj = s.cnpj_mais_similar""",
}


# sales lines as text: by item number some lack a field, have one too many, or no number as value
_LINES = """(SELECT v.*, CAST("it-codigo" AS BIGINT) % 50 AS kind, CAST(valor * 0.125 AS DECIMAL(28,6)) AS eighth,
    CASE WHEN CAST("it-codigo" AS BIGINT) % 50 = 4 THEN '"' || cliente || '",' || chr(10) || '2' ELSE cliente END AS nome FROM vendas v) l"""
_KEYS = """'"' || "it-codigo" || '","' || familia || '","' || familia_comercial || '","' || cnpj || '","' || nome || '"'"""
_REJECT = "CASE kind WHEN 0 THEN 'campos a menos' WHEN 1 THEN 'campos a mais' WHEN 2 THEN 'valor invalido' ELSE 'aceito' END"

_RAW_ESTAB = "SELECT " + ", ".join(S.ESTABELECIMENTO_COLUMNS) + " FROM estabelecimento"
QUERY_SQL.update({
    "s1_registry_csv_roundtrip": _RAW_ESTAB,
    "s1_split_read": "SELECT " + ", ".join(
        """'SALA "' || cnpj_ordem || '";' || chr(10) || nome_fantasia AS complemento""" if c == "complemento" else c
        for c in S.ESTABELECIMENTO_COLUMNS) + " FROM estabelecimento",
    "s4_sales_accepted": f"""SELECT "it-codigo", familia, familia_comercial, cnpj, nome AS cliente,
    CASE WHEN kind <> 3 THEN eighth END AS valor FROM {_LINES} WHERE kind > 2""",
    "s4_sales_rejected": f"""SELECT {_REJECT} AS motivo, CAST(CASE kind WHEN 0 THEN 5 WHEN 1 THEN 7 ELSE 6 END AS INTEGER) AS campos,
    {_KEYS} || CASE kind WHEN 0 THEN '' WHEN 1 THEN ',' || CAST(valor * 0.125 AS DECIMAL(28,5)) || ',?' ELSE ',a combinar' END AS registro
    FROM {_LINES} WHERE kind <= 2""",
    "s4_load_counts": f"SELECT {_REJECT} AS situacao, CAST(count(*) AS BIGINT) AS linhas FROM {_LINES} GROUP BY 1",
    "s2_code_table": "SELECT * FROM municipio",
    "s3_zip_scan": "SELECT * FROM empresas_raw",
    "s4_sales_csv": "SELECT * FROM vendas",
    "s5_leads_csv": "SELECT * FROM leads",
    "s6_table_scan": "SELECT * FROM ativos",
    "s7_parquet_roundtrip": "SELECT * FROM fato_empresas",
    "s9_table_append": "SELECT * FROM estabelecimento",
    "s9_table_replace": "SELECT * FROM estabelecimento WHERE matriz_filial <> '1'",
    "s9_atomic_replace": "SELECT * FROM estabelecimento WHERE matriz_filial <> '1'",
    "s10_empty_table": "SELECT * FROM socios_original",
    "s12_snapshot_reload": """SELECT '13/05/2023' AS snapshot, cnpj_basico, razao_social, capital_social_str
    FROM empresas_raw WHERE natureza_juridica <> '2062'
    UNION ALL SELECT '10/06/2023', cnpj_basico, razao_social, capital_social_str FROM empresas_raw""",
    "s14_archive_manifest": f"""SELECT familia, CAST(esperados AS BIGINT) AS esperados,
    CAST(CASE WHEN familia IN ('Empresas', 'Socios') THEN esperados ELSE 0 END AS BIGINT) AS encontrados,
    familia IN ('Empresas', 'Socios') AS completo
    FROM ({_values(ARCHIVE_FAMILIES, ['familia', 'esperados'])}) f""",
    "s12_snapshot_date": "SELECT '10/06/2023' AS snapshot_date, CAST(count(*) AS BIGINT) AS linhas FROM empresas_raw",
    "s13_snapshot_metadata": """SELECT 'CNPJ' AS referencia, '10/06/2023' AS valor
    UNION ALL SELECT 'cnpj_qtde' AS referencia, CAST(count(*) AS VARCHAR) AS valor FROM estabelecimento""",
    "s15_row_counts": """SELECT 'empresas' AS tabela, CAST(count(*) AS BIGINT) AS linhas FROM empresas
    UNION ALL SELECT 'estabelecimento', CAST(count(*) AS BIGINT) FROM estabelecimento
    UNION ALL SELECT 'socios', CAST(count(*) AS BIGINT) FROM socios""",
    "u1_union_chunks": _RAW_ESTAB,
    "s16_stream_ingest": _RAW_ESTAB,
})


QUERY_SQL["q2_clustered_lookup"] = QUERY_SQL["q2_city_postal_lookup"]


def oracle_queries() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in QUERY_SQL.items()}
