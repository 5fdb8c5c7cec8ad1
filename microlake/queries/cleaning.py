"""Registered cleaning queries: typed columns, value rules, derived fields (view ``raw``)."""
from __future__ import annotations

from pyspark.sql import functions as F

from microlake.functions import clean
from microlake.operators.silver import to_silver
from microlake.queries import inputs
from microlake.queries import oracle as o


def silver_full(spark, sf):
    return inputs.silver(spark, sf)


def silver_invalid_to_null(spark, sf):
    """Per year: how many present raw values each value rule turned into NULL."""
    raw = inputs.raw(spark, sf)
    kept = ["municipio", "cnae_2_0_classe", "idade", "mes_desligamento"]
    s = to_silver(raw, keep=[F.col(c).alias(f"raw_{c}") for c in kept])
    nulled = {
        "municipio_invalido": ("raw_municipio", "cod_municipio"),
        "cnae_invalido": ("raw_cnae_2_0_classe", "cnae_classe"),
        "idade_fora_faixa": ("raw_idade", "idade"),
        "mes_fora_faixa": ("raw_mes_desligamento", "mes_desligamento"),
    }
    return s.groupBy("ano").agg(
        F.count(F.lit(1)).alias("qtd_linhas"),
        *[F.count_if(F.col(r).isNotNull() & F.col(t).isNull()).alias(n)
          for n, (r, t) in nulled.items()],
    )


def silver_derived(spark, sf):
    return inputs.silver(spark, sf).select(
        "ano", "cod_municipio", "cod_uf", "cnae_classe", "cnae_divisao",
        "mes_desligamento", "desligado_no_ano")


def safe_int(spark, sf):
    """Distinct text -> int mappings of three code columns, with their frequency."""
    raw = inputs.raw(spark, sf)
    return (raw.groupBy("sexo_trabalhador", "idade", "raca_cor")
            .agg(F.count(F.lit(1)).alias("qtd"))
            .select("sexo_trabalhador", "idade", "raca_cor", "qtd",
                    clean.int_of(F.col("sexo_trabalhador")).alias("sexo"),
                    clean.int_of(F.col("idade")).alias("idade_int"),
                    clean.int_of(F.col("raca_cor")).alias("raca_cor_int")))


def safe_decimal(spark, sf):
    """Both decimal formats per year: parsed totals and count of unparseable values."""
    raw = inputs.raw(spark, sf)
    d = clean.decimal_of(F.col("vl_remun_dezembro_nom"))
    m = clean.decimal_of(F.col("vl_remun_media_nom"))
    t = clean.decimal_of(F.col("tempo_emprego"), 10, 1)
    return raw.groupBy("ano").agg(
        F.count(d).alias("qtd_dez_validos"),
        F.count_if(d.isNull()).alias("qtd_dez_nulos"),
        F.sum(d).alias("soma_dez"),
        F.sum(m).alias("soma_media"),
        F.sum(t).alias("soma_tempo"),
    )


def pay_empty_is_zero(spark, sf):
    raw = inputs.raw(spark, sf)
    pay = clean.pay_of(F.col("vl_remun_dezembro_nom"))
    txt = F.trim(F.col("vl_remun_dezembro_nom"))
    return raw.groupBy("ano").agg(
        F.count_if(txt.isNull() | (txt == "")).alias("qtd_vazio"),
        F.count_if(pay == 0).alias("qtd_zero"),
        F.count_if(pay.isNull()).alias("qtd_invalido"),
        F.sum(pay).alias("soma"),
    )


def flag_to_bool(spark, sf):
    raw = inputs.raw(spark, sf)
    return (raw.groupBy("vinculo_ativo_31_12").agg(F.count(F.lit(1)).alias("qtd"))
            .withColumn("vinculo_ativo", clean.flag_of(F.col("vinculo_ativo_31_12"))))


def _order_date_text(spark, sf):
    """Order dates as text; every 97th order gets an impossible month (malformed)."""
    od = inputs.table(spark, sf, "orders")
    txt = F.date_format("o_orderdate", "yyyy-MM-dd")
    bad = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-13-"),
                   F.date_format("o_orderdate", "dd"))
    return od.select("o_orderkey", F.when(F.col("o_orderkey") % 97 == 0, bad)
                     .otherwise(txt).alias("data_texto"))


def dates_safe(spark, sf):
    d = _order_date_text(spark, sf).withColumn("data", clean.date_of(F.col("data_texto")))
    return (d.groupBy(F.year("data").alias("ano"))
            .agg(F.count(F.lit(1)).alias("qtd"), F.min("data").alias("primeira"),
                 F.max("data").alias("ultima")))


def optional_columns(spark, sf):
    """A layout without two columns: they become typed NULLs, nothing fails."""
    raw = inputs.raw(spark, sf).drop("natureza_juridica", "vl_remun_media_sm")
    s = to_silver(raw)
    return s.groupBy("ano").agg(
        F.count(F.lit(1)).alias("qtd"),
        F.count("natureza_juridica").alias("qtd_natureza"),
        F.count("remun_media_sm").alias("qtd_media_sm"),
        F.count("remun_media_nom").alias("qtd_media_nom"),
    )


def basic_projection(spark, sf):
    """select / alias / arithmetic / filter with & | ~ / withColumn / rename / drop / cast."""
    od = inputs.table(spark, sf, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return (od.filter(((F.col("o_orderstatus") == "F") | ~(F.col("o_totalprice") < 100000))
                      & F.col("o_orderpriority").isNotNull())
            .select("o_orderkey", "o_custkey", "o_orderstatus", price.alias("total"),
                    F.col("o_orderdate").cast("date").alias("data"))
            .withColumn("total_13", F.col("total") * 13)
            .withColumn("metade", (F.col("total") / 2).cast("decimal(20,3)"))
            .withColumnRenamed("o_orderstatus", "status")
            .drop("o_custkey"))


def pay_bands(spark, sf):
    s = inputs.silver(spark, sf)
    return s.select("ano", "cod_municipio", "remun_dezembro_nom",
                    clean.pay_band(F.col("remun_dezembro_nom")).alias("faixa"))


def region_from_code(spark, sf):
    s = inputs.silver(spark, sf)
    return (s.withColumn("regiao", clean.region_of(F.col("cod_uf")))
            .groupBy("ano", "regiao").agg(F.count(F.lit(1)).alias("qtd_vinculos")))


def synthetic_rows(spark, sf):
    """The defect-injected text rows themselves (generator over lineitem)."""
    return inputs.raw(spark, sf)


QUERIES = {f.__name__: f for f in [
    silver_full, silver_invalid_to_null, silver_derived, safe_int, safe_decimal,
    pay_empty_is_zero, flag_to_bool, dates_safe, optional_columns, basic_projection,
    pay_bands, region_from_code, synthetic_rows]}

_B = o.with_(*o.BASE)
_DATE_TXT = """dt AS (SELECT o_orderkey,
  CASE WHEN o_orderkey % 97 = 0 THEN strftime(o_orderdate, '%Y') || '-13-' || strftime(o_orderdate, '%d')
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS data_texto FROM orders)"""

SQL = {
    "silver_full": _B + "SELECT * FROM silver",
    "silver_invalid_to_null": o.with_(o.RAW) + f"""
SELECT ano, CAST(count(*) AS BIGINT) AS qtd_linhas,
  CAST(count_if(municipio IS NOT NULL AND NOT regexp_full_match(trim(municipio), '[0-9]{{6}}')) AS BIGINT) AS municipio_invalido,
  CAST(count_if(cnae_2_0_classe IS NOT NULL AND NOT regexp_full_match(trim(cnae_2_0_classe), '[0-9]{{5}}')) AS BIGINT) AS cnae_invalido,
  CAST(count_if(idade IS NOT NULL AND coalesce(NOT ({o.sql_int('idade')} BETWEEN 14 AND 100), true)) AS BIGINT) AS idade_fora_faixa,
  CAST(count_if(mes_desligamento IS NOT NULL AND coalesce(NOT ({o.sql_int('mes_desligamento')} BETWEEN 1 AND 12), true)) AS BIGINT) AS mes_fora_faixa
FROM raw GROUP BY ano""",
    "silver_derived": _B + """SELECT ano, cod_municipio, cod_uf, cnae_classe, cnae_divisao,
  mes_desligamento, desligado_no_ano FROM silver""",
    "safe_int": o.with_(o.RAW) + f"""
SELECT sexo_trabalhador, idade, raca_cor, CAST(count(*) AS BIGINT) AS qtd,
  {o.sql_int('sexo_trabalhador')} AS sexo, {o.sql_int('idade')} AS idade_int,
  {o.sql_int('raca_cor')} AS raca_cor_int
FROM raw GROUP BY sexo_trabalhador, idade, raca_cor""",
    "safe_decimal": o.with_(o.RAW) + f"""
SELECT ano, CAST(count({o.sql_dec('vl_remun_dezembro_nom')}) AS BIGINT) AS qtd_dez_validos,
  CAST(count_if({o.sql_dec('vl_remun_dezembro_nom')} IS NULL) AS BIGINT) AS qtd_dez_nulos,
  CAST(sum({o.sql_dec('vl_remun_dezembro_nom')}) AS DECIMAL(28,2)) AS soma_dez,
  CAST(sum({o.sql_dec('vl_remun_media_nom')}) AS DECIMAL(28,2)) AS soma_media,
  CAST(sum({o.sql_dec('tempo_emprego', 10, 1)}) AS DECIMAL(20,1)) AS soma_tempo
FROM raw GROUP BY ano""",
    "pay_empty_is_zero": o.with_(o.RAW) + f"""
SELECT ano,
  CAST(count_if(vl_remun_dezembro_nom IS NULL OR trim(vl_remun_dezembro_nom) = '') AS BIGINT) AS qtd_vazio,
  CAST(count_if({o.sql_pay('vl_remun_dezembro_nom')} = 0) AS BIGINT) AS qtd_zero,
  CAST(count_if({o.sql_pay('vl_remun_dezembro_nom')} IS NULL) AS BIGINT) AS qtd_invalido,
  CAST(sum({o.sql_pay('vl_remun_dezembro_nom')}) AS DECIMAL(28,2)) AS soma
FROM raw GROUP BY ano""",
    "flag_to_bool": o.with_(o.RAW) + """
SELECT vinculo_ativo_31_12, CAST(count(*) AS BIGINT) AS qtd,
  trim(vinculo_ativo_31_12) = '1' AS vinculo_ativo
FROM raw GROUP BY vinculo_ativo_31_12""",
    "dates_safe": o.with_(_DATE_TXT) + """
SELECT CAST(year(d) AS INT) AS ano, CAST(count(*) AS BIGINT) AS qtd, min(d) AS primeira, max(d) AS ultima
FROM (SELECT TRY_CAST(data_texto AS DATE) AS d FROM dt) x GROUP BY 1""",
    "optional_columns": _B + """
SELECT ano, CAST(count(*) AS BIGINT) AS qtd, CAST(0 AS BIGINT) AS qtd_natureza,
  CAST(0 AS BIGINT) AS qtd_media_sm, CAST(count(remun_media_nom) AS BIGINT) AS qtd_media_nom
FROM silver GROUP BY ano""",
    "basic_projection": """
SELECT o_orderkey, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
  CAST(o_orderdate AS DATE) AS data,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 13 AS DECIMAL(21,2)) AS total_13,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) / 2 AS DECIMAL(20,3)) AS metade
FROM orders
WHERE (o_orderstatus = 'F' OR NOT (o_totalprice < 100000)) AND o_orderpriority IS NOT NULL""",
    "pay_bands": _B + """
SELECT ano, cod_municipio, remun_dezembro_nom,
  CASE WHEN remun_dezembro_nom IS NULL THEN NULL WHEN remun_dezembro_nom < 3000 THEN 'baixa'
       WHEN remun_dezembro_nom < 4500 THEN 'media' ELSE 'alta' END AS faixa
FROM silver""",
    "region_from_code": _B + f"""
SELECT ano, {o.REGION_CASE.format(c='cod_uf')} AS regiao, CAST(count(*) AS BIGINT) AS qtd_vinculos
FROM silver GROUP BY ano, regiao""",
    "synthetic_rows": o.with_(o.RAW) + "SELECT * FROM raw",
}
