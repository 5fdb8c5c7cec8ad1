"""Registered ingestion queries: landed latin-1 text in two layouts -> bronze -> silver.

Every query writes (once per application) the ``raw`` rows as landed text files into
the shared scratch folder and reads them back with the library's readers; the oracle
is the direct SQL over the same rows, since the round trip must be an identity.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from microlake.functions import clean
from microlake.operators import dims, marts
from microlake.operators.silver import to_silver
from microlake.queries import inputs, landing
from microlake.queries import marts as mart_queries
from microlake.queries import oracle as o
from microlake.session import scratch_path
from microlake.sources import json_dim, text


def _root(spark, sf):
    return landing.landing(spark, sf)


def _bronze(spark, sf):
    return text.read_landing(spark, _root(spark, sf))


def _files(spark, sf):
    return _root(spark, sf) + "/*/*"


def _with_year(df):
    return df.withColumn("ano", F.regexp_extract("caminho", r"/(\d{4})/[^/]+$", 1).cast("int"))


def bronze_roundtrip(spark, sf):
    return _bronze(spark, sf)


def bronze_two_layouts(spark, sf):
    b = _bronze(spark, sf)
    return b.groupBy("ano", "arquivo_origem").agg(
        F.count(F.lit(1)).alias("qtd"),
        F.sum(clean.decimal_of(F.col("vl_remun_dezembro_nom"))).alias("soma_dez"),
        F.count("tempo_emprego").alias("qtd_tempo"),
        F.count("ind_trab_intermitente").alias("qtd_intermitente"))


def layout_separator(spark, sf):
    h = _with_year(text.headers(spark, _files(spark, sf)))
    return h.select("ano", "arquivo", text.separator_of(F.col("header")).alias("sep"))


def layout_report(spark, sf):
    lay = _with_year(text.layouts(spark, _files(spark, sf)))
    return lay.select("ano", "arquivo", "sep", "qtd_colunas", "faltando")


def canonical_layout(spark, sf):
    lay = _with_year(text.layouts(spark, _files(spark, sf)))
    return lay.select("ano", "arquivo", F.posexplode("colunas").alias("posicao", "coluna"))


def normalized_schema(spark, sf):
    lay = _with_year(text.layouts(spark, _files(spark, sf)))
    return lay.select("ano", "arquivo",
                      F.posexplode("colunas_normalizadas").alias("posicao", "coluna"))


def missing_columns(spark, sf):
    lay = _with_year(text.layouts(spark, _files(spark, sf)))
    return lay.select("ano", "arquivo", F.explode("faltando").alias("coluna"))


def rows_per_source_file(spark, sf):
    return text.rows_per_file(_bronze(spark, sf))


def source_reconciliation(spark, sf):
    expected = text.line_counts(spark, _files(spark, sf))
    loaded = text.rows_per_file(_bronze(spark, sf)).withColumnRenamed("arquivo_origem", "arquivo")
    return text.reconcile(expected, loaded, ["ano", "arquivo"], "linhas_dados", "qtd_linhas")


def file_fingerprints(spark, sf):
    """Lines and order-free checksum of every landed file (sizes and line order are the writer's)."""
    return text.fingerprints(spark, _files(spark, sf)).select("ano", "arquivo", "linhas", "checksum")


def null_state_by_source(spark, sf):
    s = to_silver(_bronze(spark, sf), keep=["arquivo_origem"])
    return s.groupBy("ano", "arquivo_origem").agg(
        F.count(F.lit(1)).alias("qtd"),
        F.count_if(F.col("cod_uf").isNull()).alias("qtd_uf_nula"),
        F.count_if(F.col("remun_dezembro_nom").isNull()).alias("qtd_remun_nula"))


def landing_to_employment(spark, sf):
    """Text files -> bronze -> silver -> employment mart, end to end."""
    s = to_silver(_bronze(spark, sf))
    return marts.employment(marts.active(s), dims.state_dim(spark))


def json_nested_dim(spark, sf):
    """nation x region written as nested, gzipped JSON; read back with an explicit
    schema and flattened to four strings."""
    na = inputs.table(spark, sf, "nation")
    re = inputs.table(spark, sf, "region")
    nested = na.join(re, na.n_regionkey == re.r_regionkey).select(
        ((11 + F.col("n_nationkey")) * 100000 + F.col("n_nationkey")).cast("long").alias("id"),
        F.col("n_name").alias("nome"),
        F.struct(F.struct(F.struct(
            F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("sigla"),
            F.struct(F.col("r_name").alias("nome")).alias("regiao")).alias("UF"))
            .alias("regiao-intermediaria")).alias("regiao-imediata"))
    path = scratch_path(spark, "municipios-json")
    nested.write.mode("overwrite").option("compression", "gzip").json(path)
    return json_dim.flatten_municipalities(json_dim.read_nested(spark, path))


QUERIES = {f.__name__: f for f in [
    bronze_roundtrip, bronze_two_layouts, layout_separator, layout_report, canonical_layout,
    normalized_schema, missing_columns, rows_per_source_file, source_reconciliation,
    file_fingerprints, null_state_by_source, landing_to_employment, json_nested_dim]}

# --- oracle ------------------------------------------------------------------------------

_DIGIT = "substring(municipio, 1, 1)"
_FILE = (f"'VINCULOS_' || coalesce(CASE {_DIGIT} WHEN '1' THEN 'NORTE' WHEN '2' THEN 'NORDESTE' "
         f"WHEN '3' THEN 'SUDESTE' WHEN '4' THEN 'SUL' WHEN '5' THEN 'CENTRO-OESTE' END, 'IGNORADO') "
         f"|| CASE WHEN {_DIGIT} = '2' THEN '.COMT' ELSE '.txt' END")
_TEXT_COLS = ["municipio", "cnae_2_0_classe", "cbo_ocupacao_2002", "vinculo_ativo_31_12",
              "sexo_trabalhador", "escolaridade_apos_2005", "raca_cor", "idade",
              "mes_desligamento", "motivo_desligamento", "tamanho_estabelecimento",
              "natureza_juridica", "vl_remun_dezembro_nom", "vl_remun_media_nom",
              "vl_remun_dezembro_sm", "vl_remun_media_sm"]
_BRONZE = ("bronze AS (SELECT ano, " + ", ".join(f"nullif({c}, '') AS {c}" for c in _TEXT_COLS)
           + ", CASE WHEN novo THEN NULL ELSE nullif(tempo_emprego, '') END AS tempo_emprego"
           + ", CASE WHEN novo THEN '0' END AS ind_trab_intermitente, arquivo_origem"
           + f" FROM (SELECT *, {_FILE} AS arquivo_origem, {_DIGIT} = '2' AS novo FROM raw) l)")
_FILES = f"files AS (SELECT DISTINCT ano, {_FILE} AS arquivo, substring(municipio, 1, 1) = '2' AS novo FROM raw)"
_OLD = ["municipio", "cnae_2_0_classe", "cbo_ocupacao_2002", "vinculo_ativo_31_12",
        "sexo_trabalhador", "escolaridade_apos_2005", "raca_cor", "idade", "tempo_emprego",
        "mes_desligamento", "motivo_desligamento", "tamanho_estabelecimento", "natureza_juridica",
        "vl_remun_dezembro_nom", "vl_remun_media_nom", "vl_remun_dezembro_sm", "vl_remun_media_sm"]
_NEW_NORM = ["municipio_codigo", "cnae_2_0_classe_codigo", "cbo_2002_ocupacao_codigo",
             "ind_vinculo_ativo_31_12_codigo", "sexo_codigo", "escolaridade_apos_2005_codigo",
             "raca_cor_codigo", "idade", "mes_desligamento_codigo", "motivo_desligamento_codigo",
             "tamanho_estabelecimento_codigo", "natureza_juridica_codigo", "vl_rem_dezembro_nom",
             "vl_rem_media_nom", "vl_rem_dezembro_sm", "vl_rem_media_sm", "ind_trab_intermitente"]
_NEW_CANON = [c for c in _OLD if c != "tempo_emprego"] + ["ind_trab_intermitente"]


def _list(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def _exploded(new_names):
    return (o.with_(o.RAW, _FILES) + f"""
SELECT ano, arquivo, CAST(p - 1 AS INT) AS posicao, coluna FROM (
  SELECT ano, arquivo, unnest(CASE WHEN novo THEN {_list(new_names)} ELSE {_list(_OLD)} END) AS coluna,
         generate_subscripts(CASE WHEN novo THEN {_list(new_names)} ELSE {_list(_OLD)} END, 1) AS p
  FROM files) x""")


SQL = {
    "bronze_roundtrip": o.with_(o.RAW, _BRONZE) + "SELECT * FROM bronze",
    "bronze_two_layouts": o.with_(o.RAW, _BRONZE) + f"""
SELECT ano, arquivo_origem, CAST(count(*) AS BIGINT) AS qtd,
  CAST(sum({o.sql_dec('vl_remun_dezembro_nom')}) AS DECIMAL(28,2)) AS soma_dez,
  CAST(count(tempo_emprego) AS BIGINT) AS qtd_tempo,
  CAST(count(ind_trab_intermitente) AS BIGINT) AS qtd_intermitente
FROM bronze GROUP BY ano, arquivo_origem""",
    "layout_separator": o.with_(o.RAW, _FILES)
    + "SELECT ano, arquivo, CASE WHEN novo THEN ',' ELSE ';' END AS sep FROM files",
    "layout_report": o.with_(o.RAW, _FILES) + """
SELECT ano, arquivo, CASE WHEN novo THEN ',' ELSE ';' END AS sep, CAST(17 AS INT) AS qtd_colunas,
  CASE WHEN novo THEN ['tempo_emprego'] ELSE CAST([] AS VARCHAR[]) END AS faltando FROM files""",
    "canonical_layout": _exploded(_NEW_CANON),
    "normalized_schema": _exploded(_NEW_NORM),
    "missing_columns": o.with_(o.RAW, _FILES)
    + "SELECT ano, arquivo, 'tempo_emprego' AS coluna FROM files WHERE novo",
    "rows_per_source_file": o.with_(o.RAW, _BRONZE)
    + "SELECT ano, arquivo_origem, CAST(count(*) AS BIGINT) AS qtd_linhas FROM bronze GROUP BY 1, 2",
    "source_reconciliation": o.with_(o.RAW, _BRONZE) + """
SELECT ano, arquivo_origem AS arquivo, CAST(count(*) AS BIGINT) AS esperado,
  CAST(count(*) AS BIGINT) AS carregado, true AS confere FROM bronze GROUP BY 1, 2""",
    "null_state_by_source": o.with_(o.RAW, _BRONZE) + """
SELECT ano, arquivo_origem, CAST(count(*) AS BIGINT) AS qtd,
  CAST(count_if(NOT regexp_full_match(coalesce(trim(municipio), ''), '[0-9]{6}')) AS BIGINT) AS qtd_uf_nula,
  CAST(count_if(vl_remun_dezembro_nom IS NOT NULL AND trim(vl_remun_dezembro_nom) <> ''
       AND """ + o.sql_dec("vl_remun_dezembro_nom") + """ IS NULL) AS BIGINT) AS qtd_remun_nula
FROM bronze GROUP BY 1, 2""",
    "json_nested_dim": """
SELECT substring(CAST((11 + n_nationkey) * 100000 + n_nationkey AS VARCHAR), 1, 6) AS cod_municipio,
  n_name AS nome_municipio, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS uf, r_name AS regiao
FROM nation JOIN region ON n_regionkey = r_regionkey""",
}


def _landed_lines():
    """Every line of the landed files, headers too, as the CSV writer puts it."""
    old = " || ';' || ".join(f"""CASE WHEN {c} = '' THEN '""' ELSE {c} END""" for c in landing.OLD_HEADERS)
    new = " || ',' || ".join(f"""'"' || {c} || '"'""" if c != "ind_trab_intermitente" else """'"0"'""" for c in landing.NEW_HEADERS)
    old_head = ";".join(landing.OLD_HEADERS.values())
    new_head = ",".join(f'"{h}"' for h in landing.NEW_HEADERS.values())
    return (f"lines AS (SELECT ano, {_FILE} AS arquivo, CASE WHEN {_DIGIT} = '2' THEN {new} ELSE {old} END AS line FROM raw "
            f"UNION ALL SELECT ano, arquivo, CASE WHEN novo THEN '{new_head}' ELSE '{old_head}' END FROM files)")


SQL["file_fingerprints"] = o.with_(o.RAW, _FILES, _landed_lines()) + """
SELECT ano, arquivo, CAST(count(*) AS BIGINT) AS linhas,
  CAST(sum(CAST('0x' || substring(md5(line), 1, 15) AS BIGINT)) AS DECIMAL(38,0)) AS checksum FROM lines GROUP BY ano, arquivo"""
SQL["landing_to_employment"] = mart_queries.SQL["mart_employment"]


def incremental_bronze(spark, sf):
    """Landed files loaded by an availableNow stream, a few at a time, into a parquet bronze
    table; a second run finds nothing new and appends nothing."""
    from microlake.streaming import incremental
    target = scratch_path(spark, "bronze-stream")
    ckpt = scratch_path(spark, "bronze-stream-ckpt")
    root = _root(spark, sf)
    incremental.load_landing_incrementally(spark, root, target, ckpt, max_files_per_trigger=20)
    incremental.load_landing_incrementally(spark, root, target, ckpt)           # finds nothing new
    return incremental.read_sink(spark, target)


QUERIES["incremental_bronze"] = incremental_bronze
SQL["incremental_bronze"] = SQL["bronze_roundtrip"]


def storage_ratio(spark, sf):
    """Bytes of the landed text against the same rows as a Parquet bronze table."""
    from microlake.sinks import tables
    root = _root(spark, sf)
    path = scratch_path(spark, "bronze-parquet")
    tables.write_table(_bronze(spark, sf), path)
    text_bytes = tables.storage_bytes(spark, root + "/*/*")
    parquet_bytes = tables.storage_bytes(spark, path + "/*/*")
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("linhas")).select(
        "linhas", F.lit(text_bytes).alias("bytes_texto"), F.lit(parquet_bytes).alias("bytes_parquet"),
        F.round(F.lit(text_bytes) / F.lit(max(parquet_bytes, 1)), 2).alias("razao"))


QUERIES["storage_ratio"] = storage_ratio


def silver_by_file(spark, sf):
    """Silver from the landed files with column presence decided per source file."""
    from microlake.operators.silver import to_silver_by_file
    rows = text.landed_rows(spark, _files(spark, sf))
    return to_silver_by_file(text.layout_frames(spark, rows, None), rows)


QUERIES["silver_by_file"] = silver_by_file
SQL["silver_by_file"] = o.with_(o.RAW, _BRONZE, o.SILVER.replace("FROM raw) s0", "FROM bronze) s0")) \
    + "SELECT * FROM silver"


def lake_gold_employment(spark, sf):
    """Every landed year loaded through the composed stages (bronze, gated silver with
    per-file presence, two-scan gold); the published employment mart is returned."""
    from microlake import stages
    from microlake.sinks import files, tables
    root = _root(spark, sf)
    years = sorted({int(p.split("/")[-2]) for p in files.list_files(spark, root + "/*/*")})
    lake = scratch_path(spark, "lake")
    gold = stages.load_years(spark, root, years, lake, "run-1", "2024-01-01 00:00:00")
    return tables.read_table(spark, gold["gold_emprego_uf_ano"])


QUERIES["lake_gold_employment"] = lake_gold_employment
SQL["lake_gold_employment"] = mart_queries.SQL["mart_employment"]
