"""Data dictionary operators: naming rules, conformance with the real tables, export,
search and one-line summaries. The real side is computed from the tables by Spark
(types from the schema, NULL counts from one aggregate per table)."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from microlake import catalog, config


def load(spark: SparkSession, tables: list = catalog.TABLES, columns: list = catalog.COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(tables, columns) of the dictionary with explicit schemas."""
    return (spark.createDataFrame(tables, catalog.TABLE_SCHEMA),
            spark.createDataFrame(columns, catalog.COLUMN_SCHEMA))


def violations(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """(tabela, coluna, regra) for every broken naming/description rule."""
    t_rules = [
        ("nome_tabela_invalido", ~F.col("tabela").rlike(config.TABLE_NAME_PATTERN)),
        ("descricao_tabela_curta", F.length(F.coalesce("descricao", F.lit(""))) < config.MIN_TABLE_DESCRIPTION),
        ("grao_ausente", F.length(F.trim(F.coalesce("grao", F.lit("")))) == 0),
        ("atualizacao_ausente", F.length(F.trim(F.coalesce("atualizacao", F.lit("")))) == 0),
    ]
    c_rules = [
        ("nome_coluna_invalido", ~F.col("coluna").rlike(config.COLUMN_NAME_PATTERN)),
        ("descricao_coluna_curta", F.length(F.coalesce("descricao", F.lit(""))) < config.MIN_COLUMN_DESCRIPTION),
    ]
    t = tables.select("tabela", F.lit(None).cast("string").alias("coluna"), F.explode(F.array(
        *[F.when(cond, F.lit(name)) for name, cond in t_rules])).alias("regra"))
    c = columns.select("tabela", "coluna", F.explode(F.array(
        *[F.when(cond, F.lit(name)) for name, cond in c_rules])).alias("regra"))
    return t.unionByName(c).filter(F.col("regra").isNotNull())


def actual_columns(frames: dict[str, DataFrame]) -> DataFrame:
    """(tabela, coluna, tipo, nulos, total) of real tables: one aggregate per table
    (single scan), unpivoted; types come from the schema."""
    parts = []
    for name, df in frames.items():
        fields = df.schema.fields
        one = df.agg(F.count(F.lit(1)).alias("_total"),
                     *[F.count_if(F.col(f.name).isNull()).alias(f"_n{i}") for i, f in enumerate(fields)])
        rows = F.explode(F.array(*[
            F.struct(F.lit(f.name).alias("coluna"), F.lit(f.dataType.simpleString()).alias("tipo"),
                     F.col(f"_n{i}").alias("nulos")) for i, f in enumerate(fields)]))
        parts.append(one.select(F.lit(name).alias("tabela"), "_total", rows.alias("r"))
                     .select("tabela", "r.coluna", "r.tipo", "r.nulos", F.col("_total").alias("total")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def conformance(tables: DataFrame, columns: DataFrame, actual: DataFrame) -> DataFrame:
    """Problems between dictionary and reality: missing table, described column that
    does not exist, undescribed column (only for tables marked complete)."""
    present = actual.select("tabela").distinct()
    missing_tables = (tables.join(present, "tabela", "left_anti")
                      .select("tabela", F.lit(None).cast("string").alias("coluna"),
                              F.lit("tabela_nao_encontrada").alias("problema")))
    declared = columns.join(present, "tabela", "left_semi").select("tabela", "coluna", F.lit(True).alias("_d"))
    real = actual.select("tabela", "coluna", F.lit(True).alias("_r"))
    j = (declared.join(real, ["tabela", "coluna"], "full")
         .join(tables.select("tabela", "completa"), "tabela", "left"))
    problem = (F.when(F.col("_r").isNull(), F.lit("coluna_descrita_inexistente"))
               .when(F.col("_d").isNull() & F.coalesce("completa", F.lit(True)), F.lit("coluna_sem_descricao")))
    col_problems = j.select("tabela", "coluna", problem.alias("problema")).filter(F.col("problema").isNotNull())
    return missing_tables.unionByName(col_problems)


def described(columns: DataFrame, actual: DataFrame) -> DataFrame:
    """Dictionary columns joined with the real type and NULL share."""
    return (columns.join(actual, ["tabela", "coluna"], "inner")
            .withColumn("pct_nulo", F.round(F.try_divide(F.col("nulos") * 100, F.col("total")), 2)))


def export_json(tables: DataFrame, columns: DataFrame, actual: DataFrame) -> DataFrame:
    """One JSON document per table: place, owner, description, question, grain, refresh, the
    business rules, and its columns with real type, unit and NULL share (by name)."""
    cols = described(columns, actual).groupBy("tabela").agg(
        F.array_sort(F.collect_list(F.struct("coluna", "tipo", "descricao", "unidade", "pct_nulo")))
        .alias("colunas"))
    doc = tables.join(cols, "tabela", "inner")
    rules = F.array(*[F.lit(r) for r in catalog.RULES])
    return doc.select("tabela", F.to_json(F.struct("tabela", "caminho", F.lit(catalog.OWNER).alias("dono"), "descricao",
                                                   "pergunta", "grao", "atualizacao", rules.alias("regras"), "colunas"),
                                          {"ignoreNullFields": "false"}).alias("json"))


def search_by_unit(columns: DataFrame, actual: DataFrame, unit: str) -> DataFrame:
    return described(columns, actual).filter(F.col("unidade") == unit) \
        .select("tabela", "coluna", "tipo", "unidade", "nulos")


def one_line(tables: DataFrame, actual: DataFrame, prefix: str = "gold.") -> DataFrame:
    """'<table>: <description> Grain: <grain>. Columns: a (type), b (type)' per table."""
    cols = (actual.filter(F.col("tabela").startswith(prefix))
            .groupBy("tabela")
            .agg(F.array_sort(F.collect_list(F.concat("coluna", F.lit(" ("), "tipo", F.lit(")"))))
                 .alias("_c")))
    return tables.join(cols, "tabela", "inner").select(
        "tabela", F.concat(F.col("tabela"), F.lit(": "), F.col("descricao"), F.lit(" Grão: "),
                           F.col("grao"), F.lit(". Colunas: "), F.concat_ws(", ", "_c")).alias("texto"))


def comments_for(columns: DataFrame, table: str) -> dict[str, str]:
    """Column -> comment text (description plus unit) of one table. Only dictionary
    rows (a few dozen) are collected."""
    rows = columns.filter(F.col("tabela") == table).collect()
    return {r["coluna"]: r["descricao"] + (f" Unidade: {r['unidade']}." if r["unidade"] else "")
            for r in rows}


def properties_for(tables: DataFrame, table: str) -> dict[str, str]:
    """Table properties of one dictionary entry."""
    r = tables.filter(F.col("tabela") == table).first()
    own = {"comment": r["descricao"], "catalogo.nome": catalog.NAME, "catalogo.dono": catalog.OWNER,
           "catalogo.grao": r["grao"], "catalogo.atualizacao": r["atualizacao"], "catalogo.pergunta": r["pergunta"]}
    return {k: v for k, v in own.items() if v}


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(spark: SparkSession, name: str, path: str, comments: dict[str, str], properties: dict[str, str],
             partition: str = "ano") -> None:
    """Catalog table ``name`` over the files at ``path``, with column comments (the partition
    column's too) and properties. The catalog holds names only; the files stay as they are."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                     + (f" COMMENT {_literal(comments[f.name])}" if f.name in comments else "") for f in df.schema.fields)
    props = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in properties.items() if k != "comment")
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet PARTITIONED BY (`{partition}`) LOCATION {_literal(path)}"
              + (f" COMMENT {_literal(properties['comment'])}" if "comment" in properties else "")
              + (f" TBLPROPERTIES ({props})" if props else ""))
    spark.sql(f"MSCK REPAIR TABLE {name}")


def stored_comments(spark: SparkSession, name: str, table: str) -> DataFrame:
    """(tabela, coluna, comentario, preenchidas) of a catalog table: comments read back from
    the catalog, filled values counted over its rows (one scan)."""
    df = spark.table(name)
    one = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    rows = F.explode(F.array(*[F.struct(F.lit(f.name).alias("coluna"),
                                        F.lit(f.metadata.get("comment")).cast("string").alias("comentario"),
                                        F.col(f"`{f.name}`").alias("preenchidas")) for f in df.schema.fields]))
    return one.select(rows.alias("r")).select(F.lit(table).alias("tabela"), "r.*")


def stored_properties(spark: SparkSession, name: str, table: str) -> DataFrame:
    """(tabela, chave, valor, linhas) of a catalog table's own properties, with its row count."""
    said = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    comment = spark.catalog.getTable(name).description
    own = {k: v for k, v in said.items() if k.startswith("catalogo.")} | ({"comment": comment} if comment else {})
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("chave"), F.lit(v).alias("valor")) for k, v in sorted(own.items())]))
    return spark.table(name).agg(F.count(F.lit(1)).alias("linhas")) \
        .select(F.lit(table).alias("tabela"), rows.alias("r"), "linhas").select("tabela", "r.*", "linhas")
