"""Golden values of the typed-column rules."""
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from microlake.functions import clean, names


def test_normalize_name():
    assert names.normalize_name("Vl Remun Média (SM)") == "vl_remun_media_sm"
    assert names.normalize_name("Vínculo Ativo 31/12") == "vinculo_ativo_31_12"
    assert names.normalize_name("  Município - Código ") == "municipio_codigo"


def test_normalize_columns_collision(spark):
    df = spark.createDataFrame([("1", "2")], ["A b", "a_b"])
    with pytest.raises(ValueError):
        names.normalize_columns(df)


def test_normalize_expr_matches_python(spark):
    heads = ["Vl Remun Média (SM)", "Vínculo Ativo 31/12", "Município - Código", "Raça Cor",
             "Escolaridade após 2005", "Mês Desligamento"]
    df = spark.createDataFrame([(h,) for h in heads], "h string")
    got = [r[0] for r in df.select(names.normalize_name_expr(F.col("h"))).collect()]
    assert got == [names.normalize_name(h) for h in heads]


def test_canonicalize_keeps_existing(spark):
    df = spark.createDataFrame([("1", "2", "3")], ["municipio_codigo", "municipio", "sexo_codigo"])
    out = names.canonicalize(df)
    assert out.columns == ["municipio_codigo", "municipio", "sexo_trabalhador"]


def _col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_decimal_local_format(spark):
    out = _col(spark, ["1234,56", "1.234,56", "{ñ class}", None], clean.decimal_of)
    assert out == [Decimal("1234.56"), Decimal("1234.56"), None, None]


def test_decimal_dot_format(spark):
    out = _col(spark, ["7771.49", " 5.88", "11.0", "1,2,3", "1e3"], clean.decimal_of)
    assert out == [Decimal("7771.49"), Decimal("5.88"), Decimal("11.00"), None, Decimal("1000.00")]


def test_pay_empty_is_zero_invalid_is_null(spark):
    out = _col(spark, ["0000000000,00", None, "", "{ñ class}", "7771.49"], clean.pay_of)
    assert out == [Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), None, Decimal("7771.49")]


def test_absent_columns_are_typed_nulls(spark):
    df = spark.createDataFrame([("1",)], ["x"])
    row = df.select(clean.safe_int(df, "nao_existe").alias("i"),
                    clean.safe_decimal(df, "nao_existe").alias("d"),
                    clean.pay_amount(df, "nao_existe").alias("p"),
                    clean.optional_text(df, "nao_existe").alias("t")).first()
    assert row == (None, None, None, None)
    assert dict(df.select(clean.pay_amount(df, "nao_existe").alias("p")).dtypes)["p"] == "decimal(18,2)"


def test_int_rules(spark):
    assert _col(spark, ["02", "", "1.5", " 7 ", "x"], clean.int_of) == [2, None, None, 7, None]


def test_flag(spark):
    assert _col(spark, ["1", "0", "01", None, " 1 "], clean.flag_of) == [True, False, False, None, True]


def test_dates_malformed_is_null(spark):
    out = _col(spark, ["2021-03-01", "2021-13-01", "nada"], clean.date_of)
    assert str(out[0]) == "2021-03-01" and out[1] is None and out[2] is None


def test_region_from_code(spark):
    assert _col(spark, ["26", "35", "99", None], clean.region_of) == ["Nordeste", "Sudeste", None, None]


def test_local_number(spark):
    df = spark.createDataFrame([(1234567.891,)], "x double")
    assert df.select(clean.local_number(F.col("x"))).first()[0] == "1.234.567,89"
    assert df.select(clean.decimal_comma(F.col("x"))).first()[0] == "1234567,89"


def test_bands(spark):
    df = spark.createDataFrame([(2999.99,), (3000.0,), (4499.0,), (4500.0,), (None,)], "s double")
    assert [r[0] for r in df.select(clean.pay_band(F.col("s"))).collect()] == \
        ["baixa", "media", "media", "alta", None]
    ages = spark.createDataFrame([(24,), (25,), (39,), (40,), (60,)], "a int")
    assert [r[0] for r in ages.select(clean.age_band(F.col("a"))).collect()] == \
        ["ate_24", "25_39", "25_39", "40_59", "60_mais"]


def test_shuffle_partition_rule():
    from microlake.session import shuffle_partitions_for
    assert shuffle_partitions_for(6 * 1024 ** 3, 4) == 48
    assert shuffle_partitions_for(10, 8) == 16
    assert shuffle_partitions_for(100 * 1024 ** 4, 4000) == 820000
