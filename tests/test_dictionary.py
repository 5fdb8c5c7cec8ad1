"""Dictionary rules and conformance messages on small frames."""
from microlake.operators import dictionary


def _frames(spark):
    tables = spark.createDataFrame(
        [("gold.a", "Tabela a de teste.", "ano", "anual", True, "gold/p", None),
         ("gold.b", "Tabela b de teste.", "ano", "anual", False, "gold/p", None),
         ("gold.ausente", "Não existe no lake.", "ano", "anual", True, "gold/p", None),
         ("Gold.Ruim", "curta", "", "anual", True, "gold/p", None)],
        "tabela string, descricao string, grao string, atualizacao string, completa boolean, caminho string, pergunta string")
    columns = spark.createDataFrame(
        [("gold.a", "x", "Coluna x.", "R$"), ("gold.a", "fantasma", "Não existe.", None),
         ("gold.b", "y", "Coluna y.", None), ("gold.a", "Mal", "abc", None)],
        "tabela string, coluna string, descricao string, unidade string")
    real_a = spark.createDataFrame([(1.0, 2)], "x double, z int")
    real_b = spark.createDataFrame([(1, 2)], "y int, w int")
    actual = dictionary.actual_columns({"gold.a": real_a, "gold.b": real_b})
    return tables, columns, actual


def test_conformance_messages(spark):
    tables, columns, actual = _frames(spark)
    got = {(r["tabela"], r["coluna"], r["problema"])
           for r in dictionary.conformance(tables, columns, actual).collect()}
    assert got == {
        ("gold.ausente", None, "tabela_nao_encontrada"),
        ("Gold.Ruim", None, "tabela_nao_encontrada"),
        ("gold.a", "fantasma", "coluna_descrita_inexistente"),
        ("gold.a", "Mal", "coluna_descrita_inexistente"),
        ("gold.a", "z", "coluna_sem_descricao"),          # complete table: must be described
    }                                                      # gold.b is not complete: w is fine


def test_naming_rules(spark):
    tables, columns, _ = _frames(spark)
    got = {(r["tabela"], r["coluna"], r["regra"]) for r in dictionary.violations(tables, columns).collect()}
    assert ("Gold.Ruim", None, "nome_tabela_invalido") in got
    assert ("Gold.Ruim", None, "descricao_tabela_curta") in got
    assert ("Gold.Ruim", None, "grao_ausente") in got
    assert ("gold.a", "Mal", "nome_coluna_invalido") in got
    assert ("gold.a", "Mal", "descricao_coluna_curta") in got
    assert not any(t == "gold.a" and c == "x" for t, c, _ in got)


def test_export_search_and_comments(spark):
    import json
    tables, columns, actual = _frames(spark)
    doc = {r["tabela"]: json.loads(r["json"]) for r in dictionary.export_json(tables, columns, actual).collect()}
    assert doc["gold.a"]["colunas"][0]["coluna"] == "x" and doc["gold.a"]["colunas"][0]["tipo"] == "double"
    assert [r["coluna"] for r in dictionary.search_by_unit(columns, actual, "R$").collect()] == ["x"]
    assert doc["gold.a"]["caminho"] == "gold/p" and len(doc["gold.a"]["regras"]) >= 5


def test_catalog_keeps_comments_and_properties(spark, tmp_dir):
    from microlake.sinks import tables as sink
    entries, columns = dictionary.load(spark, [("gold.a", "Tabela d'água \\ de teste.", "ano", "anual", True, "gold/a", None)],
                                       [("gold.a", "x", "Coluna d'água.", "R$"), ("gold.a", "ano", "Ano base.", None)])
    sink.write_table(spark.createDataFrame([(1.0, 2, 2020), (None, 3, 2021)], "x double, z int, ano int"), tmp_dir + "/a")
    dictionary.register(spark, "dict_test_a", tmp_dir + "/a", dictionary.comments_for(columns, "gold.a"),
                        dictionary.properties_for(entries, "gold.a"))
    said = {r["coluna"]: (r["comentario"], r["preenchidas"]) for r in dictionary.stored_comments(spark, "dict_test_a", "gold.a").collect()}
    assert said == {"x": ("Coluna d'água. Unidade: R$.", 1), "z": (None, 2), "ano": ("Ano base.", 2)}
    props = {r["chave"]: (r["valor"], r["linhas"]) for r in dictionary.stored_properties(spark, "dict_test_a", "gold.a").collect()}
    assert props["comment"] == ("Tabela d'água \\ de teste.", 2) and props["catalogo.grao"] == ("ano", 2)
    assert "catalogo.pergunta" not in props
    spark.sql("DROP TABLE dict_test_a")


def test_the_shipped_dictionary_breaks_no_rule(spark):
    entries, columns = dictionary.load(spark)
    assert dictionary.violations(entries, columns).count() == 0
