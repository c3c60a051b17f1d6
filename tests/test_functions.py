from __future__ import annotations

import math

from pyspark.sql import functions as F

from issuerlake.functions import cleaning as C
from issuerlake.functions import display as D
from issuerlake.functions import jobs as J
from issuerlake.functions import naming as N
from issuerlake.functions import text as S


def test_keys_and_codes(values):
    assert values(C.digits, ["12.345.678/0001-90", None, "x"]) == ["12345678000190", "", ""]
    assert values(lambda c: C.digits(c, pad=5), ["12", "1234567"]) == ["00012", "1234567"]
    assert values(lambda c: C.digits(c, cut=3), ["12345"]) == ["123"]
    assert values(C.norm_code, [" 00123 ", "000", "0", "A01", "", " 1x"]) == ["123", "0", "0", "A01", "", "1x"]
    assert values(C.account_level, ["1", " 1.01 ", "3.01.02.99"]) == [1, 2, 4]
    assert values(C.blank_to_null, ["  ", " a ", None]) == [None, "a", None]
    assert values(C.upper_key, [" petr26\n"]) == ["PETR26"]


def test_numbers(values):
    assert values(C.parse_money, ["1.234,56", "123.45", "-10", "", "n/d", None, "1d", "0x1p3"]) == [
        1234.56, 12345.0, -10.0, None, None, None, None, None
    ]
    assert values(lambda c: C.parse_money(c, "dot"), ["123.45"]) == [123.45]
    assert values(C.parse_decimal, ["12,5", "1.234,56", " 7 ", "1e3"]) == [12.5, None, 7.0, 1000.0]
    assert math.isinf(values(C.parse_decimal, ["inf"])[0]) and math.isnan(values(C.parse_decimal, ["NaN"])[0])
    assert values(C.parse_int, ["12.9", "-12.9", "x", "inf", ""]) == [12, -12, None, None, None]
    assert values(C.date10, ["2024-01-02T10:00", "", None]) == ["2024-01-02", None, None]


def test_remuneration(spark):
    df = spark.createDataFrame(
        [("ipca + 5,5%", None), ("100% do CDI", ""), ("IPCA + 5%", "IGPM"), ("livre", None), ("Selic+1.5%", "None")], "t string, i string"
    )
    got = [(r.x.indexer, r.x.rate) for r in df.select(C.parse_remuneration("t", "i").alias("x")).collect()]
    assert got == [("IPCA", 5.5), ("CDI", 100.0), ("IGPM", None), (None, None), ("SELIC", 1.5)]


def test_derived_amounts(value):
    assert value(C.unit_price(F.lit(1000.0), F.lit(4))) == 250.0
    assert value(C.unit_price(F.lit(0.0), F.lit(4))) is None
    assert value(C.unit_price(F.lit(10.0), F.lit(0))) is None
    assert value(C.tenor_years(F.lit("2020-01-01").cast("date"), F.lit("2030-01-01").cast("date"))) == 10.0


def test_display(values):
    assert values(D.format_cnpj, ["12345678000190", "123", "", None]) == ["12.345.678/0001-90", "123", "—", "—"]
    assert values(D.mask_cnpj, ["12", "123", "123456", "123456789", "1234567890123"]) == [
        "12", "12.3", "12.345.6", "12.345.678/9", "12.345.678/9012-3"
    ]
    assert values(D.fmt_number, ["1234.5", "x", None, "inf"]) == ["1.234,5", "—", "—", "—"]
    assert values(D.fmt_currency, ["1234567.8", "-5"]) == ["R$ 1.234.568", "-R$ 5"]
    assert values(D.fmt_percent, ["12.345", "10"]) == ["12,35%", "10%"]
    assert values(D.fmt_date, ["2024-03-01", "ontem"]) == ["01/03/2024", "—"]
    assert values(D.fmt_datetime, ["2024-03-01T14:05:00Z"]) == ["01/03/2024, 14:05"]
    assert values(D.bool_label, ["SIM", "0", "", "talvez", None]) == ["Sim", "Não", "—", "talvez", "—"]
    assert values(D.label, ["cvm_pulado", "ia_quant docs", "PENDENTE", " "]) == ["CVM pulado", "IA quant docs", "Pendente", "—"]
    assert values(D.title_label, ["dias_historico"]) == ["Dias Historico"]
    assert values(D.fold, [" Ação É "]) == ["acao e"]
    assert values(D.norm_identifier, ["petr26", "12.345.678/0001-90", "-", " "]) == ["PETR26", "12345678000190", "-", ""]
    assert values(D.direct_identifier, ["12.345.678/0001-90", "petr26", "duas palavras", ""]) == ["12345678000190", "PETR26", "", ""]


def test_stage_label(spark):
    df = spark.createDataFrame([("cvm", "rodando"), ("cvm", "ERRO "), ("outra_coisa", None), (None, "rodando")], "e string, s string")
    assert [r.x for r in df.select(D.stage_label("e", "s").alias("x")).collect()] == ["Acessando DFs na CVM", "Falhou", "Outra coisa", "—"]


def test_names_and_urls(values, value):
    assert values(N.safe_name, ['a<b>x</b>: "y"', "<i></i>", "x" * 130]) == ["ax y", "arquivo", "x" * 100]
    assert values(lambda c: N.safe_name(c, "file"), ["Relatório 1.pdf"]) == ["Relat_rio_1.pdf"]
    assert values(N.url_slug, ["https://ri.x.com/a/b-c/", "https://ri.vtal.com/", "https://www.h.com", ""]) == ["b-c", "vtal", "h", "principal"]
    assert values(N.slug_label, ["central-de-resultados-igua-rio", "central-de-resultados", "3t25-dados"]) == ["Igua Rio", "Central De Resultados", "3T25 Dados"]
    assert values(N.url_ext, ["http://h/a/B.PDF?x=1", "http://h/a", "http://h/.pdf", "http://h/a.b.zip/"]) == [".pdf", "", "", ".zip"]
    assert values(N.year_from, ["dfp 2023 e 2024", "1999"]) == [2023, None]
    assert values(N.is_file_url, ["http://h/a.xlsx", "http://h/MZFileManager/1", "http://h/a"]) == [True, True, False]
    name = value(N.doc_name(F.lit("DFP"), F.lit(2024), F.lit("Dem. Fin"), F.lit("http://h/x.pdf")))
    assert name.startswith("DFP_2024_Dem._Fin_") and name.endswith(".pdf") and len(name) == len("DFP_2024_Dem._Fin_12345678.pdf")
    assert value(N.clean_title(F.lit(' "# DFP  2024" \nresto'), F.lit("a.pdf"))) == "DFP 2024"
    assert value(N.clean_title(F.lit(" "), F.lit("x/relatorio.v2.pdf"))) == "relatorio.v2"


def test_line_rules(values):
    assert values(S.mostly_punct, ["....a", "ab..", " ", "é!!"]) == [True, False, False, True]
    assert values(S.strip_runs, ["Receita ........ 12", "x --------", "a - b "]) == ["Receita", "x", "a - b"]
    assert values(S.is_noise, ["- - - - -", "", "%" * 201, "%" * 200, "a ........ b"]) == [True, False, True, False, True]
    assert values(S.is_financial_name, ["DFP 2024.pdf", "Escritura DFP.pdf", "qualquer.pdf"]) == [True, False, True]
    assert values(S.split_lines, ["a\r\nb\rc d", "a\nb"]) == [["a", "b", "c", "d"], ["a", "b"]]
    assert values(S.token_estimate, ["abcdefghi"]) == [2]


def test_document_type_and_year(spark):
    df = spark.createDataFrame(
        [("Balanço Patrimonial", "/x"), ("Informe 1T2022", "/x"), ("nada", "/release-2019.pdf"), ("", "/2024/itr")], "t string, u string"
    )
    got = [(r.k, r.y) for r in df.select(S.document_type("t", "u").alias("k"), S.document_year("t", "u").alias("y")).collect()]
    # "balanco" also holds the short mark of administration reports, but statements are asked first.
    assert got == [("DFP", "ano_desconhecido"), ("ITR", "2022"), ("release", "ano_desconhecido"), ("ITR", "2024")]


def _states(spark, status, stage, target, done):
    df = spark.createDataFrame([(status, stage, target, done)], "s string, e string, a string, d array<string>")
    return {x.key: x.state for x in df.select(J.stage_states("s", "e", "a", "d").alias("x")).collect()[0].x}


def test_job_stages(spark):
    assert _states(spark, "rodando", "cvm", "PETR26", ["identidade"]) == {"identidade": "concluida", "cvm": "atual", "mercado": "pendente"}
    assert _states(spark, "rodando", "mercado", "PETR26", ["CVM_PULADO"])["cvm"] == "pulada"
    assert _states(spark, "erro", "cvm", "PETR26", None) == {"identidade": "concluida", "cvm": "falhou", "mercado": "pendente"}
    assert _states(spark, "concluido_com_erros", "finalizado", "x", [])["ia_qual"] == "concluida"
    assert list(_states(spark, "rodando", None, "12345678000190", None).items())[0] == ("validacao_emissor", "atual")


def test_job_display(spark):
    df = spark.createDataFrame([("12345678000190", "Iguá "), ("petr26", "x"), ("", None)], "a string, n string")
    got = [(r.x.primary, r.x.secondary) for r in df.select(J.job_target("a", "n").alias("x")).collect()]
    assert got == [("Iguá", "12.345.678/0001-90"), ("petr26", None), ("—", None)]
    progress = {"erros": "[]", "nome_emissor": "X", "periodos_cvm": "3", "cnpj": "12345678000190", "dias": "4"}
    one = spark.createDataFrame([(progress,)], "p map<string,string>")
    shown = one.select(J.progress_entries("p").alias("x")).collect()[0].x
    assert {e.key: e.value for e in shown} == {"nome_emissor": "X", "cnpj": "12.345.678/0001-90", "dias": "4"}


def test_noise_lines_with_outer_white_space(values):
    """Rules are judged on the stripped line, whatever white space surrounds it."""
    from issuerlake.functions import text as S

    lines = ["--------", "\u00a0 -------- \t", " -------", "-      -", " -      - ", "- - \t- - - -", "\\\\\\\\\\\\\\\\", "^^^^^^^^", "[[[[[[[[", "_._._._._\u3000", "x" * 300, " " * 300, "  " + "%" * 201, "%" * 200, "a........b", "9999999999", "{{{{{{{{{"]
    assert values(S.is_noise, lines) == [True, True, False, True, True, False, False, False, False, True, False, False, True, False, True, False, False]
    assert values(lambda c: S.strip_runs(c), ["a ........ b", "a -------- ........ b", "a ........ --------", "........", "x\u00a0--------", "y .......\t"]) == ["a", "a", "a", "", "x", "y ......."]
    assert values(lambda c: S.is_markdown_noise(c, c), ["|----------", " |--------------------x", "x|--------------------", "| a |", "\\|--------------------", "|  :  |  :  |\u2003", "\\x--------------------"]) == [True, True, False, False, False, True, False]
