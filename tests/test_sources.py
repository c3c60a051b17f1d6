from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from issuerlake import schemas
from issuerlake.operators.merges import consolidate_history, consolidate_price_rows
from issuerlake.operators.quality import missing_columns
from issuerlake.operators.tables import append_version, write_manifest
from issuerlake.operators.windows import latest_per
from issuerlake.plans import batch
from issuerlake.sources import dossier, files, market, seeds, statements
from issuerlake.streaming.ingest import ingest_available, upserting


def put(root, name, text, encoding="utf-8"):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return path


def test_seeds(spark, tmp_path):
    put(tmp_path, "e.csv", "ticker,cnpj_emissor,tipo,obervacao\nT1,11,deb,\nT2,,deb,Fechada\n,12,deb,\nT3,nan,deb,\n")
    df = seeds.read_seed(spark, str(tmp_path / "e.csv"), seeds.EMISSIONS, ["ticker", "cnpj_emissor"])
    assert [(r.ticker, r.observacao) for r in df.collect()] == [("T1", None)]
    put(tmp_path, "o.json", '{"11.111.111/1111-11": "9", "22": "8"}')
    assert {(r.cnpj, r.cod_cvm) for r in seeds.read_overrides(spark, str(tmp_path / "o.json")).collect()} == {("11111111111111", "9"), ("22", "8")}


def test_registry_is_latin_and_keeps_its_order(spark, tmp_path):
    put(tmp_path, "cad.csv", "CNPJ_CIA;DENOM;CD_CVM;CATEG_REG;SIT;SIT_REG\n1;Cia;10;A;FASE PRÉ-OPERACIONAL;ATIVO\n1;Cia;11;A;X;ATIVO\n", "latin-1")
    got = seeds.read_registry(spark, str(tmp_path / "cad.csv")).orderBy("file_order").collect()
    assert [(r.CD_CVM, r.SIT) for r in got] == [("10", "FASE PRÉ-OPERACIONAL"), ("11", "X")]


HEAD = "CNPJ_CIA;DT_REFER;CD_CVM;ORDEM_EXERC;{}CD_CONTA;DS_CONTA;VL_CONTA\n"


def statement_tree(root):
    bpa, dre = HEAD.format(""), HEAD.format("DT_INI_EXERC;")
    put(root, "dfp_cia_aberta_BPA_con_2024.csv", bpa + "1;2024-12-31;00123;ÚLTIMO;1;Ativo é;1.000,5\n1;2024-12-31;123;PENÚLTIMO;1;x;7\n1;2024-12-31;999;ÚLTIMO;1;x;7\n", "latin-1")
    put(root, "dfp_cia_aberta_BPA_ind_2024.csv", bpa + "1;2024-12-31;00123;ÚLTIMO;1;individual;3\n", "latin-1")
    put(root, "dfp_cia_aberta_BPP_ind_2024.csv", bpa + "1;2024-12-31;00123;ÚLTIMO;2;Passivo;1.000,5\n", "latin-1")
    put(root, "itr/itr_cia_aberta_DRE_con_2024.csv", dre + "1;2024-12-31;123;ÚLTIMO;2024-01-01;3.01;Receita;5\n", "latin-1")
    put(root, "leia.csv", "x\n")


def test_statement_files_prefer_consolidated(spark, tmp_path):
    statement_tree(tmp_path)
    got = statements.read_statements(spark, str(tmp_path)).collect()
    seen = {(r.doc_type, r.table, r.scope, r.year, r.CD_CVM, r.DS_CONTA) for r in got}
    assert ("DFP", "BPA", "con", 2024, "00123", "Ativo é") in seen and ("DFP", "BPP", "ind", 2024, "00123", "Passivo") in seen
    assert not any(s[5] == "individual" for s in seen) and len(got) == 5


def test_all_tables_are_one_scan(spark, tmp_path):
    statement_tree(tmp_path)
    rows = statements.read_statements(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2 and "Union" not in plan  # lines, and the side table of header lines
    put(tmp_path, "dfp_cia_aberta_DVA_con_2024.csv", "1;2024-12-31;00123;ÚLTIMO;7;x;1\n", "latin-1")
    with pytest.raises(Exception, match="no header line"):
        statements.read_statements(spark, str(tmp_path)).collect()


def test_landed_statements(spark, tmp_path):
    put(tmp_path, "dfp/2023/filtrado/BPA_con.csv", "CD_CVM,DT_REFER,ORDEM_EXERC,CD_CONTA,DS_CONTA,VL_CONTA\n1,2023-12-31,ÚLTIMO,1,Ativo,\"10,5\"\n")
    row = statements.read_statements(spark, str(tmp_path), landed=True).collect()[0]
    assert (row.doc_type, row.table, row.year, row.VL_CONTA) == ("DFP", "BPA", 2023, "10,5")


def test_dossiers_end_to_end(spark, tmp_path):
    statement_tree(tmp_path / "in")
    issuers = spark.createDataFrame([("11.111", "123"), ("2", "")], "cnpj string, cod_cvm string")
    manual = spark.createDataFrame([("22", "2023-12-31", "DFP", "BPA", "1", "Ativo", 5.0)], ", ".join(f"{c} {'double' if c == 'valor' else 'string'}" for c in batch.STATEMENT_COLUMNS))
    checks = batch.build_dossiers(spark, str(tmp_path / "in"), issuers, str(tmp_path / "out"), manual)
    assert tuple(checks.collect()[0]) == (2, 0, 1)
    again = dossier.read_written_dossier(spark, str(tmp_path / "out"))
    assert {(r.cnpj, r.data_ref, r.tipo) for r in again.collect()} == {("11111", "2024-12-31", "ITR"), ("22", "2023-12-31", "DFP")}
    assert (tmp_path / "out" / "cnpj=11111").is_dir()


def test_nested_dossier_files(spark, tmp_path):
    doc = {"cnpj": "11", "cod_cvm": "1", "nome": "N", "periodos": {"2024-12-31": {"tipo": "DFP", "demonstracoes": {"BPA": {"1": {"cd_conta": "1", "ds_conta": "A", "valor": 1.5}}}}}}
    put(tmp_path, "11/11.json", json.dumps(doc))
    put(tmp_path, "11/outro.json", json.dumps(doc))
    put(tmp_path, "22/dados_financeiros.json", json.dumps(doc))
    got = dossier.read_dossier(spark, str(tmp_path)).collect()
    assert [(r.cnpj, r.nome, list(r.periodos)) for r in got] == [("11", "N", ["2024-12-31"])]
    assert [r.cnpj for r in dossier.read_manual(spark, str(tmp_path)).collect()] == ["22"]


CHARACTERISTICS = {
    "isin": "BR1", "numero_serie": 2, "data_vencimento": "2030-01-01", "remuneracao": "IPCA + 5,5%", "taxa_emissao": "7,1", "lei": "12.431",
    "indexador": None,
    "emissao": {
        "numero_emissao": "3", "data_emissao": "2020-01-01", "volume": "1000,5", "quantidade_emitida": 10, "garantia": "Real",
        "banco_mandatario": "B", "emissor": {"nome": "Cia", "cnpj": "11.111.111/1111-11"},
        "coordenador_lider": {"nome": "", "razao_social": "Banco X"}, "agente_fiduciario": None,
    },
}


def test_market_payloads(spark, tmp_path):
    put(tmp_path, "T1/caracteristicas.json", json.dumps(CHARACTERISTICS, indent=1))
    put(tmp_path, "t2/caracteristicas.json", json.dumps({**CHARACTERISTICS, "indexador": {"nome": "CDI"}, "lei": "", "taxa_emissao": "1.234,5"}))
    put(tmp_path, "T3/caracteristicas.json", json.dumps({"indexador": "IGPM", "remuneracao": None}))
    put(tmp_path, "T1/agenda.json", json.dumps({"content": [{"data_evento": "2024-01-01", "evento": "J", "taxa": "1,5", "status": {"status": "Previsto", "grupo_status": "G"}}, {"evento": "x"}]}))
    put(tmp_path, "t2/agenda.json", json.dumps([{"data_evento": "2024-02-01", "evento": "A", "valor": 3.5, "status": "Liquidado"}]))
    put(tmp_path, "T1/grafico_pu.json", json.dumps({"pus": [{"data": "2024-01-01", "valor_pu_historico": 10.5}]}))
    put(tmp_path, "T1/pu_historico.json", json.dumps({"content": [{"data_referencia": "2024-01-02", "pu_par": "11,5", "prazo_remanescente": 30}]}))
    put(tmp_path, "T1/precos.json", json.dumps({"precos": [{"data_referencia": "2024-01-01", "taxa_indicativa": 5}], "pu_historico": {"data_referencia": "2024-01-03", "vna": 2}}))

    tables = batch.market_tables(spark, str(tmp_path))
    chars = {r.ticker_deb: r for r in tables["deb_caracteristicas"].collect()}
    t1 = chars["T1"]
    assert (t1.cnpj, t1.indexador, t1.taxa_prefixada, t1.volume_emissao, t1.quantidade_debentures) == ("11111111111111", "IPCA", 5.5, 1000.5, 10)
    assert (t1.valor_unitario_emissao, t1.prazo_anos, t1.lei_incentivo, t1.banco_coordenador, t1.agente_fiduciario) == (100.05, 10.0, "Sim", "Banco X", None)
    assert (chars["T2"].indexador, chars["T2"].taxa_prefixada, chars["T2"].lei_incentivo) == ("CDI", None, "Não")
    assert (chars["T3"].indexador, chars["T3"].cnpj) == ("IGPM", None)
    events = {(r.ticker_deb, r.evento, r.taxa, r.valor, r.status, r.grupo_status) for r in tables["deb_agenda"].collect()}
    assert events == {("T1", "J", 1.5, None, "Previsto", "G"), ("T2", "A", None, 3.5, "Liquidado", None)}
    days = {str(r.data_referencia): (r.pu_par, r.vna, r.taxa_indicativa, r.prazo_remanescente) for r in tables["deb_historico_diario"].collect()}
    assert days == {"2024-01-01": (10.5, None, 5.0, None), "2024-01-02": (11.5, None, None, 30), "2024-01-03": (None, 2.0, None, None)}
    assert consolidate_history(**market.read_prices(spark, str(tmp_path))).count() == 3
    batch.compact_payloads(spark, str(tmp_path), str(tmp_path / "history"))
    assert spark.read.parquet(str(tmp_path / "history")).where("ticker_deb = 'T1'").count() == 3


def test_consolidated_history_files(spark, tmp_path):
    row = {"data_referencia": "2024-01-01", "pu_par": "1,5", "prazo_remanescente": "7.9", "reune": "x"}
    put(tmp_path, "a1/historico_diario.json", json.dumps([row, {"pu_par": 1}]))
    put(tmp_path, "B2/historico_diario.json", json.dumps({"dados": [row]}))
    got = market.clean_history(market.read_history(spark, str(tmp_path)))
    assert {(r.ticker_deb, r.pu_par, r.prazo_remanescente, r.reune) for r in got.collect()} == {("A1", 1.5, 7, "x"), ("B2", 1.5, 7, "x")}
    known = set(schemas.TABLES["deb_historico_diario"].names)
    assert set(got.columns) <= known and missing_columns(got, ["pu_par", "nada"]).collect()[0].column == "nada"


def test_documents(spark, tmp_path):
    put(tmp_path, "b/DFP 2024.pdf", "%PDF-1 x")
    put(tmp_path, "a/ata.pdf", "%PDF-1 x")
    put(tmp_path, "a/vazio.pdf", "")
    put(tmp_path, "a/falso.pdf", "<html>")
    put(tmp_path, "a/x.txt", "x")
    docs = files.list_documents(spark, str(tmp_path), ordered=True)
    got = docs.collect()
    assert [r.nome_arquivo for r in got] == ["ata.pdf", "falso.pdf", "DFP 2024.pdf"]
    assert got[0].hash_md5 == got[2].hash_md5 and got[0].size == 8
    assert [r.nome_arquivo for r in files.select_documents(docs, ["dfp", "ATA"], 1).collect()] == ["ata.pdf"]
    uploads = docs.select("nome_arquivo", "size", "content").union(spark.createDataFrame([("", 0, bytearray())], "n string, s long, c binary"))
    reasons = {r.nome_arquivo: r.reject_reason for r in files.intake(uploads).collect()}
    assert reasons == {"ata.pdf": None, "DFP 2024.pdf": None, "sem_nome.pdf": "empty", "falso.pdf": "not_pdf"}
    assert files.accept_files(uploads).count() == 3 and files.accept_files(uploads, pdf_only=True).count() == 2
    assert files.list_files(spark, str(tmp_path)).count() == 4


def test_stream_reads_each_file_once_and_upserts(spark, tmp_path):
    schema = "ticker_deb string, data_referencia string, pu_par double"
    from pyspark.sql.types import StructType

    kinds = StructType.fromDDL(schema)
    table, landing, mark = str(tmp_path / "table"), tmp_path / "landing", str(tmp_path / "ckpt")

    def run():
        sink = upserting(table, ["ticker_deb", "data_referencia"], ["ticker_deb"])
        ingest_available(spark, str(landing), kinds, sink, mark)
        return {(r.ticker_deb, r.data_referencia, r.pu_par) for r in spark.read.parquet(table).collect()}

    put(landing, "1.json", '{"ticker_deb":"T","data_referencia":"d1","pu_par":1.0}\n{"ticker_deb":"U","data_referencia":"d1","pu_par":1.0}')
    first = run()
    assert first == {("T", "d1", 1.0), ("U", "d1", 1.0)} and run() == first
    time.sleep(0.01)
    put(landing, "2.json", '{"ticker_deb":"T","data_referencia":"d1","pu_par":0.5}\n{"ticker_deb":"T","data_referencia":"d2","pu_par":2.0}')
    assert run() == {("T", "d1", 0.5), ("T", "d2", 2.0), ("U", "d1", 1.0)}
    assert spark.read.parquet(table).where(F.col("ticker_deb") == "U").count() == 1


def test_versions_are_appended_and_manifests_written(spark, tmp_path):
    versions = spark.createDataFrame([("c", "v1", 1)], "cnpj string, analise_markdown string, criado_em int")
    append_version(versions, str(tmp_path / "v"))
    append_version(versions.withColumn("analise_markdown", F.lit("v2")).withColumn("criado_em", F.lit(2)), str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    assert stored.count() == 2
    assert latest_per(stored, ["cnpj"], [F.desc("criado_em")]).collect()[0].analise_markdown == "v2"
    links = spark.createDataFrame([("http://h/a.pdf", None, "ok")], "url string, year int, status string")
    write_manifest(links, str(tmp_path / "m"))
    assert [tuple(r) for r in spark.read.schema(links.schema).json(str(tmp_path / "m")).collect()] == [("http://h/a.pdf", None, "ok")]


def test_price_files_are_read_once(spark, tmp_path):
    put(tmp_path, "T1/precos.json", json.dumps({"precos": [{"data_referencia": "2024-01-01", "taxa_indicativa": 5}, {"data_referencia": None}], "pu_historico": {"data_referencia": "2024-01-03", "vna": 2}, "pus": [{"data": "2024-01-09"}]}))
    put(tmp_path, "T2/pu_historico.json", json.dumps({"content": [{"data_referencia": "2024-01-02", "pu_par": "11,5"}, {"data_referencia": "2024-01-02", "pu_par": 12}], "precos": [{"data_referencia": "2024-01-08"}]}))
    put(tmp_path, "T2/grafico_pu.json", "no json")
    rows = market.read_price_rows(spark, str(tmp_path))
    assert sorted((r.ticker_deb, r.kind, r.seq) for r in rows.collect()) == [("T1", "last", 0), ("T1", "prices", 0), ("T1", "prices", 1), ("T2", "curve", 0), ("T2", "curve", 1)]
    days = consolidate_price_rows(rows)
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Generate") == 1
    assert sorted((r.ticker_deb, r.data_referencia, r.pu_par, r.vna, r.taxa_indicativa) for r in days.collect()) == [("T1", "2024-01-01", None, None, 5.0), ("T1", "2024-01-03", None, 2.0, None), ("T2", "2024-01-02", 11.5, None, None)]
