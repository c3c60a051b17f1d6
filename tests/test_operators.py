from __future__ import annotations

from pyspark.sql import functions as F

from issuerlake.operators import aggregates as A
from issuerlake.operators import documents as D
from issuerlake.operators import filters as L
from issuerlake.operators import joins as J
from issuerlake.operators import merges as M
from issuerlake.operators import quality as Q
from issuerlake.operators import tables as T
from issuerlake.operators import windows as W
from issuerlake.operators.ordering import down, up
from issuerlake.plans import readmodels as R


def rows(df, *columns):
    out = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in out.collect()), key=repr)


# Statements ---------------------------------------------------------------

RAW = "CD_CVM string, doc_type string, year int, table string, DT_REFER string, CD_CONTA string, DS_CONTA string, VL_CONTA string, ORDEM_EXERC string, n int"


def raw(spark, *items):
    return spark.createDataFrame([(*x, i) for i, x in enumerate(items)], RAW)


def test_accounts_keep_the_last_row_of_the_current_period(spark):
    df = raw(
        spark,
        ("00123", "dfp", 2024, "BPA", "2024-12-31", "1", "Ativo", "10", "ÚLTIMO"),
        ("123", "dfp", 2024, "BPA", "2024-12-31", " 1 ", "Ativo", "1.234,5", ""),
        ("123", "dfp", 2024, "BPA", "2024-12-31", "1", "Ativo", "99", "PENÚLTIMO"),
        ("123", "dfp", 2024, "BPA", "2024-12-31", "1.01", "x", "n/d", None),
        ("123", "dfp", 2024, "BPA", "2024-12-31", "1.01.01.01", "x", "5", None),
    )
    for parts in (1, 5):
        got = rows(M.statement_accounts(df.repartition(parts), 3, ["n"]))
        assert got == [("123", "DFP", 2024, "BPA", "2024-12-31", "1", "Ativo", 1234.5)]


def _sources(spark):
    p = "2024-12-31"
    return raw(
        spark,
        ("1", "itr", 2024, "BPA", p, "1", "itr24", "1", None),
        ("1", "dfp", 2024, "BPA", p, "2", "dfp24", "2", None),
        ("1", "itr", 2023, "BPA", p, "3", "itr23", "3", None),
        ("1", "dfp", 2024, "DFC_MI", p, "6.01", "mi", "4", None),
        ("1", "dfp", 2024, "DFC_MD", p, "6.02", "md", "5", None),
        ("1", "dfp", 2023, "DFC_MD", p, "6.03", "old", "6", None),
        ("1", "dfp", 2023, "DRE", "2023-12-31", "3", "dre", "7", None),
    )


def test_consolidation_v2_replaces_whole_statements_and_keeps_the_first_cash_flow(spark):
    got = rows(M.consolidate_rows(_sources(spark), 2, 3, ["n"]), "data_ref", "tipo_doc", "demonstracao", "cd_conta")
    assert got == [
        ("2023-12-31", "DFP", "DRE", "3"), ("2024-12-31", "ITR", "BPA", "3"), ("2024-12-31", "ITR", "DFC", "6.02"),
    ]


def test_consolidation_v1_labels_with_the_last_source(spark):
    got = rows(M.consolidate_rows(_sources(spark), 1, 3, ["n"]), "data_ref", "tipo_doc", "demonstracao", "cd_conta")
    assert got == [
        ("2023-12-31", "DFP", "DRE", "3"), ("2024-12-31", "ITR", "BPA", "1"), ("2024-12-31", "ITR", "DFC", "6.03"),
    ]


LONG = "cnpj string, data_ref string, tipo_doc string, demonstracao string, cd_conta string, ds_conta string, valor double"


def test_fill_merge_changes_nothing_that_is_there(spark):
    base = spark.createDataFrame([("c", "p1", "", "BPA", "1", "a", 1.0), ("c", "p2", "DFP", "DRE", "3", "b", 2.0)], LONG)
    new = spark.createDataFrame([
        ("c", "p1", "ITR", "BPA", "1", "z", 9.0), ("c", "p1", "ITR", "BPA", "2", "n", 3.0),
        ("c", "p2", "ITR", "BPP", "2", "n", 4.0), ("c", "p3", "ITR", "BPA", "1", "n", 5.0),
    ], LONG)
    assert rows(M.merge_fill(base, new), "data_ref", "tipo_doc", "cd_conta", "valor") == [
        ("p1", "ITR", "1", 1.0), ("p1", "ITR", "2", 3.0), ("p2", "DFP", "2", 4.0), ("p2", "DFP", "3", 2.0), ("p3", "ITR", "1", 5.0)
    ]
    assert rows(M.merge_fill(base, new, "statement"), "data_ref", "cd_conta") == [("p1", "1"), ("p2", "2"), ("p2", "3"), ("p3", "1")]
    assert rows(M.new_period_count(base, new)) == [("c", 1)]
    assert rows(M.override_periods(base, new), "data_ref", "valor") == [("p1", 3.0), ("p1", 9.0), ("p2", 4.0), ("p3", 5.0)]
    once = M.merge_fill(base, new)
    assert rows(M.merge_fill(once, new)) == rows(once)


def test_nesting_round_trip(spark):
    df = spark.createDataFrame([
        ("c", "2024-12-31", "DFP", "BPA", "1", "Ativo", 123.45), ("c", "2024-12-31", "DFP", "DRE", "3.01", "Receita", 67.89),
        ("c", "2024-12-31", "ITR", "BPA", "1", "Ativo", 1.0), ("c", None, "ITR", "BPA", "1", "x", 1.0),
    ], LONG)
    nested = A.nest_statements(df)
    assert rows(A.unnest_statements(nested)) == [
        ("c", "2024-12-31", "ITR", "BPA", "1", "Ativo", 123.45), ("c", "2024-12-31", "ITR", "DRE", "3.01", "Receita", 67.89)
    ]
    assert rows(A.nest_statements(A.unnest_statements(nested))) == rows(nested)


def test_unnesting_falls_back_to_the_map_key(spark):
    account = "struct<cd_conta:string,ds_conta:string,valor:double>"
    schema = f"cnpj string, periodos map<string,struct<tipo:string,demonstracoes:map<string,map<string,{account}>>>>"
    df = spark.createDataFrame([("c", {"p": ("DFP", {"BPA": {"1": (None, "a", 1.0)}}), "q": ("", {"BPA": {"2": ("2", "b", 2.0)}})})], schema)
    assert rows(A.unnest_statements(df), "data_ref", "cd_conta") == [("p", "1")]
    assert rows(A.unnest_statements(df, "mark"), "data_ref", "tipo_doc", "cd_conta") == [("p", "DFP", "1"), ("q", "?", "2")]


def test_balance_gaps_and_totals(spark):
    cases = {"equal": (100.0, 100.0), "near": (1000.0, 1000.9), "far": (1000.0, 1002.0), "half": (5.0, None)}
    data = [(k, "p", "DFP", s, c, "", v) for k, (a, b) in cases.items() for s, c, v in (("BPA", "1", a), ("BPP", "2", b)) if v is not None]
    checked = Q.balance_check(spark.createDataFrame(data, LONG))
    assert dict(rows(checked, "cnpj", "balanced")) == {"equal": True, "near": True, "far": False, "half": None}
    assert ("far", "DIVERGE  Ativo=1,000  P+PL=1,002  Diff=2") in rows(checked, "cnpj", "message")
    assert rows(Q.validation_totals(checked)) == [(4, 1, 1)]
    years = spark.createDataFrame([("c", "2019-12-31"), ("c", "2022-03-31"), ("d", "2020-12-31")], "k string, d string")
    assert rows(Q.year_gaps(years, "k", "d"), "k", "gaps") == [("c", [2020, 2021]), ("d", [])]


# Market -------------------------------------------------------------------


def test_history_precedence(spark):
    chart = spark.createDataFrame([("T", 0, "d1", "10", None), ("T", 1, None, "9", "9")], "ticker_deb string, seq int, data string, valor_pu_historico string, valor_pu_indicativo string")
    curve_cols = "ticker_deb string, seq int, data_referencia string, pu_par string, vna string, juros string, prazo_remanescente string, flag_status string, data_ultima_atualizacao string"
    curve = spark.createDataFrame([("T", 0, "d1", "11", "1,5", None, "30.0", "F", "2024-01-02T00:00"), ("T", 1, "d2", "12", None, None, None, None, None)], curve_cols)
    names = ["data_referencia", "pu_indicativo", "data_ultima_atualizacao", *M.PRICE_NUMBERS, *M.PRICE_TEXTS]
    schema = "ticker_deb string, seq int, " + ", ".join(f"{n} string" for n in names)
    price = lambda d, pu, rate: ("T", 0, d, pu, "2024-02-02", rate, *[None] * (len(names) - 4))
    prices = spark.createDataFrame([price("d1", "77", "5,5"), price("d3", "78", "1.234,5")], schema)
    last = spark.createDataFrame([("T", 0, "d2", "99", "2", "3", "7")], "ticker_deb string, seq int, data_referencia string, pu_par string, vna string, juros string, prazo_remanescente string")
    got = rows(
        M.consolidate_history(chart, curve, prices, last), "data_referencia", "pu_par", "vna", "juros", "prazo_remanescente",
        "pu_indicativo", "taxa_indicativa", "flag_status", "data_ultima_atualizacao", "spread_indicativo",
    )
    assert got == [
        ("d1", 10.0, 1.5, None, 30, 77.0, 5.5, "F", "2024-01-02", None),
        ("d2", 12.0, 2.0, 3.0, 7, None, None, None, None, None),
        ("d3", None, None, None, None, 78.0, None, None, "2024-02-02", None),
    ]


def test_refresh_keeps_a_known_rate(spark):
    schema = "ticker_deb string, data_referencia string, pu_par double, taxa_indicativa double"
    old = spark.createDataFrame([("T", "d1", 1.0, 5.0), ("T", "d2", 1.0, 5.0)], schema)
    new = spark.createDataFrame([("T", "d1", None, None), ("T", "d3", 2.0, 6.0)], schema)
    assert rows(M.merge_history(old, new)) == [("T", "d1", None, 5.0), ("T", "d2", 1.0, 5.0), ("T", "d3", 2.0, 6.0)]
    assert ("T", "d1", None, None) in rows(M.merge_history(old, new, sticky=[]))


def test_registry_choice(spark):
    registry = spark.createDataFrame([
        ("11.111.111/1111-11", "1", "A", "CANCELADA", "CANCELADA", 0), ("11111111111111", "2", "A", "FASE OPERACIONAL", "", 1),
        ("22222222222222", "3", "B", "FASE PRÉ-OPERACIONAL", "INATIVO", 2), ("22222222222222", "4", "B", "", "ATIVO", 3),
        ("33333333333333", "5", "B", "CANCELADA", "", 4), ("33333333333333", "6", "B", "", "", 5),
    ], "CNPJ_CIA string, CD_CVM string, CATEG_REG string, SIT string, SIT_REG string, file_order int")
    ids = spark.createDataFrame([(c * 14,) for c in "123459"], "cnpj string")
    overrides = spark.createDataFrame([("4" * 14, "6"), ("5" * 14, "777")], "cnpj string, cod_cvm string")
    got = rows(J.resolve_registry(ids, registry, overrides), "cnpj", "CD_CVM", "CATEG_REG")
    assert got == [
        ("1" * 14, "2", "A"), ("2" * 14, "4", "B"), ("3" * 14, "5", "B"), ("4" * 14, "6", "B"), ("5" * 14, "777", "FORCED_OVERRIDE")
    ]
    assert ("2" * 14, "3") in rows(J.resolve_registry(ids, registry, compat=True), "cnpj", "CD_CVM")
    named = ids.select(F.lit("t").alias("ticker"), F.lit("n").alias("nome"), "cnpj")
    identity = dict(rows(M.build_identity(named, registry, overrides), "cnpj_emissor", "tipo_capital"))
    assert identity == {"1" * 14: "Aberto", "2" * 14: "Aberto", "3" * 14: "Fechado", "4" * 14: "Aberto", "5" * 14: "Aberto", "9" * 14: "Fechado"}


def test_missing_rates_newest_first(spark):
    df = spark.createDataFrame([("d1", None, 1.0), ("d2", None, 1.0), ("d3", 2.0, 1.0), ("d4", None, None)], "data_referencia string, taxa_indicativa double, pu_indicativo double")
    assert [r[0] for r in L.missing_rates(df).collect()] == ["d2", "d1"]
    assert [r[0] for r in L.missing_rates(df, "d2").collect()] == ["d2"]


# Tables -------------------------------------------------------------------


def test_upsert(spark):
    target = spark.createDataFrame([(1, None, "a", "g"), (2, "x", "b", "g")], "k int, d string, v string, grupo string").withColumn("t", F.lit(None).cast("string"))
    updates = spark.createDataFrame([(1, None, "n1", 0), (1, None, "n2", 1), (3, "x", None, 0)], "k int, d string, v string, n int")
    once = T.upsert(target, updates, ["k", "d"], order=["n"], touch="t", now=F.lit("now"))
    assert rows(once) == [(1, None, "n2", "g", "now"), (2, "x", "b", "g", None), (3, "x", None, None, "now")]
    assert rows(T.upsert(once, updates, ["k", "d"], order=["n"], touch="t", now=F.lit("now"))) == rows(once)
    assert rows(T.upsert(target, updates, ["k", "d"], columns=[], order=["n"]), "k", "v") == [(1, "a"), (2, "b"), (3, None)]
    assert rows(T.insert_new(target, updates, ["k", "d"], order=["n"]), "k", "v") == [(1, "a"), (2, "b"), (3, None)]
    assert rows(T.insert_new(target, updates, ["k", "d"], force=True, order=["n"]), "k", "v") == [(1, "n2"), (2, "b"), (3, None)]
    titles = spark.createDataFrame([(1, " T"), (2, "")], "k int, v string")
    assert rows(T.update_column(target, titles, ["k"], "v"), "k", "v") == [(1, " T"), (2, "b")]


def test_stored_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 2023, 1.0), ("a", 2024, 2.0)], "k string, y int, v double")
    T.upsert_into(path, first, ["k", "y"], ["y"])
    untouched = sorted((tmp_path / "t" / "y=2023").glob("*.parquet"))
    more = spark.createDataFrame([("a", 2024, 3.0), ("b", 2024, 4.0), ("b", 2025, 5.0)], "k string, y int, v double")
    for _ in range(2):
        T.upsert_into(path, more, ["k", "y"], ["y"])
        assert rows(spark.read.parquet(path), "k", "y", "v") == [("a", 2023, 1.0), ("a", 2024, 3.0), ("b", 2024, 4.0), ("b", 2025, 5.0)]
    assert sorted((tmp_path / "t" / "y=2023").glob("*.parquet")) == untouched
    for _ in range(2):
        T.insert_new_into(path, more.withColumn("v", F.lit(0.0)).union(spark.createDataFrame([("c", 2025, 6.0)], more.schema)), ["k", "y"], ["y"])
    assert rows(spark.read.parquet(path).where("y = 2025"), "k", "v") == [("b", 5.0), ("c", 6.0)]


def test_stored_upsert_keeps_tax_ids_and_null_partitions(spark, tmp_path):
    schema, path = "cnpj string, v int, at int", str(tmp_path / "t")
    first = spark.createDataFrame([("00000000000191", 1, 1), ("00000000000272", 2, 1)], schema)
    for _ in range(2):
        T.upsert_into(path, first, ["cnpj"], ["cnpj"])
    stored = spark.read.schema("v int, at int, cnpj string").parquet(path)
    assert rows(stored, "cnpj", "v") == [("00000000000191", 1), ("00000000000272", 2)]
    path = str(tmp_path / "n")
    T.upsert_into(path, spark.createDataFrame([("a", None, 1), ("b", None, 1)], "k string, y int, at int"), ["k", "y"], ["y"])
    T.upsert_into(path, spark.createDataFrame([("a", None, 2)], "k string, y int, at int"), ["k", "y"], ["y"])
    assert rows(spark.read.parquet(path), "k", "at") == [("a", 2), ("b", 1)]


def test_stored_upsert_does_not_depend_on_batches(spark, tmp_path):
    old, new = (spark.createDataFrame([("a", 1, n)], "k string, y int, at int") for n in (1, 2))
    for name, batches in (("x", (old, new)), ("z", (new, old)), ("w", (old.union(new),))):
        for batch in batches:
            T.upsert_into(str(tmp_path / name), batch, ["k", "y"], ["y"], order=["at"])
        assert rows(spark.read.parquet(str(tmp_path / name)), "k", "at") == [("a", 2)]


def test_repeated_keys_do_not_multiply_rows(spark):
    from issuerlake.operators import joins, merges

    history = spark.createDataFrame([("d1", 1.0), ("d2", 2.0)], "data_referencia string, taxa_indicativa double")
    found = spark.createDataFrame([("d1", "1,5", 1), ("d1", "2,5", 2)], "data_referencia string, taxa_indicativa string, n int")
    assert rows(joins.inject_rates(history, found, order=["n"])) == [("d1", 2.5), ("d2", 2.0)]
    old = spark.createDataFrame([("t", "d1", 1.0, 1)], "ticker_deb string, data_referencia string, taxa_indicativa double, n int")
    new = spark.createDataFrame([("t", "d1", 2.0, 2), ("t", "d1", 3.0, 3)], old.schema)
    assert rows(merges.merge_history(old, new, order=["n"])) == [("t", "d1", 3.0, 3)]


def test_dot_segments(value):
    for href, want in (("../x.pdf", "https://h.com/a/x.pdf"), ("./x.pdf", "https://h.com/a/b/x.pdf"), ("/../q/./y?z=../1", "https://h.com/q/y?z=../1"), ("../../../x", "https://h.com/x"), ("..", "https://h.com/a/")):
        assert value(D.absolute_url("u", "h"), u="https://h.com/a/b/c.html", h=href) == want


def test_incremental(spark):
    listing = spark.createDataFrame([("a", 10, 5.0), ("b", 10, 5.0), ("c", 10, 5.0)], "path string, size int, modified_at double")
    other = spark.createDataFrame([("a", 10, 5.9), ("b", 11, 5.0), ("d", 1, 1.0)], "path string, size int, modified_at double")
    assert rows(T.listing_diff(listing, other)) == [("a", "same"), ("b", "changed"), ("c", "new"), ("d", "extra")]
    assert rows(T.changed_files(listing, other), "path") == [("a",), ("c",)]
    assert rows(T.outdated_outputs(listing, other, "path"), "path") == [("b",), ("c",)]


# Search, pages, sets ------------------------------------------------------


def test_search(spark):
    assets = spark.createDataFrame([("PETR26", "Petro", "26000000000000"), ("IGUA11", "Iguá", "33000000000000"), ("PETR16", "Petro", "26000000000000")], "ticker_deb string, nome_emissor string, cnpj string")
    owners = spark.createDataFrame([("26000000000000", "Petro", "petr4"), ("33000000000000", "Iguá", None)], "cnpj string, nome string, ticker_acao string")
    ids = lambda q, n=12: [r.id for r in W.search_options(assets, owners, q, n).collect()]
    assert ids("petr26") == ["ativo-PETR26", "ativo-PETR16", "emissor-26000000000000"]
    assert ids("petr") == ["ativo-PETR16", "ativo-PETR26", "emissor-26000000000000"]
    assert ids("", 2) == ["ativo-IGUA11", "ativo-PETR16"]
    assert ids("%") == []
    best = W.score_options(W.search_options(assets, owners, "petr"), "PÉTRO", "issuer").collect()[0]
    assert (best.id, best.score) == ("emissor-26000000000000", 120 + 90 + 64 + 8)


def test_pages_and_occurrences(spark):
    df = spark.createDataFrame([("a", i) for i in range(7)] + [("b", 1)], "k string, n int")
    assert [r.n for r in W.page(df.where("k = 'a'"), [down("n")], -5, 2).collect()] == [6, 5]
    assert rows(W.page_info(df.where("k = 'a'"), 5, 2)) == [(7, 5, 2, False)]
    assert rows(W.page_per(df, ["k"], ["n"], 1, 2), "k", "n") == [("a", 1), ("a", 2)]
    assert rows(W.top_n_per(df, ["k"], ["n"], 2), "k", "n", "total", "has_more") == [("a", 0, 7, True), ("a", 1, 7, True), ("b", 1, 1, False)]
    for keep, n in (("first", 0), ("last", 6)):
        for parts in (1, 6):
            assert ("a", n) in rows(W.dedupe(df.repartition(parts), ["k"], ["n"], keep))
    nulls = spark.createDataFrame([("x", None), ("y", "2024"), ("z", "2020")], "nome string, data_vencimento string")
    assert [r.nome for r in W.order_listing(nulls, "assets").collect()] == ["z", "y", "x"]
    assert [r.nome for r in nulls.orderBy(down("data_vencimento"), up("nome")).collect()] == ["x", "y", "z"]


def test_sets(spark):
    a = spark.createDataFrame([("k", 1), ("k", 2), ("k", 2)], "k string, v int")
    b = spark.createDataFrame([("k", 2), ("k", 3), ("k", 4)], "k string, v int")
    assert rows(J.set_compare(a, b, "k", "v")) == [("k", 2, 3, 1, 2, 1)]
    assert rows(J.set_compare(a, b, None, "v")) == [(2, 3, 1, 2, 1)]
    assert rows(J.contains_all(b, a, "v")) == [(2, 1, False)]


def test_owner_mapping_and_filling(spark):
    emissions = spark.createDataFrame([(" T1 ", "11-1"), ("T2", "")], "ticker string, cnpj_emissor string")
    keys = spark.createDataFrame([("T1",), ("T2",), ("T3",)], "ticker string")
    assert rows(J.map_owner(keys, emissions)) == [("T1", "111", True), ("T2", None, False), ("T3", None, False)]
    chars = spark.createDataFrame([("T2", "22"), ("T1", "99")], "ticker string, cnpj string")
    filled = J.fill_issuer(emissions.withColumn("ticker", F.trim("ticker")), chars)
    assert rows(filled, "ticker", "cnpj_emissor") == [("T1", "11-1"), ("T2", "22")]


# Documents ----------------------------------------------------------------


def one(df, col="x"):
    return df.collect()[0][col]


def test_sanitizing(spark):
    text = "Título\n\n \n\nReceita ........ 1\n----------\nFim  \n"
    df = spark.createDataFrame([(text,)], "text string")
    assert one(D.sanitize_text(df), "text") == "Título\n\nReceita\n\nFim"
    md = "a\n|---|:--|--------|\n|x| -------------------- |\nb"
    out = D.sanitize_markdown(spark.createDataFrame([(md,)], "markdown string")).collect()[0]
    assert (out.markdown, out.removed_lines) == ("a\nb", 2)


def test_pages(spark):
    def doc(name, n, text):
        return [(name, i + 1, text) for i in range(n)]

    long = "ativo total " + "x" * 100
    df = spark.createDataFrame(doc("a", 35, long) + doc("b", 11, "x" * 59) + doc("c", 9, "y" * 60) + [("b", 12, "x" * 60)], "doc_id string, page_no int, text string")
    assert rows(D.scanned(df), "doc_id", "is_scanned") == [("a", False), ("b", True), ("c", False)]
    pages, more = D.financial_pages(df).orderBy("part").collect()
    assert (pages.doc_id, pages.n_pages) == ("a", 30) and pages.text.startswith("\n\n--- PÁGINA 1 ---\nativo") and "PÁGINA 31" not in pages.text
    assert (more.doc_id, more.part, more.n_pages) == ("a", 1, 5) and more.text.startswith("\n\n--- PÁGINA 31 ---")
    assert rows(D.chunk_pages(df).where("doc_id <> 'a'"), "doc_id", "page_range") == [
        ("b", "(Páginas 9 a 12 de 12)"), ("c", "(Páginas 1 a 8 de 9)"), ("c", "(Páginas 9 a 9 de 9)")
    ]
    assert rows(D.chunk_ranges(df).where("doc_id <> 'a'"), "doc_id", "first_page", "last_page") == [("b", 1, 12), ("c", 1, 8), ("c", 9, 9)]


def test_manifest(spark):
    md = '---\narquivos_processados:\n  - nome_arquivo: "a \\"b\\" \\\\c.pdf"\n    hash_md5: "h1"\n  - nome_arquivo: sem.pdf\n---\n\n# corpo\n'
    df = spark.createDataFrame([(md,), ("---\nx\n---\nb",), ("plain",)], "markdown string")
    got = [(r.body, [tuple(f) for f in r.files]) for r in D.parse_manifest(df).collect()]
    assert got == [("# corpo\n", [('a "b" \\c.pdf', "h1")]), ("---\nx\n---\nb", []), ("plain", [])]


def test_answers_and_tiers(spark):
    good = '{"periodos": {"2024-12-31": {"tipo": "DFP", "demonstracoes": {}}}}'
    df = spark.createDataFrame([(good,), (f"[{good}]",), ("[]",), ('{"periodos": []}',), ("x",), (None,)], "answer string")
    assert [r.rejected for r in D.normalize_answers(df).collect()] == [False, False, True, True, True, True]
    tiers = spark.createDataFrame([("s", None, "r", "n"), (" ", "t", "r", "n"), (None, None, "r", "n"), (None, None, None, "n")], "structured string, retried string, raw_text string, nome_arquivo string")
    assert [r.extraction_mode for r in D.best_extraction(tiers).collect()] == ["llm", "llm", "texto_bruto", "placeholder"]


def test_links(spark):
    html = (
        '<a href="/ri/a.pdf">DFP <b>2024</b></a><a class=x href="b.xlsx"></a><a href="/ri/a.pdf">de novo</a>'
        '<a href="/central/intervias/">I</a><a href="https://out.com/itr">x</a><a href="/resultados">R</a><a href="/central/a/b">n</a>'
    )
    df = spark.createDataFrame([(1, "https://www.h.com/central/arteris/", html)], "page_id int, url string, html string")
    assert rows(D.extract_file_links(df), "url", "title", "ext") == [
        ("https://www.h.com/central/arteris/b.xlsx", "b", ".xlsx"), ("https://www.h.com/ri/a.pdf", "DFP 2024", ".pdf")
    ]
    assert rows(D.sibling_links(df), "slug", "label", "url") == [
        ("arteris", "Arteris", "https://www.h.com/central/arteris/"), ("intervias", "Intervias", "https://www.h.com/central/intervias/")
    ]
    assert rows(D.candidate_links(df), "url") == [("https://www.h.com/central/arteris/",), ("https://www.h.com/resultados",)]


def test_number_fidelity(spark):
    a = spark.createDataFrame([(1, "1.234,5 e 7 e 7")], "doc_id int, text string")
    b = spark.createDataFrame([(1, "7 e 8")], "doc_id int, text string")
    assert rows(D.number_fidelity(a, b)) == [(1, 2, 2, 1, 1, 1)]
    texts = a.withColumn("model", F.lit("a")).union(b.withColumn("model", F.lit("b")))
    assert rows(R.number_fidelity_by_model(texts, "a", "b")) == [(1, 2, 2, 1, 1, 1)]


def test_payments_belong_to_the_portfolio(spark):
    owners = spark.createDataFrame([("c1", "N1", "g", "s", "Aberto")], "cnpj string, nome string, grupo_economico string, setor string, tipo_capital string")
    assets = spark.createDataFrame([("T1", "c1", "ativo"), ("T2", "c9", "ativo")], "ticker_deb string, cnpj string, status string").withColumn("data_vencimento", F.lit("2030-01-01").cast("date"))
    sched = spark.createDataFrame([("T1", "2024-01-01", "Previsto"), ("T1", "2024-01-05", "Previsto"), ("T2", "2024-01-05", "Previsto"), ("T1", "2024-01-06", "Liquidado")], "ticker_deb string, d string, status string").select("*", F.to_date("d").alias("data_evento"), F.lit("J").alias("evento"))
    due = J.upcoming_payments(sched, assets, owners, F.lit("2024-01-02").cast("date"))
    assert [(r.ticker_deb, r.dias_para_evento) for r in due.collect()] == [("T1", 3)]
    assert {r.ticker_deb for r in due.collect()} <= {r.ticker_deb for r in J.active_portfolio(assets, owners).collect()}
