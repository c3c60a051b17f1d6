"""Inputs that are read, parsed and sorted once."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from issuerlake.operators.aggregates import nest_statements
from issuerlake.sources.statements import preferred_files

FOLDER = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_files_are_chosen_from_one_listing(spark):
    rows = [("DFP", "BPA", 2020, "ind", "a"), ("DFP", "BPA", 2020, "con", "b"), ("DFP", "BPA", 2020, "con", "c"), ("ITR", "BPA", 2020, "ind", "d"), ("ITR", None, 2020, "con", "e"), ("ITR", "DRE", 2020, None, "f")]
    found = preferred_files(spark.createDataFrame(rows, "doc_type string, table string, year int, scope string, path string"))
    assert found.columns == ["doc_type", "table", "year", "scope", "path"]
    assert sorted(r.path for r in found.collect()) == ["b", "c", "d"]
    assert "Join" not in _plan(found)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
def test_names_are_parsed_per_file(spark):
    """No name is parsed beside the scan of the lines that the listing is made of."""
    assert "parquet" not in _plan(entry.queries()["statement_file_choice"](spark, FOLDER)).lower()


@pytest.mark.parametrize("order", [None, ["at"]])
def test_statements_nest_in_one_scan(spark, order):
    rows = [
        ("a", "2020", "ITR", "BPA", "1", "old", 1.0, 1), ("a", "2020", "DFP", "BPA", " 1 ", "new", 2.0, 2), ("a", "2020", "ITR", "DRE", "3", None, None, 3),
        ("a", "2020", "ITR", "DRE", "3", "none", 5.0, None), (None, "2020", "DFP", "BPA", "1", "x", 1.0, 1), ("b", None, "DFP", "BPA", "1", "x", 1.0, 1), ("b", "2021", "", "BPA", "1", "x", 1.0, 1),
    ]
    df = spark.createDataFrame(rows, "cnpj string, data_ref string, tipo_doc string, demonstracao string, cd_conta string, ds_conta string, valor double, at int")
    nested = nest_statements(df, order)
    plan = _plan(nested)
    assert "Join" not in plan and plan.count("Scan ") == 1
    (got,) = nested.collect()
    # By order the row without a place comes first: it labels the period. Without one, the greatest type does.
    assert (got.cnpj, got.data_ref, got.tipo, sorted(got.demonstracoes)) == ("a", "2020", "ITR", ["BPA", "DRE"])
    assert got.demonstracoes["BPA"]["1"].ds_conta == "new"
    if order:
        assert got.demonstracoes["DRE"]["3"].ds_conta is None
