"""Delimited reading, landing, sinks and the whole study on a file of the sales shape."""

import gzip
import json
import os
import random

import pytest

from sparkinfer.plans.suites import SalesColumns, StudyConfig, run_study
from sparkinfer.sources import delimited, landing

HEADER = ("FECHA;CANAL;SKU;PRODUCTO;UNIDADES;PORCENTAJE DESCUENTO;MONTO APLICADO;BOLETA;LOCAL;CODIGO CLIENTE;"
          "RUN CLIENTE;NOMBRES;APELLIDOS;FECHA NACIMIENTO;GENERO;EXTRA")
ROWS = [
    '2024-01-05 10:00:00;POS;1;"a;b";2;0.4;1000;7;12;u1;r;n;l;1980-02-03;1;x',
    '2024-01-06 11:00:00;WEB;2;"say ""hi""";0;;500;8;1999;;r;n;l;not a date;2;x',
    '2024-01-07;APP;3;c;1;1.5;250.5;9;1999;u1;r;n;l;;2;x',
    '2024-01-08;POS;4;NA;NA;nan;99;10;12;u2;r;n;l;1990-01-01;1;x',
]


def _write(path, lines, zipped=False):
    text = "\n".join(lines) + "\n"
    if zipped:
        with gzip.open(path, "wt") as out:
            out.write(text)
    else:
        path.write_text(text)
    return str(path)


@pytest.mark.parametrize("zipped", [False, True])
def test_typed_scan(spark, tmp_path, zipped):
    path = _write(tmp_path / ("s.csv.gz" if zipped else "s.csv"), [HEADER, *ROWS], zipped)
    got = delimited.scan(spark, path)
    assert got.missing == () and "EXTRA" not in got.data.columns
    assert dict(got.data.dtypes)["GENERO"] == "tinyint" and dict(got.data.dtypes)["FECHA"] == "timestamp"
    rows = got.data.orderBy("FECHA").collect()
    assert rows[0]["PRODUCTO"] == "a;b" and rows[1]["PRODUCTO"].startswith("say")
    assert [r["UNIDADES"] for r in rows] == [2, 0, 1, None]
    assert [r["PORCENTAJE DESCUENTO"] for r in rows] == [0.4, None, 1.5, None]
    assert rows[1]["CODIGO CLIENTE"] is None and rows[3]["PRODUCTO"] is None


def test_missing_and_reordered_columns(spark, tmp_path):
    path = _write(tmp_path / "s.csv", ["LOCAL;FECHA;OTRA", "12;2024-01-05;1"])
    got = delimited.scan(spark, path, delimited.ANALYTIC_COLUMNS)
    assert got.data.columns == ["FECHA", "LOCAL"] and got.data.first()["LOCAL"] == 12
    assert "CANAL" in got.missing and len(got.missing) == 7


def test_bad_values(spark, tmp_path):
    path = _write(tmp_path / "s.csv", [HEADER, *ROWS, ROWS[0].replace(";12;", ";twelve;")])
    with pytest.raises(delimited.DataReadError):
        delimited.run_or_raise(delimited.scan(spark, path).data.collect, path)
    kept = delimited.scan(spark, path, mode="quarantine")
    assert kept.data.count() == 4 and [r.bad_columns for r in kept.rejected.collect()] == [["LOCAL"]]
    assert delimited.scan(spark, path, mode="coerce").data.where("LOCAL is null").count() == 1
    with pytest.raises(delimited.DataReadError):
        delimited.scan(spark, str(tmp_path / "absent.csv"))


def test_landing_is_reused_until_the_source_changes(spark, tmp_path):
    path, target = _write(tmp_path / "s.csv.gz", [HEADER, *ROWS], True), str(tmp_path / "landed")
    options = {"columns": delimited.ANALYTIC_COLUMNS}
    assert landing.land(spark, path, target, 2, **options).data.count() == 4
    before = sorted(os.listdir(target))
    landing.land(spark, path, target, 2, **options)
    assert sorted(os.listdir(target)) == before
    _write(tmp_path / "s.csv.gz", [HEADER, *ROWS, ROWS[0]], True)
    later = os.path.getmtime(path) + 60
    os.utime(path, (later, later))
    assert landing.land(spark, path, target, 2, **options).data.count() == 5


def test_balance_only_adds_partitions(spark):
    few, many = spark.range(100, numPartitions=1), spark.range(100, numPartitions=64)
    assert landing.balance(few, 4).rdd.getNumPartitions() == 4
    assert landing.balance(many, 4) is many


def test_study_from_file_to_results(spark, tmp_path):
    rng = random.Random(1)
    lines = [HEADER]
    for i in range(600):
        channel = rng.choice(["POS"] * 6 + ["WEB", "APP", "CCT"])
        store = rng.choice([3, 5, 6]) if channel == "POS" else 1999
        discount = rng.choice(["", "0.1", "0.4", "0.5"])
        born = "bad" if i % 50 == 0 else f"{rng.randrange(1940, 2005)}-0{rng.randrange(1, 9)}-11"
        lines.append(f"2024-0{rng.randrange(1, 10)}-{rng.randrange(1, 29):02d};{channel};{i};p;1;{discount};{rng.randrange(100, 90000)};"
                     f"{i};{store};c{rng.randrange(80)};r;n;l;{born};{rng.choice([1, 2])};x")
    path = _write(tmp_path / "sales.csv", lines)
    data = delimited.scan(spark, path, [*delimited.ANALYTIC_COLUMNS, "BOLETA"]).data
    c = SalesColumns("FECHA", "CANAL", "LOCAL", "UNIDADES", "PORCENTAJE DESCUENTO", "MONTO APLICADO", "CODIGO CLIENTE",
                     "GENERO", "FECHA NACIMIENTO", "EDAD")
    results = run_study(data, StudyConfig(columns=c, keys=("BOLETA",), seed=42))
    assert results["customers"].first()[0] == len({ln.split(";")[9] for ln in lines[1:]})
    assert results["clean"].count() == 600 and results["clean"].where("EDAD is null").count() == 0
    hypotheses = {(r.hypothesis, r.test): r for r in results["hypotheses"].collect()}
    assert len(hypotheses) == 8
    assert hypotheses["discount_moves_units", "slope"].status == "degenerate"
    assert {r.term for r in results["ols_coefficients"].collect()} == {
        "const", "PORCENTAJE DESCUENTO", "CANAL_WEB", "CANAL_APP", "CANAL_CCT"}
    assert results["ols_holdout"].first().n == 180
    undefined = results["correlations"].where("a = 'UNIDADES' and b <> 'UNIDADES'").collect()
    assert {r.cell for r in undefined} == {"undef."}
    small = {n: results[n] for n in ("describe", "outliers", "event_impact")}
    landing.write_results(small, str(tmp_path / "out"), "json")
    text = "".join(p.read_text() for p in (tmp_path / "out" / "outliers").glob("part-*"))
    assert json.loads(text.splitlines()[0])["n"] == 600
