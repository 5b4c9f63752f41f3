"""The whole job over files, and every query against its oracle."""

import decimal
import os

import duckdb
import fixtures
import pytest

import __spark_entry__ as entry_points
from recfold.plans import registry
from conftest import TESTDATA
from recfold import config as c
from recfold.plans.job import JobConfig, decide, run
from recfold.sinks.files import write_parquet
from recfold.sources.tables import SourceUnavailable


def write_children(folder, children, skip=()):
    """One delimited Latin-1 file per table, with an over-long line each."""
    paths = {}
    for name, df in children.items():
        path = folder / f"(BD) {name} 2019 a nov.csv"
        paths[name] = str(path)
        if name in skip:
            continue
        lines = [";".join(df.columns)]
        lines += [";".join("" if value is None else value for value in row) for row in df.collect()]
        lines.append(";".join(["x"] * (len(df.columns) + 1)))
        path.write_bytes(("\n".join(lines) + "\n").encode("latin-1"))
    return paths


def config_for(spark, tmp_path, **options):
    records = str(tmp_path / "base")
    write_parquet(fixtures.records(spark), records)
    return JobConfig(
        records=records, children=write_children(tmp_path, fixtures.children(spark), options.pop("skip", ())),
        output=str(tmp_path / "out"), protected=[records], **options,
    )


def rows_of(df):
    return sorted((tuple(row) for row in df.select(sorted(df.columns)).collect()), key=repr)


def test_job_writes_everything(spark, tmp_path):
    config = config_for(spark, tmp_path, expectations=c.Expectations(input_rows=23))
    found = {row.id_check: row.status for row in run(spark, config).collect()}
    assert len(found) == 29
    assert found["QA_01"] == found["QA_13"] == found["QA_17"] == "PASS"
    assert found["QA_02"] == found["QA_14"] == "FAIL"
    direct = decide(fixtures.records(spark), fixtures.children(spark))
    out = config.output
    assert rows_of(spark.read.parquet(f"{out}/golden")) == rows_of(direct.golden)
    assert rows_of(spark.read.parquet(f"{out}/full_records")) == rows_of(direct.full_records)
    assert rows_of(spark.read.parquet(f"{out}/occurrence_aggregates")) == rows_of(direct.aggregates)
    assert spark.read.option("header", True).csv(f"{out}/crosswalk").count() == 21
    ingest = spark.read.json(f"{out}/ingest_report").collect()
    assert len(ingest) == 6 and all(row.linhas_excedentes == 1 for row in ingest)
    manifest = spark.read.option("header", True).csv(f"{out}/manifest").collect()
    written = {row.arquivo.split("/out/")[1].split("/")[0] for row in manifest}
    assert written == {
        "ingest_report", "occurrence_aggregates", "crosswalk", "golden", "full_records", "match_metrics",
        "source_key_inventory", "schema_inventory", "summary_counts", "version_compare", "scenario_compare",
        "protected_files", "key_checks", "checks",
    }


def test_job_without_an_optional_table(spark, tmp_path):
    config = config_for(spark, tmp_path, skip=("der_embriaguez",))
    found = {row.id_check: row for row in run(spark, config).collect()}
    assert (found["QA_13"].observado, found["QA_13"].status) == ("5", "FAIL")
    assert spark.read.parquet(f"{config.output}/golden").filter("indicador_embriaguez IS NOT NULL").isEmpty()


def test_job_stops_without_a_mandatory_table(spark, tmp_path):
    with pytest.raises(SourceUnavailable, match="FAIL_BLOQUEADO"):
        run(spark, config_for(spark, tmp_path, skip=("der_envolvidos",)))


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    folder = f"{TESTDATA}/sf0.001"
    for file in os.listdir(folder):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{file}'")
    return connection


def plain(value):
    return float(value) if isinstance(value, decimal.Decimal) else value


SPARK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
               "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_against_oracle(spark, small, oracle, name):
    df = entry_points.queries()[name](spark, small)
    columns = sorted(df.columns)
    rows = sorted((tuple(row) for row in df.select(columns).collect()), key=repr)
    assert rows
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert name == "file_digests"
        return
    cursor = oracle.execute(sql)
    names = [entry[0] for entry in cursor.description]
    assert sorted(names) == columns
    assert {entry[0]: str(entry[1]) for entry in cursor.description} == {
        column: SPARK_TYPES[kind] for column, kind in df.dtypes
    }
    order = [names.index(column) for column in columns]
    expected = sorted((tuple(plain(row[i]) for i in order) for row in cursor.fetchall()), key=repr)
    assert rows == expected


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == c.GOLDEN_COLUMNS
    assert (df.count(), df.select("id_acidente_final").distinct().count()) == (1188, 1117)


def test_adapter_metrics(spark, small):
    """Figures of the adapters at this scale, known beforehand."""
    row = entry_points.queries()["match_metrics"](spark, small).first()
    assert tuple(row) == (1188, 275, 378, 863, 675, 675, 620, 620, 662, 662, 654, 654, 55, 13, 21, 20, 21)
    assert entry_points.queries()["match_rates"](spark, small).first().n_universo_elegivel_der == 654
