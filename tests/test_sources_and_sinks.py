import csv
import hashlib
import inspect
import io
import random
import subprocess
import sys

import fixtures
import pytest
from conftest import ROOT
from pyspark.sql import functions as F

from recfold import config as c
from recfold.operators import crosswalk as cw, relational
from recfold.sinks.files import write_csv, write_json, write_parquet
from recfold.sources import delimited
from recfold.sources.fingerprint import compare_fingerprints, content_fingerprint, fingerprint
from recfold.sources.storage import materialise, scratch_dir
from recfold.sources.tables import SourceUnavailable, UnreadableSource, empty_table, load_child, read_records

FIXTURE = (
    b"\xef\xbb\xbfnumero;b;c\n1;2;3\n1;2\n1;2;3;4\n\n;;\nNA;NaN;null\n1;2;3;\n1;2;3;;\n"
    b'9;"l1\nl2";3\n1;a"b;3\n'
)
KEPT = [
    ("1", "2", "3"), ("1", "2", None), (None, None, None), (None, None, None), ("9", "l1\nl2", "3"), ("1", 'a"b', "3"),
]


def read(spark, tmp_path, content, **options):
    path = tmp_path / "in"
    path.mkdir(exist_ok=True)
    (path / "(BD) - tabela 2019 a nov.csv").write_bytes(content)
    return delimited.read_tolerant_csv(spark, str(path), str(tmp_path / "scratch"), **options)


def test_tolerant_csv(spark, tmp_path):
    rows, report = read(spark, tmp_path, FIXTURE)
    assert rows.columns == ["numero", "b", "c"]
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(KEPT, key=repr)
    line = report.first()
    assert (line.linhas_esperadas, line.linhas_sucesso, line.linhas_rejeitadas, line.linhas_excedentes) == (11, 6, 5, 3)
    assert line.percentual_rejeitado == 5 / 11 * 100
    assert line.arquivo.startswith("(BD)")


def test_line_split_reading_equals_whole_file_reading(spark, tmp_path):
    content = FIXTURE.replace(b'9;"l1\nl2";3\n', b'9;"a;b";3\n"x;""y";2\n"p;q";2;3;4\n')
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
    by_line, _ = read(spark, tmp_path / "a", content)
    whole, _ = read(spark, tmp_path / "b", content, multiline=True)
    assert sorted(map(tuple, by_line.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert ('x;"y', "2", None) in set(map(tuple, by_line.collect()))


def test_files_with_and_without_broken_fields(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "plain+[2].csv").write_bytes(b"numero;b;c\n5;6;7\n5;6;7;8\n")
    rows, report = read(spark, tmp_path, FIXTURE)
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted([*KEPT, ("5", "6", "7")], key=repr)
    total = delimited.combine_reports(report, "tabela").first()
    assert (total.arquivo, total.linhas_esperadas, total.linhas_sucesso, total.linhas_excedentes) == ("tabela", 13, 7, 4)


def broken_file(seed):
    """Quoted fields with line breaks, separators, quotes and blank lines in them, and quotes that open nothing."""
    draw = random.Random(seed)
    fields = ["", "x", 'a"b', "é", '"l1\nl2"', '"\n\n"', '"p;q"', '"say ""so"""', '""""', '"\n;\n""\n;"', '"' + "z" * 90 + '\n"']
    lines = [";".join(draw.choices(fields, k=draw.choice((1, 2, 3, 3, 3, 4)))) for _ in range(150)]
    return "\n".join(["a;b;c", *lines]) + "\n"


@pytest.mark.parametrize("seed, size", [(1, 40), (2, 97), (3, 1000), (4, 1 << 20)])
def test_line_breaks_in_fields_whatever_the_parts(spark, tmp_path, seed, size):
    """Parts of a few bytes, so that records and fields go over several of them."""
    text = broken_file(seed)
    records = list(csv.reader(io.StringIO(text, newline=""), delimiter=";"))[1:]
    kept = [(r + [""] * 3)[:3] for r in records if 0 < len(r) <= 3]
    wanted = sorted(([None if v in c.NA_TOKENS else v for v in r] for r in kept), key=repr)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        rows, report = read(spark, tmp_path, text.encode("latin-1"))
        assert size > 1000 or spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(list, rows.collect()), key=repr) == wanted
    assert report.first().linhas_excedentes == sum(len(r) > 3 for r in records)


def test_no_file_is_read_as_one_value():
    source = inspect.getsource(delimited)
    assert "wholetext" not in source and "multiLine" not in source and "toLocalIterator" not in source


def test_accents_crlf_and_blank_lines(spark, tmp_path):
    rows, report = read(spark, tmp_path, "numero;b\r\n1;LESÕES\r\n   \r\n2; x \r\n".encode("latin-1"))
    assert sorted(map(tuple, rows.collect())) == [("1", "LESÕES"), ("2", " x ")]
    assert report.first().linhas_rejeitadas == 1


def test_header_names():
    assert delimited.clean_header(["﻿ a ", "b", "b", None, "\xef\xbb\xbfc"]) == ["a", "b", "b.1", "Unnamed: 3", "c"]


@pytest.mark.parametrize("line, width", [
    ("a", 1), ("a;b", 2), ("a;", 2), ('"a;b";c', 2), ('"a""b;";c;', 3), ('a"b;c', 2), ("", 1), ('x;"y;z"', 2),
])
def test_field_count(spark, line, width):
    df = spark.createDataFrame([(line,)], "l string")
    assert df.select(delimited.field_count(F.col("l"), ";")).first()[0] == width


def test_missing_sources(spark, tmp_path):
    def read_missing():
        return spark.read.parquet(str(tmp_path / "none"))

    empty, there = load_child(spark, "der_cond_via", read_missing)
    assert not there and empty.columns == c.CHILD_TABLES["der_cond_via"] and empty.isEmpty()
    with pytest.raises(SourceUnavailable, match="FAIL_BLOQUEADO"):
        load_child(spark, "der_veiculos", read_missing)
    with pytest.raises(SourceUnavailable, match="lacks columns"):
        load_child(spark, "der_veiculos", lambda: empty_table(spark, ["numero_ocorrencia"]))


def test_missing_condition_table_gives_null_columns(spark):
    children = fixtures.children(spark)
    full = relational.occurrence_aggregates(children)
    children["der_cond_via"] = empty_table(spark, c.CHILD_TABLES["der_cond_via"])
    partial = relational.occurrence_aggregates(children)
    assert partial.filter("condicoes_via IS NOT NULL").isEmpty()
    assert partial.drop("condicoes_via").exceptAll(full.drop("condicoes_via")).isEmpty()


def test_record_table_needs_its_columns(spark, tmp_path):
    path = str(tmp_path / "base")
    write_parquet(fixtures.records(spark).withColumn("extra", F.lit(1)), path)
    assert "extra" in read_records(spark, path).columns
    write_parquet(spark.range(1), path)
    with pytest.raises(SourceUnavailable):
        read_records(spark, path)


def test_round_trips(spark, tmp_path):
    annotated = cw.annotate(fixtures.records(spark))
    crosswalk = cw.crosswalk(annotated).select(c.CROSSWALK_COLUMNS).cache()
    expected = sorted(map(tuple, crosswalk.collect()), key=repr)

    def same(df):
        return sorted(map(tuple, df.select(crosswalk.columns).collect()), key=repr) == expected

    write_parquet(crosswalk, str(tmp_path / "p"))
    assert same(spark.read.parquet(str(tmp_path / "p")))
    write_csv(crosswalk, str(tmp_path / "c"))
    schema = crosswalk.schema
    # Spark's reader takes the quoted empty text for NULL unless it is given a name.
    back = spark.read.schema(schema).options(header=True, escape='"', emptyValue="EMPTY").csv(str(tmp_path / "c"))
    assert same(back.replace("EMPTY", ""))
    write_json(crosswalk, str(tmp_path / "j"))
    assert same(spark.read.schema(schema).json(str(tmp_path / "j")))
    write_parquet(crosswalk, str(tmp_path / "q"), ["fonte_original"])
    assert spark.read.parquet(str(tmp_path / "q")).count() == len(expected)


def test_fingerprints(spark, tmp_path):
    """Empty, hidden and nested files, and names with blanks and signs; read in one way whatever the size."""
    folder = tmp_path / "files"
    (folder / "sub" / "_hidden").mkdir(parents=True)
    content = {
        "a.bin": b"", "b com espaco.bin": b"y" * 5000, "c+[1].bin": b"z" * 2000, "_c.bin": b"c", ".d.bin": b"d" * 9_000_000,
        "sub/e.bin": b"e", "sub/_hidden/f%20.bin": b"f" * 10,
    }
    for name, data in content.items():
        (folder / name).write_bytes(data)
    expected = {name: (len(data), hashlib.sha256(data).hexdigest()) for name, data in content.items()}

    def found(**options):
        rows = fingerprint(spark, str(folder), **options).collect()
        return {row.arquivo.split("/files/")[-1]: (row.tamanho_bytes, row.sha256) for row in rows}

    assert found() == expected
    assert found(task_bytes=1000) == expected
    one = fingerprint(spark, [str(folder / "a.bin"), f"file://{folder}/sub"]).collect()
    assert sorted(row.arquivo.split("/")[-1] for row in one) == ["a.bin", "e.bin", "f%20.bin"]
    with pytest.raises(FileNotFoundError):
        fingerprint(spark, str(tmp_path / "none"))
    (tmp_path / "empty").mkdir()
    assert fingerprint(spark, str(tmp_path / "empty")).count() == 0

    before = materialise(fingerprint(spark, str(folder)), str(tmp_path / "before"))
    assert compare_fingerprints(before, fingerprint(spark, str(folder))).filter("NOT iguais").isEmpty()
    (folder / "a.bin").write_bytes(b"z" * 100)
    (folder / "_c.bin").write_bytes(b"")
    (folder / "d.bin").write_bytes(b"new")
    changed = compare_fingerprints(before, fingerprint(spark, str(folder))).filter("NOT iguais")
    assert sorted(row.arquivo.split("/")[-1] for row in changed.collect()) == ["_c.bin", "a.bin", "d.bin"]


def test_fingerprints_need_no_library_on_the_workers(tmp_path):
    """A fresh session in another folder: workers find no package to import."""
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "_x").write_bytes(b"x")
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
from recfold.sources.fingerprint import fingerprint
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.range(1).mapInPandas(lambda parts: (__import__("pandas").DataFrame(
    {{"n": [any("recfold" in p or p == {str(ROOT)!r} for p in __import__("sys").path)]}}) for _ in parts), "n boolean").first()[0] is False
print("found", fingerprint(spark, {str(tmp_path / 'files')!r}).first().sha256)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert f"found {hashlib.sha256(b'x').hexdigest()}" in done.stdout, done.stderr[-2000:]


def test_any_failing_source_reaches_the_gate(spark, tmp_path):
    """Damaged files, another format and failing readers; mandatory ones stop the job."""
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 this is no table PAR1")
    mixed = tmp_path / "mixed"
    write_parquet(spark.createDataFrame([("1",) * 3], "numero_ocorrencia string, BURACOS string, `MATERIAL NA PISTA` string"), str(mixed))
    (mixed / "part-zzz.snappy.parquet").write_bytes(b"PAR1 neither is this PAR1")

    def failing():
        raise OSError("no disk")

    schema = "numero_ocorrencia string, BURACOS string, `MATERIAL NA PISTA` string"
    reads = [lambda: spark.read.parquet(str(tmp_path / "bad.parquet")), lambda: spark.read.schema(schema).parquet(str(mixed)), failing]
    for read_it in reads:
        table, there = load_child(spark, "der_cond_via", read_it)
        assert not there and table.isEmpty() and table.columns == c.CHILD_TABLES["der_cond_via"]
        with pytest.raises(SourceUnavailable, match="FAIL_BLOQUEADO"):
            load_child(spark, "der_envolvidos", read_it)
    assert load_child(spark, "der_cond_via", lambda: spark.createDataFrame([], schema))[1]


def test_exact_csv(spark, tmp_path):
    """NULL, the empty text, blanks, every kind of line break and quotes come back as they were, from small parts."""
    values = [None, "", " ", "a", "\n", "\r", "a\r\nb", '"', '""', 'x,"y"\n\n,z"', "\\", "\\n", "é", "  pad  ", ",", '"\n"']
    draw = random.Random(6)
    rows = [tuple(draw.choices(values, k=3)) + (draw.choice([None, 1, -5]),) for _ in range(400)]
    schema = "a string, b string, c string, d int"
    write_csv(spark.createDataFrame(rows, schema).repartition(3), str(tmp_path / "out"))
    for name, value in (("maxPartitionBytes", 300), ("openCostInBytes", 1)):
        spark.conf.set(f"spark.sql.files.{name}", value)
    try:
        back = delimited.read_exact_csv(spark, str(tmp_path / "out"), schema, str(tmp_path / "scratch")).collect()
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{name}")
    assert sorted(map(tuple, back), key=repr) == sorted(rows, key=repr)


def test_scratch_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark)
    assert path != scratch_dir(spark)
    if shared:
        assert path.startswith(shared)


def test_long_quoted_fields(spark, tmp_path):
    content = b'a;b\n1;"' + b"x" * 1_000_000 + b'"\n2;"' + b'""' * 100_000 + b'"\n'
    rows, _ = read(spark, tmp_path, content)
    assert {row.a: len(row.b) for row in rows.collect()} == {"1": 1_000_000, "2": 100_000}


def test_a_file_that_ends_inside_a_field_gives_no_rows(spark, tmp_path):
    good = b"".join(b"%d;x;y\n" % n for n in range(100))
    with pytest.raises(UnreadableSource) as error:
        read(spark, tmp_path, b"a;b;c\n" + good + b'77;"open;y\n' + good)
    report = delimited.failed_report(error.value.profile).first()
    assert (report.linhas_esperadas, report.linhas_sucesso, report.linhas_rejeitadas) == (201, 0, 201)
    with pytest.raises(SourceUnavailable, match="FAIL_BLOQUEADO"):
        load_child(spark, "der_veiculos", lambda: read(spark, tmp_path, b'a;b\n1;"x\n')[0])
    table, there = load_child(spark, "der_cond_via", lambda: read(spark, tmp_path, b'a;b\n1;"x\n')[0])
    assert not there and table.isEmpty()


def test_files_are_aligned_by_their_own_headers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.csv").write_bytes(b'c;b;a\n3;"2\n2";1\n')
    rows, _ = read(spark, tmp_path, b"a;b;c\n1;2;3\n")
    assert sorted(map(tuple, rows.select("a", "b", "c").collect())) == [("1", "2", "3"), ("1", "2\n2", "3")]
    (tmp_path / "in" / "c.csv").write_bytes(b"a;b;d\n1;2;3\n")
    with pytest.raises(UnreadableSource, match="different columns"):
        read(spark, tmp_path, b"a;b;c\n1;2;3\n")


def test_empty_and_unlisted_sources_reach_the_gate(spark, tmp_path):
    with pytest.raises(UnreadableSource, match="no header"):
        read(spark, tmp_path, b"")
    children = {}
    assert not load_child(spark, "der_embriaguez", lambda: children["der_embriaguez"])[1]
    with pytest.raises(SourceUnavailable):
        load_child(spark, "der_ocorrencia", lambda: children["der_ocorrencia"])


def test_content_fingerprint(spark):
    def of(rows):
        return tuple(content_fingerprint(spark.createDataFrame(rows, "a string, b double, c bigint")).first())

    rows = [("x", 1.5, 1), ("", None, 2), (None, float("nan"), None), ("x", 1.5, 1)]
    assert of(rows) == of(rows[::-1])
    assert of(rows)[0] == 4
    assert of([]) == of([]) and of([])[0] == 0
    others = [rows[:3], rows[:2] + [(None, None, None), rows[3]], [("x", 1.5, 1), (None, None, 2), *rows[2:]]]
    assert len({of(rows), of([]), *map(of, others)}) == 5
