"""What reading delimited files and fingerprints cost: plans without a sort of lines, and results as before."""

import csv
import gzip
import io
import random
import string
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from recfold import config as c
from recfold.plans import adapters, registry
from recfold.sources import delimited
from recfold.sources.fingerprint import _six_decimals, content_fingerprint


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_profiled_without_a_sort(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a+b.csv").write_bytes(b'  \na;b\n1;"x\ny"\n')
    (tmp_path / "in" / "c.csv").write_bytes(b"c;d\n1;2\n")
    profile = delimited.line_profile(spark, str(tmp_path / "in"))
    assert "Sort" not in plan(profile)
    rows = sorted(tuple(row)[1:] for row in profile.collect())
    assert rows == [(2, "c;d", False), (4, "a;b", True)]


def test_lines_are_followed_where_they_are_read(spark, tmp_path):
    """Against a loop over the lines of each part, from parts of a few bytes, batches of a few lines."""
    (tmp_path / "in").mkdir()
    draw = random.Random(3)
    for name in "abc":
        text = "\n".join(draw.choice(["x", '"x', 'x"', ';"', '"a";"b', '";"', '""']) for _ in range(300))
        (tmp_path / "in" / f"{name}.csv").write_text(text)
    settings = {"spark.sql.files.maxPartitionBytes": 500, "spark.sql.files.openCostInBytes": 1,
                "spark.sql.execution.arrow.maxRecordsPerBatch": 7}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        abre, fica = delimited._transitions(F.col("linha"), ";")
        lines = delimited._lines(spark, str(tmp_path / "in"), "UTF-8").withColumns({"abre": abre, "fica": fica})
        followed = delimited._follow(lines)
        assert "Exchange" not in plan(followed) and "Window" not in plan(followed)
        rows = sorted(followed.collect(), key=lambda row: (row["__file"], row.parte, row.posicao))
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(rows) == 900 and len({(row["__file"], row.parte) for row in rows}) > 6
    place = None
    for row in rows:
        if place != (row["__file"], row.parte):
            place, states, counts = (row["__file"], row.parte), [False, True], [0, 0]
        counts = [count + (not state) for count, state in zip(counts, states, strict=True)]
        assert [row.de_fora, row.de_dentro, row.numero_de_fora, row.numero_de_dentro] == [*states, *counts]
        states = [row.fica if state else row.abre for state in states]


def test_records_are_parsed_once(spark):
    records = spark.createDataFrame([("f", 1, 1, "a;b"), ("f", 1, 2, '1;"x\ny"')], "__file string, parte long, posicao long, registro string")
    firsts = spark.createDataFrame([("f", (1, 1), "a;b")], "__file string, cabecalho struct<parte:long,posicao:long>, primeira_linha string")
    parsed = delimited.parse_records(records, firsts, 2, ";")
    landed = delimited._landed(parsed, firsts, {"a;b": ["a", "b"]}, ";", True)
    assert plan(landed).count("from_csv") == 1
    assert [tuple(row)[:2] for row in landed.collect()] == [("1", "x\ny")]


def test_content_is_summed_in_long_numbers(spark):
    df = spark.createDataFrame([("x", 1.5)], "a string, b double")
    assert "sum(cast(conv" not in plan(content_fingerprint(df))


@pytest.mark.parametrize("seed", [1, 2])
def test_six_decimals(spark, seed):
    draw = random.Random(seed)
    values = [
        0.0, -0.0, float("nan"), float("inf"), None, 1e8, 99999999.999999, -99999999.999999, 1e-6, 5e-7, 4.9e-7, -1e-7, 1e300,
        *(draw.choice([draw.random() * 10 ** draw.randint(-9, 12), draw.randint(-10**9, 10**9) / 10 ** draw.randint(0, 8)])
          for _ in range(5000)),
    ]
    df = spark.createDataFrame([(value,) for value in values], "v double")
    plain = F.col("v").try_cast("decimal(38,6)").cast("string")
    assert df.filter(~_six_decimals(F.col("v")).eqNullSafe(plain)).isEmpty()


@contextmanager
def small_parts(spark, size, rows):
    settings = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 1,
                "spark.sql.execution.arrow.maxRecordsPerBatch": rows}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in settings:
            spark.conf.unset(key)


def written(path):
    return sum(p.stat().st_size for p in path.rglob("*") if p.is_file())


def test_text_is_written_once(spark, tmp_path):
    """Letters that don't compress, so that the disk shows each copy of them; before, there were three."""
    draw = random.Random(5)
    (tmp_path / "in").mkdir()
    lines = [f'{n};"{"".join(draw.choices(string.ascii_letters, k=400))}\n";x' for n in range(8000)]
    (tmp_path / "in" / "a.csv").write_text("\n".join(["a;b;c", *lines]))
    rows, _ = delimited.read_tolerant_csv(spark, str(tmp_path / "in"), str(tmp_path / "scratch"))
    assert rows.count() == 8000
    assert written(tmp_path / "scratch") < 1.5 * written(tmp_path / "in")


@pytest.mark.parametrize("query", ["csv_line_breaks", "csv_line_breaks_report"])
def test_line_breaks_take_little_disk(spark, tmp_path, monkeypatch, query):
    """The files that the query makes itself are much larger than its table; before, each line of 3,000 letters stood there."""
    rows = spark.range(1400).selectExpr("20000 * (id % 3) + id div 7 AS l_orderkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber")
    rows.write.parquet(str(tmp_path / "in" / "lineitem.parquet"))
    monkeypatch.setattr(registry, "scratch_dir", lambda _: str(tmp_path / "scratch"))
    result = registry.QUERIES[query](spark, str(tmp_path / "in")).collect()
    assert written(tmp_path / "scratch") < 3000 * 200 / 2
    if query == "csv_line_breaks":
        assert len(result) == 1200 and sum(row[2] == "x" * 3000 for row in result) == 200
    else:
        assert (result[0].linhas_esperadas, result[0].linhas_sucesso, result[0].linhas_excedentes) == (2200, 1200, 200)


def test_long_lines_are_made_where_they_are_written(spark, tmp_path, monkeypatch):
    """Their keys are sent, and nothing of the lines sorted: the header still stands first in each file, no file is long."""
    rows = [(20000 * (n % 3) + n, n % 8) for n in range(200)] + [(None, 1), (None, None), (5, None)] + [(20000, 7)] * 90
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int").write.parquet(str(tmp_path / "in" / "lineitem.parquet"))
    monkeypatch.setattr(registry, "scratch_dir", lambda _: str(tmp_path / "scratch"))
    monkeypatch.setattr(registry, "read_tolerant_csv", lambda *_, **__: (None, None))
    monkeypatch.setattr(registry, "BROKEN_FILE_LINES", 40)
    registry._read_broken(spark, str(tmp_path / "in"))
    files = list((tmp_path / "scratch" / "source").rglob("part-*"))
    assert len(files) == 2 + 4 + 2 + 1
    for file in files:
        name = file.parent.name.removeprefix("arquivo=")
        even = name.isdigit() and int(name) % 2 == 0
        lines = gzip.open(file, "rt").read().splitlines()
        assert lines[0] == adapters.BROKEN_HEADERS[not even] and lines.count(lines[0]) == 1


HEADS = [
    "a;b;c\n", "\n\n  \na;b;c\n", '"a";"b\n;\n\n";c\n', '\n \n"a\n\n";b;c\n', "\n" * 300 + "a;b;c\n", '"a' + "\n" * 200 + '";b;c\n',
]


@pytest.mark.parametrize("head", range(len(HEADS)))
@pytest.mark.parametrize("size, batch", [(50, 3), (331, 1), (1 << 20, 7), (1 << 20, 10000)])
def test_records_over_parts_and_batches(spark, tmp_path, head, size, batch):
    """Headers behind blank lines and over several, records over several batches, parts and none, against the csv module."""
    draw = random.Random(head)
    fields = ["", "x", 'a"b', "é", '"l1\nl2"', '"\n\n"', '"p;q"', '"say ""so"""', '""""', '"\n;\n""\n;"', '"' + "z\n" * 40 + '"']
    lines = [";".join(draw.choices(fields, k=draw.choice((1, 2, 3, 3, 3, 4)))) for _ in range(60)]
    text = HEADS[head] + "\n".join(lines) + "\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a+b c.csv").write_text(text)
    records = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=";") if r and (len(r) > 1 or r[0].strip(" "))]
    names = delimited.clean_header(records[0])
    kept = [(r + [""] * 3)[:3] for r in records[1:] if len(r) <= 3]
    with small_parts(spark, size, batch):
        rows, report = delimited.read_tolerant_csv(spark, str(tmp_path / "in"), str(tmp_path / "scratch"), encoding="UTF-8")
    assert rows.columns == names
    wanted = sorted(([None if v in c.NA_TOKENS else v for v in r] for r in kept), key=repr)
    assert sorted(map(list, rows.collect()), key=repr) == wanted
    assert report.first().linhas_excedentes == sum(len(r) > 3 for r in records)


@pytest.mark.parametrize("large", ["false", "true"])
def test_bytes_that_are_no_text_stay(spark, tmp_path, large):
    """In records within a batch and over several, whatever the type of Arrow's texts."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes(b'a;b\n1;"\xff\n\xfe"\n2;"' + b"\xfd\n" * 20 + b'"\n')
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", large)
    try:
        with small_parts(spark, 1 << 20, 3):
            rows, _ = delimited.read_tolerant_csv(spark, str(tmp_path / "in"), str(tmp_path / "scratch"), encoding="UTF-8")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.useLargeVarTypes")
    # The parser puts U+FFFD for such a byte.
    assert sorted(len(row.b) for row in rows.collect()) == [3, 40]


def test_files_are_split_as_before_or_the_reading_fails(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("a;b\n" + '1;"x\ny"\n' * 500)
    least = "spark.sql.files.minPartitionNum"
    with delimited._same_parts(spark):
        assert int(spark.conf.get(least)) == spark.sparkContext.defaultParallelism
    assert spark.conf.get(least, None) is None
    with small_parts(spark, 1 << 20, 100):
        records, _, _ = delimited.records_of(delimited._lines(spark, str(tmp_path / "in"), "UTF-8"), ";", str(tmp_path / "scratch"))
    with small_parts(spark, 300, 100), pytest.raises(Exception, match="split otherwise"):
        records.collect()
