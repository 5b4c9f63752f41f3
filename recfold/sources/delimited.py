"""Tolerant reader for delimited text with accounting of rejected lines.

Lines with too many fields are dropped, short ones padded with NULL, and every column is text.

Files are always read in parts. Where quoted fields contain line breaks, what a line means depends
on whether it begins inside such a field. Each part is worked through under both assumptions, which
leaves two things to know about a part: how it ends under either, so that the assumption that holds
follows from the parts before it, and where its first record begins and its last one. That is a row
per part. The files are then read again, and the lines of a record joined by the task that reads
them; only the lines of records that go over the end of a part are brought together. No text is
written before it is parsed.

Spark's CSV parser in permissive mode with a schema as wide as the header leaves the corrupt
record column NULL exactly when a record has the header's number of fields. Only the others
have their separators counted, outside quoted fields.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from recfold import config as c
from recfold.sources.storage import materialise
from recfold.sources.tables import UnreadableSource

_CORRUPT = "__corrupt"
_FILE = "__file"
_KEPT = "__kept"
_BOM_FORMS = ("\ufeff", "\xef\xbb\xbf")


def clean_header(names: list[str | None]) -> list[str]:
    """Number repeated names, then strip blanks and byte order marks."""
    seen: dict[str, int] = {}
    cleaned = []
    for position, raw in enumerate(names):
        name = raw or f"Unnamed: {position}"
        repeat = seen.get(name, 0)
        seen[name] = repeat + 1
        name = (f"{name}.{repeat}" if repeat else name).strip()
        for mark in _BOM_FORMS:
            name = name.removeprefix(mark)
        cleaned.append(name.strip())
    return cleaned


def _file_path() -> Column:
    """Path of the row's file, percent-encoded as the metadata column holds it."""
    return F.col("_metadata.file_path").alias(_FILE)


def _file_name() -> Column:
    """Name of a file; decoded for each file, not for each row."""
    path = F.url_decode(F.replace(F.col(_FILE), F.lit("+"), F.lit("%2B")))
    return F.element_at(F.split(path, "/"), -1).alias("arquivo")


def _quoted_field(sep: str) -> str:
    # Possessive, so that the matcher loops over a long field instead of recursing into it.
    return rf'(^|\Q{sep}\E)"(?:[^"]++|"")*+"'


def _has_quote(line: Column) -> Column:
    """Whether any pattern about quotes can match; most lines, long ones too, need no more than this."""
    return F.contains(line, F.lit('"'))


def field_count(line: Column, sep: str) -> Column:
    """Fields of a raw line; separators inside quoted fields do not count."""
    bare = F.when(_has_quote(line), F.regexp_replace(line, _quoted_field(sep), "$1")).otherwise(line)
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def _transitions(line: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted field: if it begins outside of one, and if it begins inside."""
    start = rf'(^|\Q{sep}\E)"'
    closing = r'^(?:[^"]++|"")*+"'
    mark, twice = F.lit('"'), F.lit('""')

    def left_open(text: Column) -> Column:
        return F.regexp_replace(text, _quoted_field(sep), "$1").rlike(start)

    # Most quotes can't open a field, or stand alone, which takes no pattern to see.
    quote, later, alone = _has_quote(line), F.contains(line, F.lit(f'{sep}"')), ~F.contains(line, twice)
    behind = F.when(alone, F.substr(line, F.locate('"', line) + 1)).otherwise(F.regexp_replace(line, closing, ""))
    # What follows the closing quote does not begin a field.
    rest = F.concat(F.lit("x"), behind)
    return (
        F.when(quote & (F.startswith(line, mark) | later), left_open(line)).otherwise(F.lit(False)),
        F.when(quote & (alone | line.rlike(closing)), F.when(later, left_open(rest)).otherwise(F.lit(False))).otherwise(F.lit(True)),
    )


@contextmanager
def _same_parts(spark: SparkSession) -> Iterator[None]:
    """Files are split in the same way each time they are read, also if executors come and go meanwhile."""
    least = "spark.sql.files.minPartitionNum"
    if spark.conf.get(least, None):
        yield
        return
    spark.conf.set(least, spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.unset(least)


def _lines(spark: SparkSession, path: str | list[str], encoding: str, line_sep: str | None = None) -> DataFrame:
    """Physical lines with their file, the start and length of their part of it, and their order within the part."""
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    text = reader.text(path)  # bytes as they are, whatever the encoding
    line = F.col("value")
    if encoding.upper() not in ("UTF-8", "UTF8"):
        line = F.decode(line.cast("binary"), encoding)
    return text.select(
        _file_path(), F.col("_metadata.file_block_start").alias("parte"), F.col("_metadata.file_block_length").alias("tamanho"),
        F.monotonically_increasing_id().alias("posicao"), line.alias("linha"),
    )


def line_profile(spark: SparkSession, path: str | list[str], sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """Per file: physical lines, first line, and whether any line leaves a quoted field open."""
    at_start = (F.col("parte") == 0) & (F.trim("linha") != "")
    placed = _lines(spark, path, encoding).select(
        _FILE, _transitions(F.col("linha"), sep)[0].alias("aberta"),
        F.when(at_start, F.col("linha")).alias("linha"),
        F.when(at_start, F.col("posicao")).alias("posicao"),
    )
    # The set lets Spark reduce lines in a hash map; for texts alone it sorts all lines of a task by their file.
    return placed.groupBy(_FILE).agg(
        F.count("*").alias("linhas"),
        F.min_by("linha", "posicao").alias("primeira_linha"),
        (F.size(F.collect_set(F.when(F.col("aberta"), True))) > 0).alias("quebra_em_campo"),
    )


def _beginnings(df: DataFrame, within: list[str], order: str) -> DataFrame:
    """Whether each row begins inside a quoted field, if the first row of its group begins outside and if inside.

    ``abre`` and ``fica`` say how a row ends if it begins outside and if it begins inside. A row
    that ends the same way under both settles the state, whatever came before; a row that ends the
    other way than it began turns it. So the state is that of the last row that settled it, turned
    by the rows since: a sum of turns and a last value.
    """
    before = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(F.when(F.col("abre") & ~F.col("fica"), 1).otherwise(0)).over(before), F.lit(0)) % 2 == 1
    settled = F.when(F.col("abre") == F.col("fica"), F.col("abre") != F.col("vira"))
    known = df.withColumn("vira", turned)
    known = known.withColumn("fixo", F.last(settled, ignorenulls=True).over(before))
    return known.withColumns({
        "de_fora": F.coalesce("fixo", F.lit(False)) != F.col("vira"),
        "de_dentro": F.coalesce("fixo", F.lit(True)) != F.col("vira"),
    }).drop("vira", "fixo")


def _follow(lines: DataFrame) -> DataFrame:
    """``lines`` as they are read, and how each begins, and how many records began so far, if its part begins
    outside a quoted field and if inside: ``_beginnings`` for parts that a task reads from end to end.

    Tasks keep no more than the state after a batch of lines; nothing is sorted or sent.
    """
    names = ("de_fora", "de_dentro")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Defined here, so that workers need nothing of this library.
        place, states, counts = None, [False, True], [0, 0]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            file, part = batch.column(_FILE), batch.column("parte").to_numpy()
            abre, fica = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("abre", "fica"))
            new = np.ones(n, bool)
            new[0] = place != (file[0].as_py(), part[0])
            other = pc.not_equal(file.slice(1), file.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[1:] = other | (part[1:] != part[:-1])
            place = file[n - 1].as_py(), part[n - 1]
            at = np.arange(n)
            turned = np.cumsum(abre & ~fica) - (abre & ~fica)
            known = new.copy()  # rows whose state does not hang on the row before
            known[1:] |= (abre == fica)[:-1]
            since = np.maximum.accumulate(np.where(known, at, 0))
            first = np.maximum.accumulate(np.where(new, at, 0))
            made = []
            for k, outside in enumerate((False, True)):
                value = np.where(new, outside, np.concatenate([[states[k]], abre[:-1]]))
                inside = value[since] ^ ((turned - turned[since]) % 2 == 1)
                begun = np.cumsum(~inside)
                number = begun - (begun - ~inside)[first] + np.where(new[first], 0, counts[k])
                states[k], counts[k] = (fica if inside[-1] else abre)[-1], number[-1]
                made += [pa.array(inside), pa.array(number, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=columns)

    schema = StructType([*lines.schema.fields, *(
        StructField(name, kind) for begins in names for name, kind in ((begins, BooleanType()), (f"numero_{begins}", LongType()))
    )])
    columns = schema.names
    return lines.mapInArrow(work, schema)


def _join_lines(lines: DataFrame) -> DataFrame:
    """Records that begin and end in the same part, each at the place of its first line.

    ``dentro`` says whether the part of a line begins inside a quoted field. Tasks keep the lines of a record that
    goes on in the next batch, no others; nothing is sorted or sent.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Defined here, so that workers need nothing of this library.
        place, state, begun, kept = None, False, None, []
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if batch.column("dentro").null_count:
                raise RuntimeError("the files were split otherwise than before, or changed meanwhile")
            file, part, line = batch.column(_FILE), batch.column("parte").to_numpy(), batch.column("linha")
            abre, fica, dentro = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("abre", "fica", "dentro"))
            new = np.ones(n, bool)
            new[0] = place != (file[0].as_py(), part[0])
            other = pc.not_equal(file.slice(1), file.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[1:] = other | (part[1:] != part[:-1])
            place = file[n - 1].as_py(), part[n - 1]
            # How lines begin: as in _follow, from one assumption.
            turned = np.cumsum(abre & ~fica) - (abre & ~fica)
            known = new.copy()
            known[1:] |= (abre == fica)[:-1]
            since = np.maximum.accumulate(np.where(known, np.arange(n), 0))
            value = np.where(new, dentro, np.concatenate([[state], abre[:-1]]))
            inside = value[since] ^ ((turned - turned[since]) % 2 == 1)
            ends_inside = np.where(inside, fica, abre)
            state = ends_inside[-1]

            first = np.flatnonzero(~inside | new)  # of each record, or of what a part has of one
            if not len(first) or first[0]:  # lines of the record that the batches before left open
                rest = first[0] if len(first) else n
                if begun is not None:
                    kept.append(line.slice(0, rest))
                    if not ends_inside[rest - 1]:
                        pieces = pa.concat_arrays(kept)
                        text = pc.binary_join(pa.ListArray.from_arrays([0, len(pieces)], pieces), pa.scalar("\n", line.type))
                        yield pa.RecordBatch.from_arrays([*begun, text], names=names)
                        begun, kept = None, []
            if not len(first):
                continue
            begun, kept = None, []
            last = np.append(first[1:], n) - 1
            whole = ~inside[first] & ~ends_inside[last]
            if ends_inside[-1] and not inside[first[-1]]:
                begun, kept = [batch.column(name).slice(first[-1], 1) for name in names[:-1]], [line.slice(first[-1])]
            if whole.any():
                texts = pa.ListArray.from_arrays(pa.array(np.append(first, n), pa.int32()), line).filter(pa.array(whole))
                at = pa.array(first[whole])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(name).take(at) for name in names[:-1]), pc.binary_join(texts, pa.scalar("\n", line.type))],
                    names=names,
                )

    names = [_FILE, "parte", "posicao", "registro"]
    return lines.mapInArrow(work, StructType([*(lines.schema[name] for name in names[:-1]), StructField("registro", StringType())]))


def _parts(lines: DataFrame, path: str) -> DataFrame:
    """A row for each part of a file, written to ``path``.

    ``dentro`` and ``aberta`` say whether it begins and ends inside a quoted field, ``fim`` where the record ends that
    it begins in, ``inicio`` where the last record of its own begins, ``anterior`` in which part the one open at its
    beginning does, ``primeira`` where the first line stands that is ``cheia``.
    """
    part = [_FILE, "parte"]
    followed = _follow(lines.select(*part, "tamanho", "posicao", "abre", "fica", "cheia"))

    def ends(begins: str) -> Column:
        return F.when(F.col(begins), F.col("fica")).otherwise(F.col("abre"))

    ways = ("de_fora", "de_dentro")
    parts = followed.groupBy(*part, "tamanho").agg(
        F.min(F.when(F.col("cheia"), F.col("posicao"))).alias("primeira"),
        *(F.max_by(ends(way), "posicao").alias(name) for way, name in zip(ways, ("abre", "fica"), strict=True)),
        *(F.min(F.when(~ends(way), F.col("posicao"))).alias(f"fim_{way}") for way in ways),
        *(F.max(F.when(~F.col(way), F.col("posicao"))).alias(f"inicio_{way}") for way in ways),
    )
    earlier = Window.partitionBy(_FILE).orderBy("parte").rowsBetween(Window.unboundedPreceding, -1)
    parts = _beginnings(parts, [_FILE], "parte").withColumn("dentro", F.col("de_fora"))
    fim, inicio = (F.when(F.col("dentro"), F.col(f"{at}_de_dentro")).otherwise(F.col(f"{at}_de_fora")) for at in ("fim", "inicio"))
    begins = F.when(inicio.isNotNull(), F.col("parte"))
    return materialise(parts.select(
        *part, "tamanho", "dentro", ends("dentro").alias("aberta"), fim.alias("fim"), inicio.alias("inicio"),
        F.last(begins, ignorenulls=True).over(earlier).alias("anterior"), "primeira",
    ), path)


def records_of(lines: DataFrame, sep: str, scratch: str, blank_too: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records with file and place, a line break within joining their lines; files that end inside a field; and the
    place of the first record of each file, of those that are not blank unless ``blank_too``.

    ``lines`` come straight from ``_lines``: each part in one task, in order. They are read again for the records, in
    the same parts: ``_same_parts`` sees to that, and a part that is not known fails. A window runs over the parts of
    one file, never over its lines.
    """
    abre, fica = _transitions(F.col("linha"), sep)
    # A record of several lines has a quote, so blank ones are single lines.
    filled = F.lit(True) if blank_too else F.trim("linha") != ""
    lines = lines.withColumns({"abre": abre, "fica": fica})
    parts = _parts(lines.withColumn("cheia", filled), f"{scratch}/parts")
    damaged = parts.groupBy(_FILE).agg(F.max_by("aberta", "parte").alias("aberta")).filter("aberta").select(_FILE)
    places = parts.filter("primeira IS NOT NULL").groupBy(_FILE).agg(
        F.min(F.struct("parte", F.col("primeira").alias("posicao"))).alias("cabecalho")
    )

    # A row per part is never more than the driver's list of them, and lines must stay in order: so it is sent to them.
    part = [_FILE, "parte", "tamanho"]
    known = lines.join(F.broadcast(parts.select(*part, "dentro")), part, "left")
    records = _join_lines(known.select(_FILE, "parte", "posicao", "linha", "abre", "fica", "dentro"))
    if parts.filter("dentro").isEmpty():
        return records, damaged, places
    edges = lines.join(F.broadcast(parts.filter("dentro OR aberta")), part)
    head = F.col("dentro") & (F.col("fim").isNull() | (F.col("posicao") <= F.col("fim")))
    tail = F.col("aberta") & (F.col("posicao") >= F.col("inicio"))
    pieces = F.array_sort(F.collect_list(F.struct("parte", "posicao", "linha")))
    over = edges.filter(head | F.coalesce(tail, F.lit(False))).groupBy(
        _FILE, F.when(head, F.col("anterior")).otherwise(F.col("parte")).alias("de")
    ).agg(pieces.alias("pedacos")).select(
        _FILE, F.col("pedacos")[0]["parte"].alias("parte"), F.col("pedacos")[0]["posicao"].alias("posicao"),
        F.array_join(F.col("pedacos.linha"), "\n").alias("registro"),
    )
    return records.unionByName(over), damaged, places


def _fields(width: int) -> StructType:
    return StructType([StructField(name, StringType()) for name in [*(f"_{i}" for i in range(width)), _CORRUPT]])


_PARSER = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "quote": '"', "escape": '"'}


def parse(spark: SparkSession, path: str | list[str], width: int, sep: str, encoding: str) -> DataFrame:
    """The lines behind the header of each file, by position, each line a record."""
    reader = spark.read.options(sep=sep, encoding=encoding, header=True, **_PARSER).schema(_fields(width))
    return reader.csv(path).select(*_fields(width).names, _file_path())


def _first_records(records: DataFrame, places: DataFrame, profile: DataFrame, sep: str, scratch: str) -> DataFrame:
    """Place and text of the first record of each file that is not blank."""
    open_ = _transitions(F.col("primeira_linha"), sep)[0]
    # The profile has the first line of a file's first part, which nearly always is the record.
    known = places.join(profile.filter(~open_), _FILE, "left").select(
        _FILE, "cabecalho", F.when(F.col("cabecalho.parte") == 0, F.col("primeira_linha")).alias("primeira_linha")
    )
    known = materialise(known, f"{scratch}/firsts")
    if known.filter("primeira_linha IS NULL").isEmpty():
        return known
    found = records.join(F.broadcast(places), _FILE).filter(F.struct("parte", "posicao") == F.col("cabecalho"))
    return materialise(found.select(_FILE, "cabecalho", F.col("registro").alias("primeira_linha")), f"{scratch}/all_firsts")


def parse_records(records: DataFrame, firsts: DataFrame, width: int, sep: str) -> DataFrame:
    """The records behind the header of each file, by position."""
    values = F.from_csv("registro", _fields(width).simpleString()[len("struct<"):-1].replace(":", " "),
                        {"sep": sep, **_PARSER})
    behind = records.join(F.broadcast(firsts.select(_FILE, "cabecalho")), _FILE).filter(
        (F.struct("parte", "posicao") > F.col("cabecalho")) & (F.trim("registro") != "")
    )
    return behind.select(values.alias("valores"), _FILE).select("valores.*", _FILE)


def _landed(
    parsed: DataFrame, firsts: DataFrame, headers: dict[str, list[str]], sep: str, filled: bool
) -> DataFrame:
    """Every non-blank record under the names of its file's header, with its file and whether it is kept.

    ``filled`` says that blank records are gone.
    """
    names = next(iter(headers.values()))
    corrupt = F.col(_CORRUPT)
    rows = parsed
    if not filled or len(names) == 1:
        # A filter goes below the parser and would have each record parsed twice.
        blank = F.trim(corrupt if len(names) > 1 else F.col("_0")) == ""
        rows = rows.filter(~F.coalesce(blank, F.lit(False)))
    if len(headers) > 1:
        rows = rows.join(F.broadcast(firsts.select(_FILE, "primeira_linha")), _FILE)  # no row is sent for its file's header

    def value(name: str) -> Column:
        lines = list(headers)
        found = F.col(f"_{names.index(name)}")
        for line in lines[1:]:
            found = F.when(F.col("primeira_linha") == line, F.col(f"_{headers[line].index(name)}")).otherwise(found)
        return found

    return rows.select(
        *(F.when(~value(name).isin(c.NA_TOKENS), value(name)).alias(name) for name in names),
        _FILE, (corrupt.isNull() | (field_count(corrupt, sep) <= len(names))).alias(_KEPT),
    )


def read_tolerant_csv(
    spark: SparkSession,
    path: str,
    scratch: str,
    header: list[str] | None = None,
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    multiline: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Kept rows and one report row per file.

    The text is parsed once into a Parquet table below ``scratch``, the only copy of it that is
    made; rows and report both come from there. Files are read in parts, also where quoted fields contain line breaks; with
    ``multiline`` false every line is a record. Records stand under their own file's header and
    are aligned by name.

    ``UnreadableSource`` is raised, and nothing returned, if no file has a line, if the files'
    column sets differ, or if a file ends inside a quoted field: what a parser makes of such a
    file lacks rows.
    """
    with _same_parts(spark):
        profile = materialise(line_profile(spark, path, sep, encoding), f"{scratch}/profile")
        if multiline and not profile.filter("quebra_em_campo").isEmpty():
            records, damaged, places = records_of(_lines(spark, path, encoding), sep, scratch)
            if not damaged.isEmpty():
                raise UnreadableSource(f"{damaged.select(_file_name()).first()[0]} of {path} ends inside a quoted field", profile)
            firsts = _first_records(records, places, profile, sep, scratch)
            headers = _headers(firsts, profile, path, header, sep)
            parsed, filled = parse_records(records, firsts, len(next(iter(headers.values()))), sep), True
        else:
            firsts = profile
            headers = _headers(firsts, profile, path, header, sep)
            parsed, filled = parse(spark, path, len(next(iter(headers.values()))), sep, encoding), False
        landed = materialise(_landed(parsed, firsts, headers, sep, filled), f"{scratch}/rows")
    return landed.filter(_KEPT).drop(_FILE, _KEPT), reject_report(landed, profile)


def read_exact_csv(spark: SparkSession, path: str, schema: StructType | str, scratch: str) -> DataFrame:
    """What ``sinks.files.write_csv`` wrote to ``path``, to the letter, read in parts.

    Values keep their line breaks, carriage returns and blanks; NULL stands apart from the empty text.
    """
    fields = spark.createDataFrame([], schema).schema
    with _same_parts(spark):
        records, _, places = records_of(_lines(spark, path, "UTF-8", "\n"), ",", scratch, blank_too=True)
        behind = records.join(F.broadcast(places), _FILE).filter(F.struct("parte", "posicao") > F.col("cabecalho"))
        behind = materialise(behind.select("registro"), f"{scratch}/records")
    # Only a quoted field that is empty becomes the mark; a written value can't be it.
    mark = "\ue000"
    text = StructType([StructField(f"_{i}", StringType()) for i in range(len(fields))])
    options = {"sep": ",", "quote": '"', "escape": '"', "emptyValue": mark, "nullValue": "", "lineSep": "\n"}
    values = behind.select(F.from_csv("registro", text.simpleString()[len("struct<"):-1].replace(":", " "), options).alias("v"))
    return values.select(*(
        F.when(F.col(f"v._{i}") == mark, "").otherwise(F.col(f"v._{i}")).cast(field.dataType).alias(field.name)
        for i, field in enumerate(fields)
    ))


def _headers(
    firsts: DataFrame, profile: DataFrame, path: str, header: list[str] | None, sep: str
) -> dict[str, list[str]]:
    """Column names by first line; files that differ in the order of columns alone give several."""
    lines = sorted(row[0] for row in firsts.select("primeira_linha").distinct().collect() if row[0])
    if not lines:
        raise UnreadableSource(f"{path} has no header", profile)
    if header:
        return {"": header}
    names = {line: clean_header([n or None for n in next(csv.reader([line], delimiter=sep))]) for line in lines}
    if len({tuple(sorted(columns)) for columns in names.values()}) > 1:
        raise UnreadableSource(f"files of {path} have different columns", profile)
    if len({tuple(columns) for columns in names.values()}) == 1:
        return dict([next(iter(names.items()))])
    return names


def failed_report(profile: DataFrame) -> DataFrame:
    """The report of files of which no row was taken."""
    return _with_rejects(profile.select(
        _file_name(),
        (F.col("linhas") - 1).alias("linhas_esperadas"),
        F.lit(0).cast("long").alias("linhas_sucesso"), F.lit(0).cast("long").alias("linhas_excedentes"),
    ))


def unopened_report(spark: SparkSession, name: str) -> DataFrame:
    """The report of a source that is there but of which not even lines could be read."""
    none = F.lit(0).cast("long")
    return _with_rejects(spark.range(1).select(
        F.lit(name).alias("arquivo"), none.alias("linhas_esperadas"), none.alias("linhas_sucesso"),
        none.alias("linhas_excedentes"),
    ))


def reject_report(landed: DataFrame, profile: DataFrame) -> DataFrame:
    """Per file: lines without the header, rows read, their difference and its share.

    Blank lines and line breaks inside fields count as rejected; ``linhas_excedentes`` is the
    number of lines that really had too many fields.
    """
    parsed = landed.groupBy(_FILE).agg(
        F.count_if(F.col(_KEPT)).alias("linhas_sucesso"), F.count_if(~F.col(_KEPT)).alias("linhas_excedentes")
    )
    joined = profile.join(parsed, _FILE, "left").select(
        _file_name(),
        (F.col("linhas") - 1).alias("linhas_esperadas"),
        F.coalesce("linhas_sucesso", F.lit(0)).alias("linhas_sucesso"),
        F.coalesce("linhas_excedentes", F.lit(0)).alias("linhas_excedentes"),
    )
    return _with_rejects(joined)


def combine_reports(report: DataFrame, name: str) -> DataFrame:
    """The report of a table kept in many files, as one row."""
    return _with_rejects(report.agg(
        F.lit(name).alias("arquivo"),
        *[F.sum(column).alias(column) for column in ("linhas_esperadas", "linhas_sucesso", "linhas_excedentes")],
    ))


def _with_rejects(report: DataFrame) -> DataFrame:
    rejected = F.greatest(F.col("linhas_esperadas") - F.col("linhas_sucesso"), F.lit(0))
    share = F.col("linhas_rejeitadas").cast("double") / F.col("linhas_esperadas") * F.lit(100.0)
    return report.withColumn("linhas_rejeitadas", rejected).select(
        "arquivo",
        "linhas_esperadas",
        "linhas_sucesso",
        "linhas_rejeitadas",
        F.when(F.col("linhas_esperadas") > 0, share).otherwise(F.lit(0.0)).alias("percentual_rejeitado"),
        F.lit("spark_permissive_skip_bad_lines").alias("modo_leitura"),
        F.lit(c.REJECT_REASON).alias("motivo_tecnico_rejeicoes"),
        F.lit(c.REJECT_IMPACT).alias("impacto_potencial"),
        "linhas_excedentes",
    )
