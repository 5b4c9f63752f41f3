"""Every operator as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from recfold import config as c
from recfold.functions import keys, policy
from recfold.operators import audit, crosswalk as cw, golden as gold, quality, relational, reports
from recfold.plans import adapters
from recfold.plans.job import Decision, decide
from recfold.sinks.files import write_csv, write_json, write_parquet
from recfold.sources.delimited import combine_reports, read_exact_csv, read_tolerant_csv
from recfold.sources.fingerprint import compare_fingerprints, content_fingerprint, fingerprint
from recfold.sources.storage import materialise, scratch_dir, side_by_side
from recfold.sources.tables import load_child

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.spark_input(spark, sf_dir, "base")


def _children(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return adapters.spark_inputs(spark, sf_dir, list(c.CHILD_TABLES))


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cw.with_dedup_key(_base(spark, sf_dir))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base records as a written table, as the job finds them; a decision scans them thrice."""
    return materialise(_base(spark, sf_dir), f"{scratch_dir(spark)}/records")


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir)
    return cw.event_groups(records, cw.profile_records(records))


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir)
    return cw.annotate(records, cw.profile_records(records))


def _decision(spark: SparkSession, sf_dir: str, scratch: str | None = None) -> Decision:
    return decide(_records(spark, sf_dir), _children(spark, sf_dir), scratch=scratch)


# Records and policy


@query
def base_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base(spark, sf_dir)


@query
def dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(spark, sf_dir).select("id_acidente_unico", "target_der_id", "chave_dedup")


@query
def dedup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cw.group_stats(_keyed(spark, sf_dir))


@query
def policy_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base(spark, sf_dir).select(
        "id_acidente_unico", policy.rule_label().alias("regra_deduplicacao_final")
    )


@query
def policy_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annotated(spark, sf_dir).select("id_acidente_unico", "papel_no_grupo_tmp")


@query
def crosswalk_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cw.provisional_crosswalk(_annotated(spark, sf_dir))


@query
def crosswalk_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annotated(spark, sf_dir).select(
        "id_acidente_unico", "id_acidente_final", "papel_no_grupo_tmp", "papel_no_grupo"
    )


@query
def representative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cw.representatives(_groups(spark, sf_dir))


@query
def crosswalk_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cw.crosswalk(_annotated(spark, sf_dir))


@query
def crosswalk_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crosswalk file as a reader finds it."""
    path = f"{scratch_dir(spark)}/crosswalk"
    write_csv(cw.crosswalk(_annotated(spark, sf_dir)).select(c.CROSSWALK_COLUMNS), path)
    schema = ", ".join(f"{column} string" for column in c.CROSSWALK_COLUMNS)
    return read_exact_csv(spark, path, schema, f"{scratch_dir(spark)}/read")


@query
def crosswalk_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records joined to the exported crosswalk by record id."""
    attached = cw.attach_crosswalk(_base(spark, sf_dir), crosswalk_export(spark, sf_dir))
    return attached.select(
        "id_acidente_unico", "data_acidente", "id_acidente_final", "regra_deduplicacao_final",
        "papel_no_grupo", "fonte_representante",
    )


@query
def associated_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cw.associated_sources(_groups(spark, sf_dir))


@query
def canonical_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.canonical_keys(_groups(spark, sf_dir))


@query
def suffix_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = keys.occurrence_number(F.col("fonte_original"), F.col("id_original_fonte"))
    return _base(spark, sf_dir).select(
        "id_acidente_unico", number.alias("numero"), keys.associated_number(number).alias("numero_associado")
    )


# Child tables


@query
def occ_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.vehicle_aggregates(adapters.spark_input(spark, sf_dir, "der_veiculos"))


@query
def occ_involved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.involved_aggregates(adapters.spark_input(spark, sf_dir, "der_envolvidos"))


@query
def like_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of each physical state; a state may fall into several."""
    state = F.col("condicao_fisica_descricao")

    def total(marks: list[str]):
        return F.sum(F.when(relational.contains_any(state, marks), 1).otherwise(0))

    return adapters.spark_input(spark, sf_dir, "der_envolvidos").groupBy(state).agg(
        F.count("*").alias("n"),
        total(c.FATAL_MARKS).alias("fatais"),
        total(c.INJURED_MARKS).alias("feridas"),
        total(c.UNHURT_MARKS).alias("ilesos"),
    )


@query
def occ_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    children = _children(spark, sf_dir)
    return relational.condition_aggregates(
        children["der_ocorrencia"], children["der_cond_acidente"], children["der_cond_via"], children["der_embriaguez"]
    )


@query
def occ_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.occurrence_aggregates(_children(spark, sf_dir))


@query
def optional_source_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrence aggregates when one optional child table is missing."""
    missing = f"{sf_dir}/der_cond_via.parquet"
    children = _children(spark, sf_dir)
    children["der_cond_via"], _ = load_child(spark, "der_cond_via", lambda: spark.read.parquet(missing))
    return relational.occurrence_aggregates(children)


@query
def schema_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.schema_inventory(occ_aggregates(spark, sf_dir))


@query
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.distinct_keys(_children(spark, sf_dir))


# Golden and full tables


@query
def golden_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decision(spark, sf_dir).golden


@query
def full_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir)
    return gold.full_records(cw.annotate(records, cw.profile_records(records)), records.columns)


@query
def null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that no source can fill, per source."""
    return golden_records(spark, sf_dir).groupBy(
        "fonte_representante", "rodovia", "severidade", "status_rodovia_severidade"
    ).agg(F.count("*").alias("n"))


# Audit, checks and reports


@query
def audit_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, children = scratch_dir(spark), _children(spark, sf_dir)
    golden, presence = side_by_side(
        lambda: materialise(golden_records(spark, sf_dir), f"{scratch}/golden"),
        lambda: materialise(audit.key_presence(children), f"{scratch}/presence"),
    )
    return audit.audit(golden, children, audit.golden_hot_keys(golden), presence)


@query
def match_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    decision = _decision(spark, sf_dir)
    return audit.profile_metrics(decision.golden, decision.children).drop("n_universo_elegivel_der")


@query
def match_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    decision = _decision(spark, sf_dir)
    rated = audit.rates(audit.profile_metrics(decision.golden, decision.children))
    return rated.select(
        "n_universo_elegivel_der", *[name for name in rated.columns if name.startswith(("taxa_", "nota_"))]
    )


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = scratch_dir(spark)
    decision = _decision(spark, sf_dir, scratch)
    golden = materialise(decision.golden, f"{scratch}/golden")
    return audit.facts(decision.records, decision.crosswalk, golden, decision.aggregates, decision.children)


@query
def qa_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = scratch_dir(spark)
    decision = _decision(spark, sf_dir, scratch)
    golden = materialise(decision.golden, f"{scratch}/golden")
    return audit.counters(decision.records, decision.crosswalk, golden)


@query
def qa_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.checks(_facts(spark, sf_dir))


@query
def qa_key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_checks(_facts(spark, sf_dir))


@query
def pk_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    decision = _decision(spark, sf_dir, scratch_dir(spark))
    return audit.pk_uniqueness({
        "base": (decision.records, "id_acidente_unico"),
        "crosswalk": (decision.crosswalk, "id_acidente_unico"),
        "golden": (decision.golden, "id_acidente_final"),
    })


@query
def source_key_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.source_key_inventory(_base(spark, sf_dir))


@query
def summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    decision = _decision(spark, sf_dir)
    totals = audit.merge_totals([
        audit.record_counters(decision.records), audit.golden_counters(decision.golden)
    ])
    return reports.summary_counts(totals)


@query
def version_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.version_compare(golden_records(spark, sf_dir))


@query
def scenario_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.scenario_compare(golden_records(spark, sf_dir))


# Delimited files


def _read_delimited(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Write raw lines from the tables to a delimited file and read it tolerantly."""
    scratch = scratch_dir(spark)
    lines = adapters.spark_input(spark, sf_dir, "delimited_lines").toDF(";".join(adapters.DELIMITED_HEADER))
    lines.write.options(
        header=True, encoding="ISO-8859-1", sep="\x01", quote="", ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(f"{scratch}/source")
    return read_tolerant_csv(spark, f"{scratch}/source", scratch)


@query
def csv_tolerant_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_delimited(spark, sf_dir)[0]


@query
def csv_reject_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine_reports(_read_delimited(spark, sf_dir)[1], "der_envolvidos")


BROKEN_FILE_LINES = 100_000


def _read_broken(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Write files whose fields hold line breaks, each under its header, and read them tolerantly."""
    scratch = scratch_dir(spark)
    # Keys are dealt out, not the long lines made from them; the first line of a file brings its header along. As a
    # compressed file is read by one task, many lines of one number go to several.
    file = F.expr(adapters.BROKEN_FILE)
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(file).sortWithinPartitions(file)
    lines = spark.sql(adapters.INPUTS["broken_lines"], lineitem=lineitem)
    so_far = Window.partitionBy("arquivo").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    even, odd = map(F.lit, adapters.BROKEN_HEADERS)
    headed = F.concat_ws("\n", F.when(F.col("arquivo") % 2 == 0, even).otherwise(odd), F.coalesce("linha", F.lit("")))
    lines.withColumn("ordem", F.count("*").over(so_far)).select(
        "arquivo", F.when(F.col("ordem") % BROKEN_FILE_LINES == 1, headed).otherwise(F.col("linha")).alias("linha")
    ).write.options(compression="gzip", maxRecordsPerFile=BROKEN_FILE_LINES).partitionBy("arquivo").text(f"{scratch}/source")
    return read_tolerant_csv(spark, f"{scratch}/source", scratch, encoding="UTF-8")


@query
def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of files with line breaks in fields, long fields, and columns in two orders."""
    return _read_broken(spark, sf_dir)[0].select(*adapters.DELIMITED_HEADER)


@query
def csv_line_breaks_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine_reports(_read_broken(spark, sf_dir)[1], "der_envolvidos")


# File jobs


def _input_files(sf_dir: str) -> dict[str, str]:
    return {f"{table}.parquet": f"{sf_dir}/{table}.parquet" for table in adapters.TABLES}


def _contents(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name, its rows and the fingerprint of its content."""
    return reduce(DataFrame.unionByName, [
        content_fingerprint(df).select(F.lit(name).alias("arquivo"), "linhas", "sha256") for name, df in tables.items()
    ])


def _input_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contents({name: spark.read.parquet(path) for name, path in _input_files(sf_dir).items()})


def _outputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The Parquet outputs of the job, written and read back."""
    scratch = scratch_dir(spark)
    decision = _decision(spark, sf_dir, scratch)
    made = {
        "occurrence_aggregates": decision.aggregates, "golden": decision.golden, "full_records": decision.full_records,
    }
    side_by_side(*(lambda name=name, df=df: write_parquet(df, f"{scratch}/out/{name}") for name, df in made.items()))
    return {name: spark.read.parquet(f"{scratch}/out/{name}") for name in made}


@query
def file_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _input_contents(spark, sf_dir)


@query
def output_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contents(_outputs(spark, sf_dir))


@query
def integrity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The input tables before and after the outputs were made from them."""
    before = materialise(_input_contents(spark, sf_dir), f"{scratch_dir(spark)}/before")
    _outputs(spark, sf_dir)
    return compare_fingerprints(before, _input_contents(spark, sf_dir))


@query
def report_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary written as JSON lines and read back."""
    path = f"{scratch_dir(spark)}/summary"
    summary = summary_counts(spark, sf_dir)
    write_json(summary, path)
    return spark.read.schema(summary.schema).json(path)


@query
def file_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and digest of the bytes of the input files; no SQL sees them."""
    files = fingerprint(spark, list(_input_files(sf_dir).values()))
    return files.withColumn("arquivo", F.element_at(F.split("arquivo", "/"), -1))
