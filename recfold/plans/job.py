"""The whole consolidation as one job: read, decide, write, audit."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from recfold import config as c
from recfold.config import Expectations, Skew
from recfold.operators import audit, crosswalk as cw, golden as gold, quality, relational, reports
from recfold.operators.crosswalk import RecordProfile
from recfold.sinks.files import write_csv, write_json, write_parquet
from recfold.sources.delimited import combine_reports, failed_report, read_tolerant_csv, unopened_report
from recfold.sources.fingerprint import compare_fingerprints, fingerprint
from recfold.sources.storage import materialise, scratch_dir, side_by_side
from recfold.sources.tables import SourceUnavailable, UnreadableSource, load_child, read_records


@dataclass(frozen=True)
class JobConfig:
    """Where inputs and outputs are; any path Spark can read or write."""

    records: str
    children: dict[str, str]
    output: str
    protected: list[str] = field(default_factory=list)
    sep: str = ";"
    encoding: str = "ISO-8859-1"
    multiline: bool = True
    expectations: Expectations = Expectations()
    skew: Skew = Skew()


@dataclass(frozen=True)
class Decision:
    """What the policy made of the records. All frames are lazy until asked for."""

    records: DataFrame
    children: dict[str, DataFrame]
    profile: RecordProfile
    annotated: DataFrame
    aggregates: DataFrame
    written: bool = False

    @property
    def groups(self) -> DataFrame:
        return cw.event_groups(self.records, self.profile)

    @property
    def crosswalk(self) -> DataFrame:
        return cw.crosswalk(self.annotated)

    @property
    def golden(self) -> DataFrame:
        return gold.golden(self.annotated, self.aggregates, self.profile.hot, self.written)

    @property
    def full_records(self) -> DataFrame:
        return gold.full_records(self.annotated, self.records.columns)


def decide(records: DataFrame, children: dict[str, DataFrame], skew: Skew = Skew(), scratch: str | None = None) -> Decision:
    """With ``scratch``, what several outputs read again is written there once."""
    profile, heavy = side_by_side(
        lambda: cw.profile_records(records, skew),
        lambda: relational.repeats_heavily(children["der_ocorrencia"], skew),
    )
    annotated = cw.annotate(records, profile)
    aggregates = relational.occurrence_aggregates(children, heavy, skew)
    if scratch:
        annotated, aggregates = side_by_side(
            lambda: materialise(annotated, f"{scratch}/annotated"),
            lambda: materialise(aggregates, f"{scratch}/aggregates"),
        )
    return Decision(records, children, profile, annotated, aggregates, written=bool(scratch))


def read_children(spark: SparkSession, config: JobConfig, scratch: str) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """The child tables and one reject report per table that was there."""
    children, ingest = {}, []
    for name in c.CHILD_TABLES:
        def read(name: str = name) -> DataFrame:
            try:
                rows, report = read_tolerant_csv(
                    spark, config.children[name], f"{scratch}/{name}", sep=config.sep,
                    encoding=config.encoding, multiline=config.multiline,
                )
            except UnreadableSource as error:
                ingest.append(combine_reports(failed_report(error.profile), name))
                raise
            except KeyError:  # not listed
                raise
            except Exception as error:
                if not (isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"):
                    ingest.append(unopened_report(spark, name))
                raise
            ingest.append(combine_reports(report, name))
            return rows

        children[name], _ = load_child(spark, name, read)
    return children, ingest


def run(spark: SparkSession, config: JobConfig) -> DataFrame:
    """Write all outputs below ``config.output`` and return the check table.

    Tables that are outputs anyway serve the later steps from where they were written; the
    annotated records and the landed child tables go to the shared scratch folder.
    """
    scratch = scratch_dir(spark)

    def output(name: str) -> str:
        return f"{config.output}/{name}"

    try:
        before = materialise(fingerprint(spark, config.protected), f"{scratch}/before") if config.protected else None
    except FileNotFoundError as error:
        raise SourceUnavailable(f"FAIL_BLOQUEADO: a protected file is missing: {error}") from error
    records = read_records(spark, config.records)
    children, ingest = read_children(spark, config, scratch)
    write_json(reduce(DataFrame.unionByName, ingest), output("ingest_report"))

    profile, heavy = side_by_side(
        lambda: cw.profile_records(records, config.skew),
        lambda: relational.repeats_heavily(children["der_ocorrencia"], config.skew),
    )
    annotated, aggregates = side_by_side(
        lambda: materialise(cw.annotate(records, profile), f"{scratch}/annotated"),
        lambda: materialise(
            relational.occurrence_aggregates(children, heavy, config.skew), output("occurrence_aggregates")
        ),
    )
    decision = Decision(records, children, profile, annotated, aggregates, written=True)
    golden, *_ = side_by_side(
        lambda: materialise(decision.golden, output("golden")),
        lambda: write_csv(decision.crosswalk.select(c.CROSSWALK_COLUMNS), output("crosswalk")),
        lambda: write_parquet(decision.full_records, output("full_records")),
    )

    facts = materialise(
        audit.facts(records, decision.crosswalk, golden, aggregates, children), f"{scratch}/facts"
    )
    write_json(facts.select(quality.metric_names(facts)), output("match_metrics"))
    write_csv(reports.source_key_inventory(records), output("source_key_inventory"))
    write_csv(reports.schema_inventory(aggregates), output("schema_inventory"))
    write_csv(reports.summary_counts(facts), output("summary_counts"))
    write_csv(reports.version_compare(golden, config.expectations), output("version_compare"))
    write_csv(reports.scenario_compare(golden, config.expectations), output("scenario_compare"))

    intact = None
    if before is not None:
        compared = materialise(compare_fingerprints(before, fingerprint(spark, config.protected)), f"{scratch}/compared")
        write_csv(compared.select("arquivo", "hash_pre", "hash_pos"), output("protected_files"))
        intact = compared.filter(~F.col("iguais")).isEmpty()
    tables = {"expectations": config.expectations, "sources": len(c.CHILD_TABLES), "reports": len(ingest)}
    write_json(quality.key_checks(facts, **tables), output("key_checks"))
    checks = materialise(quality.checks(facts, integrity=intact, **tables), f"{scratch}/checks")
    write_json(checks, output("checks"))
    manifest = materialise(fingerprint(spark, config.output), f"{scratch}/manifest")
    write_csv(manifest, output("manifest"))
    return checks
