"""The aggregate form of the crosswalk against a window form, and the skewed paths against the plain ones."""

import random

import fixtures
import pytest
from pyspark.sql import Window, functions as F

from recfold import config as c
from recfold.config import Skew
from recfold.functions import policy
from recfold.operators import audit, crosswalk as cw, golden as gold, relational
from recfold.operators.skew import hot_keys, spread_join
from recfold.plans import adapters
from recfold.plans.job import decide
from recfold.sources.storage import materialise, scratch_dir

TINY = Skew(rows_per_task=5)


def rows_of(df):
    return sorted((tuple(row) for row in df.select(sorted(df.columns)).collect()), key=repr)


def window_crosswalk(records):
    group = Window.partitionBy("chave_dedup")
    placed = cw.with_dedup_key(records).filter("chave_dedup IS NOT NULL").select(
        "*",
        F.min("id_acidente_unico").over(group).alias("id_acidente_final"),
        policy.provisional_role(
            policy.is_isolated(), policy.yields_to_sejusp(),
            F.max(F.when(F.col("fonte_original") == c.SEJUSP, 1).otherwise(0)).over(group) == 1,
        ).alias("tmp"),
    )
    order = Window.partitionBy("id_acidente_final", "tmp").orderBy(policy.source_rank(), "id_acidente_unico")
    ranked = placed.withColumn("papel_no_grupo", F.when(F.col("tmp") != c.ROLE_CANDIDATE, F.col("tmp")).when(
        F.row_number().over(order) == 1, c.ROLE_REPRESENTATIVE).otherwise(c.ROLE_EVIDENCE))
    rep = ranked.filter(F.col("papel_no_grupo") == c.ROLE_REPRESENTATIVE).select(
        "id_acidente_final", F.col("fonte_original").alias("rf"), F.col("id_original_fonte").alias("ri"))
    isolated = F.col("papel_no_grupo") == c.ROLE_ISOLATED
    return ranked.join(rep, "id_acidente_final", "left").select(
        "id_acidente_unico", "id_acidente_final", "papel_no_grupo",
        F.when(isolated, F.col("fonte_original")).otherwise(F.col("rf")).alias("fonte_representante"),
        F.when(isolated, F.col("id_original_fonte")).otherwise(F.col("ri")).alias("id_original_representante"),
    )


def random_records(seed, size=400):
    """Few values, so that cluster ids, record ids and source keys even collide with each other."""
    draw = random.Random(seed)
    ids = [f"{i:03d}" for i in range(size)]
    return [
        (
            record,
            draw.choice(["SEJUSP", "DER", "WAZE", "OUTRO", None]),
            draw.choice([None, "NaN", "", " ", "A-001", "B", "A"]),
            draw.choice(["FORTE", "FORTE", "POSSIVEL", "UNICO", None]),
            draw.choice([None, "C1", "C2", "DER_B", "005", "010", *ids[:20]]),
        )
        for record in ids
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_aggregate_form_equals_window_form(spark, seed):
    records = fixtures.records(spark, random_records(seed)).cache()
    window = window_crosswalk(records)
    profile = cw.profile_records(records)
    assert not profile.own_keys_apart
    for ours in (cw.annotate(records), cw.annotate(records, profile)):
        assert rows_of(ours.select(window.columns)) == rows_of(window)


@pytest.mark.parametrize("prefix", ["!", "D"])
def test_records_with_their_own_key_are_decided_in_place(spark, prefix):
    """With ids below all shared keys, and with ids among them but equal to none."""
    rows = [(prefix + row[0], *row[1:]) for row in random_records(4)]
    records = fixtures.records(spark, rows).cache()
    profile = cw.profile_records(records)
    assert profile.own_keys_apart
    assert rows_of(cw.annotate(records, profile)) == rows_of(cw.annotate(records))
    apart, whole = cw.event_groups(records, profile), cw.event_groups(records)
    flat = ["chave_dedup", "id_acidente_final", "fontes_associadas", "rep.fonte", F.size("chaves")]
    assert rows_of(apart.select(*flat)) == rows_of(whole.select(*flat))
    assert rows_of(gold.canonical_keys(apart)) == rows_of(gold.canonical_keys(whole))


def test_rows_without_target_may_go_around_the_join(spark):
    records, children = fixtures.records(spark), fixtures.children(spark)
    decision = decide(records, children)
    around = gold.golden(decision.annotated, decision.aggregates, written=True)
    assert around.columns == decision.golden.columns
    assert rows_of(around) == rows_of(decision.golden)


def test_window_form_on_adapters(spark, small):
    records = adapters.spark_input(spark, small, "base").cache()
    window = window_crosswalk(records)
    assert rows_of(cw.annotate(records).select(window.columns)) == rows_of(window)


def listed(hot):
    """Keys and estimated rows of a table of hot keys."""
    return {row.chave: row.linhas for row in hot.collect()}


def skewed_records():
    """A third of all rows in one cluster, another third under one blank source key."""
    rows = [(f"a{i:03d}", "WAZE" if i % 3 else "DER", None if i % 3 else "K-001", "FORTE", "HOT") for i in range(60)]
    rows += [(f"b{i:03d}", "DER", " ", "UNICO", None) for i in range(60)]
    rows += [(f"c{i:03d}", "DER", "2020-000000007-001", "POSSIVEL", None) for i in range(60)]
    return rows + fixtures.RECORDS


def test_hot_keys_change_no_result(spark):
    records = fixtures.records(spark, skewed_records()).cache()
    children = fixtures.children(spark)
    plain = decide(records, children)
    spread = decide(records, children, TINY)
    assert not any(plain.profile.hot.values())
    assert {"HOT", "DER_ "} <= set(listed(spread.profile.hot["chave_dedup"]))
    assert {" ", "2020-000000007-001"} <= set(listed(spread.profile.hot["target_der_id"]))
    assert rows_of(spread.annotated) == rows_of(plain.annotated)
    assert rows_of(spread.golden) == rows_of(plain.golden)
    assert rows_of(spread.full_records) == rows_of(plain.full_records)
    golden = plain.golden.cache()
    hot = audit.golden_hot_keys(golden, TINY)
    assert listed(hot[audit.LOOKED_UP])
    assert rows_of(audit.audit(golden, children, hot)) == rows_of(audit.audit(golden, children))


def test_spread_join_matches_plain_join(spark):
    left = spark.createDataFrame([(i, "hot" if i % 2 else (None if i % 3 == 0 else f"k{i}")) for i in range(90)],
                                 "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k4", 3), (None, 4)], "r string, v int")
    expected = rows_of(left.join(right, left.k == right.r, "left").drop("r"))
    hot = spark.createDataFrame([("hot", 8), ("other", 4)], "chave string, sais int")
    for keys in (None, hot, hot.limit(0)):
        assert rows_of(spread_join(left, right, "k", "r", [F.col("id")], "left", keys)) == expected
    inner = rows_of(left.join(right, left.k == right.r, "inner").drop("r"))
    assert rows_of(spread_join(left, right, "k", "r", [F.col("id")], "inner", hot)) == inner


def test_a_hundred_thousand_hot_keys_stay_out_of_the_plan(spark):
    """They are a table with its salts: none of them stands in the plan, and the join gives the same rows."""
    left = spark.range(300_000).select("id", F.concat(F.lit("key"), F.col("id") % 100_000).alias("k"))
    right = spark.range(0, 100_000, 2).select(F.concat(F.lit("key"), "id").alias("r"), (F.col("id") * 3).alias("v"))
    hot = materialise(
        spark.range(100_000).select(F.concat(F.lit("key"), "id").alias("chave"), (F.col("id") % 3 + 2).cast("int").alias("sais")),
        f"{scratch_dir(spark)}/hot",
    )
    joined = spread_join(left, right, "k", "r", [F.col("id")], "left", hot)
    plan = joined._jdf.queryExecution().toString()
    assert "key77" not in plan and len(plan) < 30_000
    assert joined.selectExpr("count(*)", "count(v)", "sum(v)").first() == left.join(
        right, left.k == right.r, "left").selectExpr("count(*)", "count(v)", "sum(v)").first()


def test_null_stand_in_never_matches(spark):
    left = spark.createDataFrame([(1, None)], "id int, k string")
    stand_in = left.select(F.xxhash64("id").cast("string")).first()[0]
    right = spark.createDataFrame([(stand_in, 9), (stand_in, 10)], "r string, v int")
    assert [tuple(row) for row in spread_join(left, right, "k", "r", [F.col("id")]).collect()] == [(1, None, None)]


def test_hot_key_salts_reach_several_tasks(spark):
    left = spark.createDataFrame([(i, "hot") for i in range(1000)], "id int, k string")
    right = spark.createDataFrame([("hot", 1)], "r string, v int")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = spread_join(left, right, "k", "r", [F.col("id")], "left", hot_keys(left, {"k": F.col("k")}, Skew(rows_per_task=50))["k"])
        per_task = joined.groupBy(F.spark_partition_id()).agg(F.count("v")).collect()
        assert sum(row[1] for row in per_task) == 1000
        assert len(per_task) > 4 and max(row[1] for row in per_task) < 500
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_probe_finds_keys_above_the_limit_only(spark):
    df = spark.createDataFrame([("a",)] * 20 + [("b",)] * 3 + [(None,)] * 30, "k string")
    assert listed(hot_keys(df, {"k": F.col("k")}, TINY)["k"]) == {"a": 20}
    assert hot_keys(df, {"k": F.col("k")}, Skew()) == {"k": None}
    assert hot_keys(df.limit(0), {"k": F.col("k")}, TINY) == {"k": None}
    assert hot_keys(df.filter("k is null"), {"k": F.col("k")}, TINY) == {"k": None}


def test_repeated_occurrence_rows_are_spread(spark):
    occurrences = ["001-001"] * 37 + ["003-001"] * 5 + ["007-001"]
    children = fixtures.children(spark, occurrences)
    assert relational.repeats_heavily(children["der_ocorrencia"], TINY)
    assert not relational.repeats_heavily(children["der_ocorrencia"], Skew())
    spread = relational.occurrence_aggregates(children, True, TINY)
    assert rows_of(spread) == rows_of(relational.occurrence_aggregates(children))
    assert spread.count() == 43


def test_order_of_input_does_not_matter(spark):
    records = fixtures.records(spark)
    shuffled = records.orderBy(F.rand(7))
    children = fixtures.children(spark)
    assert rows_of(decide(records, children).golden) == rows_of(decide(shuffled, children).golden)


def test_invariants(spark, small):
    records = adapters.spark_input(spark, small, "base").cache()
    annotated = cw.annotate(records).cache()
    keyed = cw.with_dedup_key(records)
    assert annotated.count() == keyed.filter("chave_dedup IS NOT NULL").count() == 1500
    group = annotated.groupBy("chave_dedup").agg(
        F.min("id_acidente_unico").alias("lowest"),
        F.min("id_acidente_final").alias("first_final"),
        F.max("id_acidente_final").alias("last_final"),
        F.count_if(F.col("papel_no_grupo") == c.ROLE_REPRESENTATIVE).alias("reps"),
        F.count_if(F.col("papel_no_grupo") != c.ROLE_ISOLATED).alias("members"),
    )
    assert group.filter("lowest <> first_final OR first_final <> last_final").isEmpty()
    assert group.filter("reps <> CASE WHEN members > 0 THEN 1 ELSE 0 END").isEmpty()


def test_attached_export_equals_the_fused_form(spark):
    records = fixtures.records(spark)
    annotated = cw.annotate(records)
    attached = cw.attach_crosswalk(records, cw.crosswalk(annotated))
    assert rows_of(attached) == rows_of(annotated.select(attached.columns))


def test_probe_lists_every_hot_key(spark):
    many = spark.range(300 * 20).select((F.col("id") % 300).cast("string").alias("k"))
    assert hot_keys(many, {"k": F.col("k")}, Skew(rows_per_task=15))["k"].count() == 300
    rare = spark.range(400_000).select(F.concat(F.lit("r"), "id").alias("k"))
    hot = spark.range(40 * 200).select((F.col("id") % 40).cast("string").alias("k"))
    assert set(listed(hot_keys(rare.union(hot), {"k": F.col("k")}, Skew(rows_per_task=150))["k"])) >= {str(n) for n in range(40)}


def test_repeated_ids_take_the_general_path(spark):
    rows = [("I1", c.WAZE, None, "f", "UNICO", None), ("I1", "SEJUSP", None, "f", "POSSIVEL", None)]
    rows += [("I2", c.WAZE, None, "f", "UNICO", None)]
    width = len(random_records(1)[0])
    records = fixtures.records(spark, [row + (None,) * (width - len(row)) for row in rows][:0] + [
        (r[0], r[1], *random_records(1)[0][2:]) for r in rows
    ])
    records = records.withColumn("id_original_fonte", F.lit(None).cast("string")).withColumn(
        "flag_duplicidade", F.lit("POSSIVEL")
    )
    profile = cw.profile_records(records)
    assert not profile.own_keys_apart
    assert rows_of(cw.annotate(records, profile)) == rows_of(cw.annotate(records))
