"""Every operator as a query over the participant tables derived from the driver tables.

Each query is a function (spark, directory) -> DataFrame. Scores come out as
BIGINT and arrays as sorted, joined text, so that results compare across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitweave import AnyOf, CodeSet, CohortEngine, EqualsOne, FlagRule, Phenotype, Score, evaluate
from traitweave.functions.arrays import contains_any, has_at_least, intersect_codes
from traitweave.functions.scores import replace_missing_code, total
from traitweave.operators.joins import outer_join
from traitweave.phenotypes import CATALOGUE, STANDARD_RUN, rules
from traitweave.phenotypes.vocabularies import ever_diagnosed, icd9, icd10, interview
from checks.assessment import assessment_tables
from traitweave.sources.catalogue import StoredCatalogue
from traitweave.sources.writers import flat_csv_frame, write_bucketed, write_csv, write_parquet

Query = Callable[[SparkSession, str], DataFrame]

ALL_TABLES = ("asm_touch", "asm_interview", "asm_hospital", "asm_online", "asm_online_multi")


def engine(spark: SparkSession, sf_dir: str, *tables: str, every_act: bool = False) -> CohortEngine:
    found = assessment_tables(spark, sf_dir, every_act)
    return CohortEngine({name: found[name] for name in tables or ALL_TABLES})


def comparable(df: DataFrame) -> DataFrame:
    """The frame in types that both engines have: BIGINT scores, text instead of arrays."""

    def column(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.IntegerType):
            c = c.cast("bigint")
        elif isinstance(field.dataType, T.ArrayType) and field.name.startswith("level_"):
            c = F.array_join(c, ",", "~")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(F.array_sort(c), ",")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def _without_levels(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith("level_")])


def phenotypes(*specs: Phenotype, levels: bool = False, every_act: bool = False, **options) -> Query:
    """The columns the specs create, from a full engine query; ``every_act``: over the acts of all events."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = engine(spark, sf_dir, every_act=every_act).query(*specs, **{"join_mode": "stack", **options})
        return comparable(df if levels else _without_levels(df))

    return run


def over(table: str, columns: Callable[[DataFrame], DataFrame]) -> Query:
    """A DataFrame operator on one packed participant table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        e = engine(spark, sf_dir, table)
        return comparable(columns(e.get_table(*e.catalogue.by_field)))

    return run


# ------------------------------------------------------------------ scans and joins


def field_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engine(spark, sf_dir).scan(5375, 4598, 1200).frames["asm_touch"]


def source_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(engine(spark, sf_dir).get_source_table(CATALOGUE["ptsd"]))


def outer_join_tables(mode: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = engine(spark, sf_dir).get_table(20127, 20544, 20406, 41270, 20002, join_mode=mode)
    return comparable(
        wide.select(
            "eid",
            "p20127",
            F.col("p20544").isNull().alias("no_multi"),
            "p20544",
            "p20406",
            F.when(F.col("p41270").isNotNull(), F.size("p41270")).alias("n_icd10"),
            "p41270",
            "p20002",
            "p20002_i0_a0",
        )
    )


def outer_join_of_some_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Participants with an open order only; the other rows of each table go before the join."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    some = orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("eid"))
    wide = engine(spark, sf_dir).get_table(20127, 20544, 20406, 41270, 20002, only=some)
    return comparable(wide.select("eid", "p20127", "p20544", "p20406", "p41270", "p20002"))


def join_of_any_ids(spark: SparkSession, sf_dir: str, hot_rows: int) -> DataFrame:
    """Orders, events and lines as tables whose ids repeat, are missing or are in one table only.

    Every id of all three has hundreds of combinations, so most are joined in fragments.
    """

    def table(name: str, eid: str, value: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet").selectExpr(f"{eid} AS eid", f"{value}")

    tables = [
        table("orders", "CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END", "o_orderkey % 1000 AS ordered"),
        table("events", "CASE WHEN event_id % 5 <> 0 THEN user_id END", "event_id % 100 AS event"),
        table("supplier", "s_suppkey", "s_nationkey AS nation"),
    ]
    joined = outer_join(tables, hot_rows)
    return joined.groupBy("eid").agg(
        F.count("*").alias("n_rows"),
        F.count("ordered").alias("n_ordered"),
        F.count("event").alias("n_event"),
        F.sum("nation").cast("bigint").alias("nations"),
        F.sum(F.col("ordered") * F.col("event")).cast("bigint").alias("products"),
        F.countDistinct("ordered", "event").alias("n_pairs"),
    )


def array_over_two_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field whose first visits are in one table and the later ones, for some participants only, in another."""
    told = assessment_tables(spark, sf_dir)["asm_interview"]
    early = told.select("eid", *[c for c in told.columns if c.startswith(("p20002_i0", "p20002_i1"))])
    later = told.select("eid", *[c for c in told.columns if c.startswith(("p20002_i2", "p20002_i3"))]).filter("eid % 3 <> 0")
    wide = CohortEngine({"early": early, "later": later}).get_table(20002)
    return comparable(wide.select("eid", "p20002", *[f"p20002_i{i}" for i in range(4)]))


def bucketed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The participant tables written in buckets, read again, and joined without an exchange."""
    run = uuid.uuid4().hex
    tables = {}
    for name, df in assessment_tables(spark, sf_dir).items():
        table = f"{name}_{run}"
        write_bucketed(df, table, buckets=8, path=output_path(spark, table))
        tables[name] = spark.table(table)
    specs = [CATALOGUE["ptsd"], CATALOGUE["neuroticism"]]
    return comparable(CohortEngine(tables, colocated=True).query(*specs, hot_rows=None))


def catalogue_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many participants have a value in each column of some fields, the columns found in a stored catalogue."""
    tables = assessment_tables(spark, sf_dir)
    path = output_path(spark, "catalogue")
    write_parquet(CohortEngine(tables).catalogue.entries(spark), path)
    stored = StoredCatalogue(spark.read.parquet(path))
    scan = CohortEngine(tables, stored).scan(20002, 20127, 20544, 41270)
    parts = []
    for table, frame in scan.frames.items():
        columns = [c for c in frame.columns if c in tables[table].columns and c != "eid"]
        counts = frame.agg(*[F.count(c).alias(c) for c in columns])
        parts.append(counts.unpivot([], columns, "column", "n_present").withColumn("table", F.lit(table)))
    return reduce(DataFrame.union, parts).join(stored.entries, ["table", "column"])


# ------------------------------------------------------------------ evaluation and scores


def evaluate_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = CATALOGUE["ocd"]
    source = engine(spark, sf_dir).get_source_table(spec, join_mode="stack")
    return comparable(evaluate(source, spec).drop(*[c for c in source.columns if c != "eid"]))


def source_columns_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(engine(spark, sf_dir).query(CATALOGUE["ptsd_pcl6"], return_only_created_columns=False))


def level_labels(spark: SparkSession, sf_dir: str, name: str = "bipolar", compact: bool = False) -> DataFrame:
    df = engine(spark, sf_dir).query(CATALOGUE[name], join_mode="stack", compact_levels=compact)
    return comparable(df.select("eid", *[c for c in df.columns if c.startswith("level_")]))


def score_threshold_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    def reaches(score: Column, levels) -> Column:
        return score >= levels[0]

    specs = [
        Score(f"reaches_{k}", fields=[20127], levels=[k], to_flag=reaches, score_name=f"score_{k}") for k in (3, 7, 11)
    ]
    df = _without_levels(engine(spark, sf_dir).query(*specs))
    return comparable(df.withColumnRenamed("score_3", "neuroticism_score").drop("score_7", "score_11"))


def severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = engine(spark, sf_dir).query(CATALOGUE["anxiety_gad7"], severity=True)
    return comparable(df.select("eid", "anxiety_gad7_score", "anxiety_gad7_severity"))


def case_recode(df: DataFrame) -> DataFrame:
    spec = FlagRule(
        "cannabis_known",
        fields=[20453, 20454],
        helpers={"cannabis_use_group": rules.cannabis_use_group},
        rule=lambda scope: scope.column("cannabis_use_group").isNotNull(),
    )
    return evaluate(df, spec).select("eid", "cannabis_use_group")


def custom_rule() -> FlagRule:
    return FlagRule(
        "poor_sleep_or_mania",
        fields=[1200, 20501],
        helpers={"sleep_answer": lambda scope: scope.field(1200)},
        rule=lambda scope: (scope.column("sleep_answer") >= 3) | (scope.field(20501) == 1),
    )


def two_visit_rule() -> FlagRule:
    """Rules over several visits and single cells: mood worse than on the first visit, and the first thing told."""
    return FlagRule(
        "worse_than_at_first",
        fields=[4609, 5375, 6156],
        visits=3,
        helpers={
            "rise": lambda scope: scope.field(5375, visit=scope.visit + 1) - scope.field(5375, visit=0),
            "first_told": lambda scope: scope.field(6156, element=0),
            "told_at_first": lambda scope: scope.any_code(6156, [11, 12], visit=0),
        },
        rule=lambda scope: (scope.column("rise") > 0) | (scope.field(4609, visit=3) == 1),
    )


def recode_per_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of one score recoded differently, and an item that two scores share."""

    def reversed_answer(item: Column) -> Column:
        return F.when(item == -818, 4).otherwise(4 - item)

    first = Score(
        "mixed",
        fields=[20514, 20510, 20517],
        levels=[3, 6],
        recode={20514: reversed_answer, 20510: replace_missing_code},
    )
    second = Score("other", fields=[20514, 20519], levels=[4], recode={20514: reversed_answer, 20519: replace_missing_code})
    return comparable(_without_levels(engine(spark, sf_dir).query(first, second)))


def own_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of thresholds on answers of several tables, as rules of the caller's own."""
    specs = [
        FlagRule("long_hours", fields=[1200], rule=lambda scope: scope.field(1200) >= 2),
        FlagRule("often", fields=[20414], rule=lambda scope: scope.field(20414) > 2),
        FlagRule("either_often", fields=[20127, 20403], rule=lambda scope: (scope.field(20127) >= 9) | (scope.field(20403) >= 4)),
    ]
    return comparable(_without_levels(engine(spark, sf_dir).query(*specs)))


def own_case_recode(df: DataFrame) -> DataFrame:
    """Answers in words of the caller's own, the missing code apart from null."""
    group = lambda scope: (
        F.when(scope.field(20414) == -818, "not said").when(scope.field(20414) < 2, "seldom").when(scope.field(20414) < 4, "often")
    )
    spec = FlagRule("said", fields=[20414], helpers={"how_often": group}, rule=lambda scope: scope.column("how_often") != "not said")
    return evaluate(df, spec).select("eid", "how_often", "said")


# ------------------------------------------------------------------ sinks


def output_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share; in local mode without one, below the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = output_path(spark, "result")
    write_parquet(engine(spark, sf_dir).query(CATALOGUE["ptsd"], join_mode="stack"), path)
    return comparable(spark.read.parquet(path))


def write_result_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = output_path(spark, "result-csv")
    df = engine(spark, sf_dir).query(CATALOGUE["ptsd"], join_mode="stack")
    write_csv(df, path, arrays="joined", separator=",", null_text="~")
    schema = flat_csv_frame(df, arrays="joined").schema
    return comparable(spark.read.csv(path, header=True, schema=schema, nullValue="\u0000", emptyValue=""))


def registered() -> dict[str, Query]:
    either = AnyOf("either", children=[CATALOGUE["alcohol_addiction"], CATALOGUE["touch_screen_insomnia"]])
    mental_codes = ["3000", "3003", "3004", "3040"]
    found: dict[str, Query] = {
        "field_scan": field_scan,
        "source_table": source_table,
        "outer_join_tables": partial(outer_join_tables, "outer"),
        "outer_join_tables_stacked": partial(outer_join_tables, "stack"),
        "outer_join_of_some_ids": outer_join_of_some_ids,
        "join_of_any_ids": partial(join_of_any_ids, hot_rows=200),
        "join_of_any_ids_counted": partial(join_of_any_ids, hot_rows=1_000_000),
        "array_over_two_tables": array_over_two_tables,
        "bucketed_round_trip": bucketed_round_trip,
        "catalogue_lookup": catalogue_lookup,
        "two_visit_rule": phenotypes(two_visit_rule()),
        "recode_per_field": recode_per_field,
        "own_threshold": own_threshold,
        "own_case_recode": over("asm_online", own_case_recode),
        "pack_instance_array": over("asm_interview", lambda df: df.select("eid", *[f"p20002_i{i}" for i in range(4)])),
        "merge_instances_array": over("asm_interview", lambda df: df.select("eid", "p20002")),
        "contains_any": over(
            "asm_hospital",
            lambda df: df.select("eid", contains_any(F.col("p41270"), ["F401", "F411", "F431"]).alias("found")),
        ),
        "intersect_codes": over(
            "asm_hospital",
            lambda df: intersect_codes(df, "p41271", mental_codes, "mental").drop("p41270", "p41271"),
        ),
        "array_count_at_least": over(
            "asm_online_multi", lambda df: df.select("eid", has_at_least(F.col("p20548"), 4).alias("many"))
        ),
        "equals_one_flag": phenotypes(EqualsOne("alcohol_addiction", fields=[20406])),
        "threshold_flag": phenotypes(CATALOGUE["touch_screen_insomnia"]),
        "in_list_flag": phenotypes(
            FlagRule("most_of_day", fields=[20436], rule=lambda scope: scope.field(20436).isin(3, 4))
        ),
        "any_of": phenotypes(either),
        "custom_rule": phenotypes(custom_rule()),
        "created_columns_only": phenotypes(CATALOGUE["ptsd_pcl6"], levels=True),
        "source_columns_kept": source_columns_kept,
        "case_recode": over("asm_online", case_recode),
        "evaluate_tree": evaluate_tree,
        "query_phenotypes": phenotypes(CATALOGUE["ptsd"], CATALOGUE["neuroticism"], levels=True, join_mode="outer"),
        "instance_expansion": phenotypes(interview("depression", [1278, 1279, 1280])),
        "code_set_flag": phenotypes(CodeSet("acts", fields=[20554], codes=[1, 3]), every_act=True),
        "icd9_flag": phenotypes(icd9("anxiety", ["3000", "3001", "3002", "3009", "300"])),
        "icd10_flag": phenotypes(icd10("ptsd", ["F431"])),
        "interview_flag": phenotypes(interview("ptsd", [1469])),
        "ever_diagnosed_flag": phenotypes(ever_diagnosed("anxiety", [1, 6, 17])),
        "level_labels": level_labels,
        "level_labels_compact": partial(level_labels, name="anxiety", compact=True),
        "normalized_codes": phenotypes(CATALOGUE["icd10_ocd"], CATALOGUE["icd10_depression"], normalize_codes=True),
        "replace_missing_code": over(
            "asm_online",
            lambda df: df.select(
                "eid", *[replace_missing_code(F.col(c)).alias(c) for c in ("p20501", "p20493", "p20411")]
            ),
        ),
        "sum_score": over(
            "asm_online",
            lambda df: df.select(
                "eid",
                total([replace_missing_code(F.col(f"p{f}")) for f in CATALOGUE["anxiety_gad7"].fields]).alias("total"),
            ),
        ),
        "score_threshold_flag": score_threshold_flag,
        "severity_band": severity,
        "scored_phenotype": phenotypes(CATALOGUE["phq9_depression"]),
        "scored_instances": phenotypes(CATALOGUE["probable_depression"]),
        "audit_score": phenotypes(CATALOGUE["audit_score"]),
        "probable_depression": phenotypes(CATALOGUE["probable_depression"], severity=True),
        "lifetime_depression": phenotypes(CATALOGUE["lifetime_depression"]),
        "probable_bipolar": phenotypes(CATALOGUE["probable_bipolar"]),
        "life_time_bipolar": phenotypes(CATALOGUE["life_time_bipolar"]),
        "cannabis_use_group": over("asm_online", case_recode),
        "substance_use_questionnaire": phenotypes(CATALOGUE["questionnaire_substance_abuse_non_alcoholic"]),
        "self_harm_questionnaire": phenotypes(CATALOGUE["questionnaire_self_harm"], every_act=True),
        "insomnia_touch_screen": phenotypes(CATALOGUE["touch_screen_insomnia"]),
        "neuroticism": phenotypes(CATALOGUE["neuroticism"]),
        "flagship": phenotypes(*STANDARD_RUN, levels=True),
        "flagship_outer": phenotypes(*STANDARD_RUN, levels=True, join_mode="outer"),
        "write_result": write_result,
        "write_result_csv": write_result_csv,
    }
    for name in (
        "eating_disorder schizophrenia ocd anxiety depression bipolar ptsd self_harm"
        " substance_abuse_non_alcoholic alcohol_abuse insomnia"
    ).split():
        found[name] = phenotypes(CATALOGUE[name], levels=True)
    return found
