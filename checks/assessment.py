"""Participant tables derived from the order and event tables.

A cohort database is not public, so a cohort of the same shape is derived from
the driver tables: customers and users are the participants, orders are
visits, order lines are interview answers and diagnoses, events are answers to
the online questionnaires. The field numbers are those the phenotype catalogue
reads; the formulas only spread the answers over their value ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitweave.functions.naming import EID, field_column
from traitweave.functions.scores import MISSING_CODE

# Most illnesses told, and the three codes of dependency; diagnoses with and without dots, of other chapters, and the
# codes of old external causes. All spread by part and supplier.
TOLD = (
    "CASE WHEN l_partkey % 20 = 7 THEN CASE l_suppkey % 3 WHEN 0 THEN 785 WHEN 1 THEN 48 ELSE 53 END"
    " ELSE 1270 + l_partkey % 400 END"
)
ICD10 = (
    "CASE WHEN l_suppkey % 16 <> 3 AND l_suppkey % 4 <> 2 THEN concat('F', CAST(l_partkey % 510 AS STRING))"
    " WHEN l_suppkey % 4 = 2 THEN concat('F', CAST(10 + l_partkey % 35 AS STRING), '.', CAST(CAST(floor(l_partkey / 35) AS BIGINT) % 10 AS STRING))"
    " WHEN l_partkey % 7 = 0 THEN concat('Y', CAST(1 + l_partkey % 3 AS STRING))"
    " WHEN l_partkey % 7 = 1 THEN 'Z915'"
    " ELSE concat(substring('XYZ', CAST(1 + l_partkey % 3 AS INT), 1), CAST(60 + CAST(floor(l_partkey / 3) AS BIGINT) % 25 AS STRING)) END"
)
ICD9 = (
    "CASE WHEN l_partkey % 104 = 0 THEN concat('E95', CAST(l_suppkey % 10 AS STRING))"
    " WHEN l_partkey % 13 = 1 THEN concat('295', CAST(l_suppkey % 10 AS STRING))"
    " WHEN l_partkey % 13 = 2 THEN '295F4'"
    " ELSE CAST(3000 + l_suppkey % 100 AS STRING) END"
)
VISITS = range(4)
MULTI_ANSWER_ELEMENTS = range(4)
INTERVIEW_ELEMENTS = range(7)

# The online items in order, as (fields, lowest answer, number of answers, missing code occurs).
ONLINE_ITEMS = [
    (
        [
            20514, 20510, 20517, 20519, 20511, 20507, 20508, 20518, 20513,
            20506, 20509, 20520, 20515, 20516, 20505, 20512,
            20497, 20498, 20495, 20496, 20494,
            20414, 20403, 20416, 20413, 20407, 20412, 20409, 20408,
        ],
        0, 5, True,
    ),
    ([20446, 20441, 20449, 20532, 20435, 20450, 20437, 20406, 20456, 20503, 20480, 20483, 20479], 0, 2, False),
    ([20501, 20502], 0, 2, True),
    ([20411, 20405], 0, 3, True),
    ([20436], 2, 3, False),
    ([20439, 20440], 1, 3, False),
    ([20536], 0, 4, False),
    ([20492], 2, 2, True),
    ([20493], 11, 2, True),
    ([20453], 3, 2, False),
    ([20454], 1, 4, False),
]


def assessment_tables(spark: SparkSession, sf_dir: str, every_act: bool = False) -> dict[str, DataFrame]:
    """The five participant tables over the parquet tables in a directory; ``every_act``: with the acts of all events."""

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    orders, lineitem, events = read("orders"), read("lineitem"), read("events")
    return {
        "asm_touch": touch_screen(orders),
        "asm_interview": interview(orders, lineitem),
        "asm_hospital": hospital(orders, lineitem),
        "asm_online": online(events),
        "asm_online_multi": online_multiple_choice(events, every_act),
    }


def touch_screen(orders: DataFrame) -> DataFrame:
    """Answers per visit; one row per customer."""

    def price(divisor: int) -> str:
        return f"CAST(floor(o_totalprice / {divisor}) AS BIGINT)"

    def sometimes_missing(divisor: int, answer: str) -> str:
        return f"CASE WHEN {price(divisor)} % 9 = 0 THEN {MISSING_CODE} ELSE {answer} END"

    answers = {
        4598: f"{price(1)} % 2",
        4609: f"{price(7)} % 2",
        4620: f"{price(3)} % 4",
        4631: f"{price(11)} % 2",
        2090: f"{price(13)} % 2",
        2100: f"{price(17)} % 2",
        5375: f"{price(5)} % 5",
        5386: f"{price(19)} % 4",
        4642: sometimes_missing(1, f"{price(1)} % 2"),
        4653: f"{price(23)} % 2",
        5663: f"11 + {price(29)} % 3",
        5674: sometimes_missing(31, f"11 + {price(31)} % 2"),
    }
    on_visit = "o_orderkey % 4 = {}"
    is_element = "CAST(floor(o_orderkey / 4) AS BIGINT) % 4 = {}"
    return (
        orders.groupBy(F.col("o_custkey").alias(EID))
        .agg(
            *[
                _largest(on_visit.format(visit), answer, field_column(number, visit))
                for number, answer in answers.items()
                for visit in VISITS
            ],
            *[
                _largest(
                    f"{on_visit.format(visit)} AND {is_element.format(element)}",
                    f"10 + {price(1)} % 5",
                    field_column(6156, visit, element),
                )
                for visit in VISITS
                for element in MULTI_ANSWER_ELEMENTS
            ],
            F.expr(f"max({price(37)} % 4) AS p1200"),
            F.expr(f"max({price(41)} % 13) AS p20127"),
        )
    )


def _largest(condition: str, answer: str, column: str) -> Column:
    return F.expr(f"max(CASE WHEN {condition} THEN {answer} END) AS {column}")


def interview(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Illness codes told on each visit; one row per customer.

    Lines are folded per order before the join, on the side of the scan, so an
    order with very many lines reaches the join as one row.
    """
    per_order = lineitem.groupBy("l_orderkey").agg(
        *[_largest(f"l_linenumber = {m + 1}", TOLD, f"told_{m}") for m in INTERVIEW_ELEMENTS]
    )
    finished = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    return (
        per_order.join(finished, per_order.l_orderkey == finished.o_orderkey)
        .groupBy(F.col("o_custkey").alias(EID))
        .agg(
            *[
                _largest(f"o_orderkey % 4 = {visit}", f"told_{m}", field_column(20002, visit, m))
                for visit in VISITS
                for m in INTERVIEW_ELEMENTS
            ]
        )
    )


def hospital(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Diagnosis codes of both revisions; one row per customer.

    There are some 930 codes of one and 121 of the other, which bounds the arrays.
    Lines go to the join as they are: an order has few that are equal, and dropping
    those before took an exchange of its own and half as much CPU time again. A
    frequent order is split in the join by adaptive execution, and sets are folded
    before the exchange by customer.
    """
    diagnoses = lineitem.filter("l_returnflag = 'R'").selectExpr("l_orderkey", f"{ICD10} AS icd10", f"{ICD9} AS icd9")
    return (
        diagnoses.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias(EID))
        .agg(
            F.expr("collect_set(icd10) AS p41270"),
            F.expr("collect_set(icd9) AS p41271"),
        )
    )


def online(events: DataFrame) -> DataFrame:
    """The latest answer to each online item; one row per user."""
    columns = []
    for fields, lowest, answers, missing in ONLINE_ITEMS:
        for field in fields:
            position = len(columns)
            answer = f"{lowest} + (CAST(floor(value * 10) AS BIGINT) + {position}) % {answers}"
            if missing:
                answer = f"CASE WHEN event_id % 11 = 0 THEN {MISSING_CODE} ELSE {answer} END"
            asked = f"(event_id + {position}) % 30 = 0"
            columns.append(F.expr(f"max_by({answer}, event_id) FILTER (WHERE {asked}) AS {field_column(field)}"))
    return events.groupBy(F.col("user_id").alias(EID)).agg(*columns)


def online_multiple_choice(events: DataFrame, every_act: bool = False) -> DataFrame:
    """Multiple-choice answers; one row per user. At most 23 distinct answers each.

    Acts of self-harm (p20554) are those of each 16th event, or of all with ``every_act``.
    """
    acts_every = 1 if every_act else 16
    return (
        events.filter("event_type = 'signup'")
        .groupBy(F.col("user_id").alias(EID))
        .agg(
            *[
                F.expr(f"collect_set(event_id % {choices}) FILTER (WHERE event_id % {every} = 0) AS {column}")
                for column, choices, every in (("p20544", 23, 1), ("p20554", 9, acts_every), ("p20548", 8, 1))
            ]
        )
    )
