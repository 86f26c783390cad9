"""What every registered query must return, as SQL over the driver tables.

Written apart from the library: nothing is imported from it, so code lists,
cut-offs and formulas are stated here a second time.
"""

from __future__ import annotations

VISITS = range(4)

# ------------------------------------------------------------------ participant tables


def _v(n: int) -> str:
    return f"cast(floor(o_totalprice / {n}) as bigint)"


def _touch() -> str:
    visit_items = {
        4598: f"{_v(1)} % 2",
        4609: f"{_v(7)} % 2",
        4620: f"{_v(3)} % 4",
        4631: f"{_v(11)} % 2",
        2090: f"{_v(13)} % 2",
        2100: f"{_v(17)} % 2",
        5375: f"{_v(5)} % 5",
        5386: f"{_v(19)} % 4",
        4642: f"case when {_v(1)} % 9 = 0 then -818 else {_v(1)} % 2 end",
        4653: f"{_v(23)} % 2",
        5663: f"11 + {_v(29)} % 3",
        5674: f"case when {_v(31)} % 9 = 0 then -818 else 11 + {_v(31)} % 2 end",
    }
    columns = [
        f"max(case when o_orderkey % 4 = {i} then {e} end) as p{f}_i{i}" for f, e in visit_items.items() for i in VISITS
    ]
    cells = [
        f"max(case when o_orderkey % 4 = {i} and cast(floor(o_orderkey / 4) as bigint) % 4 = {m}"
        f" then 10 + {_v(1)} % 5 end) as p6156_i{i}_a{m}"
        for i in VISITS
        for m in range(4)
    ]
    single = [f"max({_v(37)} % 4) as p1200", f"max({_v(41)} % 13) as p20127"]
    packed = [f"list_distinct([{', '.join(f'p6156_i{i}_a{m}' for m in range(4))}]) as p6156_i{i}" for i in VISITS]
    return (
        f"select *, {', '.join(packed)} from (select o_custkey as eid, {', '.join(columns + cells + single)}"
        " from orders group by o_custkey)"
    )


def _interview() -> str:
    cells = [
        f"max(case when o_orderkey % 4 = {i} and l_linenumber = {m + 1} then case when l_partkey % 20 <> 7"
        " then 1270 + l_partkey % 400 else list_extract([785, 48, 53], 1 + l_suppkey % 3) end end)"
        f" as p20002_i{i}_a{m}"
        for i in VISITS
        for m in range(7)
    ]
    packed = [f"list_distinct([{', '.join(f'p20002_i{i}_a{m}' for m in range(7))}]) as p20002_i{i}" for i in VISITS]
    every = ", ".join(f"p20002_i{i}_a{m}" for i in VISITS for m in range(7))
    return (
        f"select *, {', '.join(packed)}, list_distinct([{every}]) as p20002 from (select o_custkey as eid,"
        f" {', '.join(cells)} from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'F'"
        " group by o_custkey)"
    )


def _hospital() -> str:
    return (
        "select o_custkey as eid, list(distinct case"
        " when l_suppkey % 16 <> 3 and l_suppkey % 4 <> 2 then 'F' || l_partkey % 510"
        " when l_suppkey % 4 = 2 then 'F' || (10 + l_partkey % 35) || '.' || (l_partkey // 35) % 10"
        " when l_partkey % 7 = 0 then 'Y' || (1 + l_partkey % 3)"
        " when l_partkey % 7 = 1 then 'Z915'"
        " else list_extract(['X', 'Y', 'Z'], 1 + l_partkey % 3) || (60 + (l_partkey // 3) % 25) end) as p41270,"
        " list(distinct case when l_partkey % 104 = 0 then 'E95' || l_suppkey % 10"
        " when l_partkey % 13 = 1 then '295' || l_suppkey % 10 when l_partkey % 13 = 2 then '295F4'"
        " else cast(3000 + l_suppkey % 100 as varchar) end) as p41271"
        " from lineitem join orders on l_orderkey = o_orderkey where l_returnflag = 'R' group by o_custkey"
    )


_ONLINE = (
    [
        (f, 0, 5, True)
        for f in (
            20514, 20510, 20517, 20519, 20511, 20507, 20508, 20518, 20513, 20506, 20509, 20520, 20515, 20516, 20505,
            20512, 20497, 20498, 20495, 20496, 20494, 20414, 20403, 20416, 20413, 20407, 20412, 20409, 20408,
        )
    ]
    + [
        (f, 0, 2, False)
        for f in (20446, 20441, 20449, 20532, 20435, 20450, 20437, 20406, 20456, 20503, 20480, 20483, 20479)
    ]
    + [(20501, 0, 2, True), (20502, 0, 2, True), (20411, 0, 3, True), (20405, 0, 3, True), (20436, 2, 3, False)]
    + [(20439, 1, 3, False), (20440, 1, 3, False), (20536, 0, 4, False), (20492, 2, 2, True), (20493, 11, 2, True)]
    + [(20453, 3, 2, False), (20454, 1, 4, False)]
)


def _online() -> str:
    columns = []
    for k, (field, lo, n, missing) in enumerate(_ONLINE):
        value = f"{lo} + (cast(floor(value * 10) as bigint) + {k}) % {n}"
        if missing:
            value = f"case when event_id % 11 = 0 then -818 else {value} end"
        columns.append(f"max_by({value}, event_id) filter (where (event_id + {k}) % 30 = 0) as p{field}")
    return f"select user_id as eid, {', '.join(columns)} from events group by user_id"


def _online_multi(
    acts: str = "coalesce(list(distinct event_id % 9) filter (where event_id % 16 = 0), [])"
) -> str:
    return (
        "select user_id as eid, list(distinct event_id % 23) as p20544,"
        f" {acts} as p20554,"
        " list(distinct event_id % 8) as p20548 from events where event_type = 'signup'"
        " group by user_id"
    )


def _online_multi_whole() -> str:
    """The acts of all events."""
    return _online_multi("list(distinct event_id % 9)")


_TABLES = {
    "touch": _touch,
    "interview": _interview,
    "hospital": _hospital,
    "online": _online,
    "online_multi": _online_multi,
    "online_multi_whole": _online_multi_whole,
}


def over(tables: str, body: str) -> str:
    """The body over the named participant tables; ``cohort`` is their full outer join."""
    names = tables.split()
    ctes = [f"{n} as ({_TABLES[n]()})" for n in names]
    joined = names[0] + "".join(f" full join {n} using (eid)" for n in names[1:])
    ctes.append(f"cohort as (select * from {joined})")
    return f"with {', '.join(ctes)}{'' if body.startswith(',') else ' '}{body}"


ALL = "touch interview hospital online online_multi"

# ------------------------------------------------------------------ phenotype expressions


def _codes(column: str, codes: str, text: bool = True) -> str:
    listed = ", ".join(f"'{c}'" if text else c for c in codes.split())
    return f"list_has_any({column}, [{listed}])"


def _code_leaves(condition: str, icd9="", icd10="", interview="", ever="") -> dict[str, str]:
    leaves = {}
    if icd9:
        leaves[f"icd9_{condition}"] = _codes("p41271", icd9)
    if icd10:
        leaves[f"icd10_{condition}"] = _codes("p41270", icd10)
    if interview:
        name = f"verbal_interview_{condition}"
        for i in VISITS:
            leaves[f"{name}_{i}"] = _codes(f"p20002_i{i}", interview, text=False)
        leaves[name] = " or ".join(f"{name}_{i}" for i in VISITS)
    if ever:
        leaves[f"ever_diag_{condition}"] = _codes("p20544", ever, text=False)
    return leaves


def _item(field: int | str) -> str:
    return f"(case when p{field} = -818 then 0 else p{field} end)"


def _score(name: str, fields: str, level: int) -> dict[str, str]:
    return {f"{name}_score": " + ".join(_item(f) for f in fields.split()), name: f"{name}_score >= {level}"}


def _probable_depression() -> dict[str, str]:
    out = {}
    for i in VISITS:
        p = {f: f"p{f}_i{i}" for f in (4598, 4609, 4620, 2090, 2100, 4631, 5375, 5386)}
        long = (
            f"(({p[4598]} = 1 and {p[4609]} = 1 and {p[4620]} >= 2)"
            f" or ({p[4631]} = 1 and {p[5386]} >= 2 and {p[5375]} > 2))"
        )
        out[f"probable_depression_score_{i}"] = (
            f"case when ({p[4598]} = 1 and {p[4609]} = 1 and {p[4620]} = 1 and ({p[2090]} = 1 or {p[2100]} = 1))"
            f" or ({p[4631]} = 1 and {p[5386]} = 1 and {p[5375]} >= 2) then 1"
            f" when {long} and {p[2090]} = 1 and not ({p[2100]} = 1) then 2"
            f" when {long} and {p[2100]} = 1 then 3 else 0 end"
        )
        out[f"probable_depression_{i}"] = f"probable_depression_score_{i} >= 1"
    out["probable_depression"] = " or ".join(f"probable_depression_{i}" for i in VISITS)
    return out


def _probable_bipolar() -> dict[str, str]:
    out = {}
    for i in VISITS:
        out[f"probable_bipolar_score_{i}"] = (
            f"(case when ({_item(f'4642_i{i}')} = 1 or {_item(f'4653_i{i}')} = 1) and len(p6156_i{i}) >= 3"
            f" and {_item(f'5663_i{i}')} = 13 then 1 else 0 end) + cast({_item(f'5674_i{i}')} = 12 as bigint)"
        )
        out[f"probable_bipolar_{i}"] = f"probable_bipolar_score_{i} >= 1"
    out["probable_bipolar"] = " or ".join(f"probable_bipolar_{i}" for i in VISITS)
    return out


_LIFETIME_DEPRESSION = {
    "lifetime_depression": "(p20446 = 1 or p20441 = 1) and p20436 in (3, 4) and p20439 in (2, 3) and p20440 in (2, 3)"
    " and cast(p20446 = 1 as int) + cast(p20441 = 1 as int) + cast(p20449 = 1 as int)"
    " + cast(p20536 in (1, 2, 3) as int) + cast(p20532 = 1 as int) + cast(p20435 = 1 as int)"
    " + cast(p20450 = 1 as int) + cast(p20437 = 1 as int) >= 5"
}
_LIFE_TIME_BIPOLAR = {
    "life_time_bipolar_score": f"(case when depression and ({_item(20501)} = 1 or {_item(20502)} = 1)"
    f" and len(p20548) >= 4 and {_item(20492)} = 3 then 1 else 0 end) + cast({_item(20493)} = 12 as bigint)",
    "life_time_bipolar": "life_time_bipolar_score >= 1",
}
_CANNABIS = {
    "cannabis_use_group": "case when p20453 = 0 then 0 when p20453 = 1 or p20453 = 2 then 1 when p20453 = 3 then 2"
    " when p20453 = 4 and p20454 = 1 then 3 when p20453 = 4 and p20454 = 2 then 4"
    " when p20453 = 4 and p20454 = 3 then 5 when p20453 = 4 and p20454 = 4 then 6 end"
}
_SUBSTANCE_QUESTIONNAIRE = _CANNABIS | {
    "questionnaire_substance_abuse_non_alcoholic": "list_has_any(p20002, [785, 48, 53]) or p20456 = 1 or p20503 = 1"
    " or cannabis_use_group = 6"
}
_SELF_HARM_QUESTIONNAIRE = {
    "questionnaire_self_harm": "p20480 = 1 or p20479 = 1 or list_has_any(p20554, [1, 3, 4, 5, 6]) or p20483 = 1"
}
_AUDIT = {
    "audit_score_score": " + ".join(
        f"({_item(f)} - 1)" for f in (20414, 20403, 20416, 20413, 20407, 20412, 20409, 20408)
    )
    + "".join(f" + (case when p{f} = 2 then 4 when p{f} = 1 then 2 else 0 end)" for f in (20411, 20405)),
    "audit_score": "audit_score_score >= 15",
}
_GAD7 = _score("anxiety_gad7", "20506 20509 20520 20515 20516 20505 20512", 15)
_PHQ9 = _score("phq9_depression", "20514 20510 20517 20519 20511 20507 20508 20518 20513", 20)
_PCL6 = _score("ptsd_pcl6", "20497 20498 20495 20496 20494 20508", 8)
_NEUROTICISM = _score("neuroticism", "20127", 11)
_INSOMNIA_TOUCH = {"touch_screen_insomnia": "p1200 >= 2"}

_EATING = _code_leaves(
    "eating_disorder",
    "3071 3075 30750 30751 30752 30753 30754 30755 30759",
    "F500 F501 F502 F503 F508 F509",
    "1470",
    "13 12 16",
)
_SCHIZOPHRENIA = _code_leaves(
    "schizophrenia",
    "2950 2951 2952 2953 295F4 2955 2956 2957 2958 2959",
    "F20.0 F20.1 F20.2 F20.3 F20.4 F20.5 F20.6 F20.8 F20.9 F21 F22.0 F22.8 F22.9 F23.0 F23.1 F23.2 F23.3 F23.8"
    " F23.9 F24 F25.0 F25.1 F25.2 F25.8 F25.9 F28 F29",
    "1289",
    "2",
)
_OCD = _code_leaves("ocd", "3003", "F42.0 F42.1 F42.2 F42.8 F42.9", "1615", "7")
_ANXIETY = _code_leaves(
    "anxiety",
    "3000 3001 3002 3009 300",
    "F064 F93.0 F931 F932 F40 F400 F401 F402 F408 F409 F41 F410 F411 F412 F413 F418 F419",
    "1287 1614",
    "1 6 17",
)
_DEPRESSION_CODES = _code_leaves(
    "depression",
    "3119 3004",
    "F32.0 F32.1 F32.2 F32.3 F32.8 F32.9",
    "1278 1279 1280 1281 1282 1283 1284 1285 1286",
    "11",
)
_PTSD = _code_leaves("ptsd", icd10="F431", interview="1469")
_SELF_HARM = _code_leaves(
    "self_harm",
    "E950 E951 E952 E953 E954 E955 E956 E957 E958 E959",
    "X60 X61 X62 X63 X64 X65 X66 X67 X68 X69 X70 X71 X72 X73 X74 X75 X76 X77 X78 X79 X80 X81 X82 X83 X84"
    " Z915 Y1 Y2 Y3",
    "1290",
)
_SUBSTANCE = _code_leaves(
    "substance_abuse_non_alcoholic",
    "3040",
    "F11.1 F11.2 F11.3 F11.4 F12.1 F12.2 F12.3 F12.4 F13.1 F13.2 F13.3 F13.4 F14.1 F14.2 F14.3 F14.4"
    " F19.1 F19.2 F19.3 F19.4",
    "1409 1410",
    "8",
)
_ALCOHOL = {"alcohol_addiction": "p20406 = 1"} | _code_leaves(
    "alcohol_abuse", "3039", "F10.1 F10.2 F10.3 F10.4", "1408"
)
_INSOMNIA = _code_leaves("insomnia", interview="1616") | _INSOMNIA_TOUCH


def _any(name: str, *children: str) -> dict[str, str]:
    return {name: " or ".join(children)}


def _four(condition: str) -> list[str]:
    return [f"{v}_{condition}" for v in ("icd9", "icd10", "verbal_interview", "ever_diag")]


#: Children of each composite, in order.
CHILDREN = {
    "eating_disorder": _four("eating_disorder"),
    "schizophrenia": _four("schizophrenia"),
    "ocd": _four("ocd"),
    "anxiety": ["anxiety_gad7", *_four("anxiety")],
    "depression": ["lifetime_depression", "probable_depression", "phq9_depression", *_four("depression")],
    "life_time_bipolar": ["depression"],
    "bipolar": ["life_time_bipolar", "probable_bipolar"],
    "ptsd": ["icd10_ptsd", "verbal_interview_ptsd", "ptsd_pcl6"],
    "self_harm": ["questionnaire_self_harm", *_four("self_harm")[:3]],
    "substance_abuse_non_alcoholic": [
        "questionnaire_substance_abuse_non_alcoholic",
        "icd10_substance_abuse_non_alcoholic",
        "icd9_substance_abuse_non_alcoholic",
        "verbal_interview_substance_abuse_non_alcoholic",
        "ever_diag_substance_abuse_non_alcoholic",
    ],
    "alcohol_abuse": ["audit_score", "alcohol_addiction", *_four("alcohol_abuse")[:3]],
    "insomnia": ["verbal_interview_insomnia", "touch_screen_insomnia"],
}

_DEPRESSION = (
    _LIFETIME_DEPRESSION
    | _probable_depression()
    | _PHQ9
    | _DEPRESSION_CODES
    | _any("depression", *CHILDREN["depression"])
)
#: Everything each composite creates besides itself, with what that needs.
COMPOSITES = {
    "eating_disorder": _EATING,
    "schizophrenia": _SCHIZOPHRENIA,
    "ocd": _OCD,
    "anxiety": _GAD7 | _ANXIETY,
    "depression": {k: v for k, v in _DEPRESSION.items() if k != "depression"},
    "bipolar": _DEPRESSION | _LIFE_TIME_BIPOLAR | _probable_bipolar(),
    "ptsd": _PTSD | _PCL6,
    "self_harm": _SELF_HARM_QUESTIONNAIRE | _SELF_HARM,
    "substance_abuse_non_alcoholic": _SUBSTANCE_QUESTIONNAIRE | _SUBSTANCE,
    "alcohol_abuse": _AUDIT | _ALCOHOL,
    "insomnia": _INSOMNIA,
}
#: Tables that hold the fields of each composite.
TABLES = {
    "eating_disorder": "hospital interview online_multi",
    "schizophrenia": "hospital interview online_multi",
    "ocd": "hospital interview online_multi",
    "anxiety": "hospital interview online online_multi",
    "depression": ALL,
    "bipolar": ALL,
    "ptsd": "hospital interview online",
    "self_harm": ALL.replace("touch ", ""),
    "substance_abuse_non_alcoholic": ALL.replace("touch ", ""),
    "alcohol_abuse": "hospital interview online",
    "insomnia": "interview touch",
}
STANDARD_RUN = (
    "self_harm eating_disorder depression bipolar anxiety alcohol_abuse substance_abuse_non_alcoholic schizophrenia"
    " ptsd ocd"
).split()


def _labels(names: list[str], compact: bool = False) -> str:
    """The true names in order, '~' for the others at the place of the first of them."""
    marks = f"[{', '.join(f'''case when {n} then '{n}' else '~' end''' for n in names)}]"
    if compact:
        return f"array_to_string(list_filter({marks}, lambda x: x <> '~'), ',')"
    return (
        f"array_to_string(list_filter({marks}, lambda x, i: x <> '~' or i = list_position({marks}, '~')), ',')"
    )


def _levels(requested: list[str], compact: bool = False) -> list[str]:
    columns, names = [], requested
    while names:
        columns.append(f"{_labels(names, compact)} as level_{len(columns)}_derived_phenotypes")
        names = [c for n in names for c in CHILDREN.get(n, [])]
    return columns


def phenotypes(tables: str, steps: dict[str, str], extra: list[str] = (), hide: str = "", more: str = "") -> str:
    """SQL that creates the columns one after the other, then what builds on all of them."""
    columns = ", ".join(f"({e}) as {n}" for n, e in steps.items())
    kept = ["eid", *[n for n in steps if n not in hide.split()], *more.split(), *extra]
    return over(tables, f", flags as (select *, {columns} from cohort) select {', '.join(kept)} from flags")


def composite(name: str, compact: bool = False, levels: bool = False) -> str:
    steps = COMPOSITES[name] | _any(name, *CHILDREN[name])
    return phenotypes(TABLES[name], steps, _levels([name], compact) if levels else [])


def flagship() -> str:
    steps: dict[str, str] = {}
    for name in STANDARD_RUN:
        steps |= COMPOSITES[name] | _any(name, *CHILDREN[name])
    return phenotypes(ALL, steps, _levels(STANDARD_RUN))


def _joined(column: str) -> str:
    return f"array_to_string(list_sort({column}), ',') as {column}"


def _plain(name: str) -> str:
    return f"list_transform(p41270, lambda x: replace(x, '.', '')) as {name}"


def oracle_sql() -> dict[str, str]:
    gad7_bands = (
        "case when anxiety_gad7_score < 5 then 'Low' when anxiety_gad7_score < 10 then 'Mild'"
        " when anxiety_gad7_score < 15 then 'Moderate' when anxiety_gad7_score >= 15 then 'Severe' end"
    )
    touch_items = [f"p{f}_i{i}" for f in (4598, 5375) for i in VISITS]
    ptsd_items = "p20494 p20495 p20496 p20497 p20498 p20508".split()
    cells = [f"p20002_i{i}_a{m}" for i in VISITS for m in range(7)]
    ptsd_source = ["eid", *ptsd_items, *cells, *[_joined(f"p20002_i{i}") for i in VISITS]] + [
        _joined("p20002"),
        _joined("p41270"),
    ]
    bipolar = COMPOSITES["bipolar"]
    normalised = {
        k: v.replace("p41270", "plain").replace(".", "") for k, v in _OCD.items() if k.startswith("icd10")
    } | {k: v.replace("p41270", "plain").replace(".", "") for k, v in _DEPRESSION_CODES.items() if "icd10" in k}
    join_check = (
        f"select eid, p20127, p20544 is null as no_multi, {_joined('p20544')}, p20406, len(p41270) as n_icd10,"
        f" {_joined('p41270')}, {_joined('p20002')}, p20002_i0_a0 from cohort"
    )
    some_ids = (
        f"select eid, p20127, {_joined('p20544')}, p20406, {_joined('p41270')}, {_joined('p20002')} from cohort"
        " where eid in (select o_custkey from orders where o_orderstatus = 'P')"
    )
    any_ids = (
        "with o as (select case when o_orderkey % 7 <> 0 then o_custkey end as eid, o_orderkey % 1000 as ordered from orders),"
        " e as (select case when event_id % 5 <> 0 then user_id end as eid, event_id % 100 as event from events),"
        " s as (select s_suppkey as eid, s_nationkey as nation from supplier),"
        " j as (select * from o full join e using (eid) full join s using (eid))"
        " select eid, count(*) as n_rows, count(ordered) as n_ordered, count(event) as n_event,"
        " cast(sum(nation) as bigint) as nations, cast(sum(ordered * event) as bigint) as products,"
        " count(distinct case when ordered is not null and event is not null then ordered * 1000 + event end) as n_pairs"
        " from j group by eid"
    )
    later_cells = ", ".join(
        f"case when eid % 3 <> 0 then p20002_i{i}_a{m} end as p20002_i{i}_a{m}" for i in (2, 3) for m in range(7)
    )
    every_cell = [f"p20002_i{i}_a{m}" for i in VISITS for m in range(7)]
    two_tables = (
        f"select eid, array_to_string(list_sort(list_distinct([{', '.join(every_cell)}])), ',') as p20002, "
        + ", ".join(f"array_to_string(list_sort(p20002_i{i}), ',') as p20002_i{i}" for i in (0, 1))
        + ", "
        + ", ".join(
            f"case when eid % 3 <> 0 then array_to_string(list_sort(p20002_i{i}), ',') end as p20002_i{i}" for i in (2, 3)
        )
        + f" from (select * replace ({later_cells}) from interview)"
    )
    listed = [
        *(("asm_interview", f"p20002_i{i}_a{m}", 20002, i, m) for i in VISITS for m in range(7)),
        ("asm_touch", "p20127", 20127, "null", "null"),
        ("asm_online_multi", "p20544", 20544, "null", "null"),
        ("asm_hospital", "p41270", 41270, "null", "null"),
    ]
    lookup = " union all ".join(
        f"select '{table}' as \"table\", '{column}' as \"column\", {field} as field, cast({visit} as integer) as instance,"
        f" cast({element} as integer) as element, count({column}) as n_present from {table.removeprefix('asm_')}"
        for table, column, field, visit, element in listed
    )
    two_visits = {}
    for i in range(3):
        two_visits[f"rise_{i}"] = f"p5375_i{i + 1} - p5375_i0"
        two_visits[f"first_told_{i}"] = f"p6156_i{i}_a0"
        two_visits[f"told_at_first_{i}"] = "list_has_any(p6156_i0, [11, 12])"
        two_visits[f"worse_than_at_first_{i}"] = f"rise_{i} > 0 or p4609_i3 = 1"
    two_visits["worse_than_at_first"] = " or ".join(f"worse_than_at_first_{i}" for i in range(3))
    reverse = "case when p20514 = -818 then 4 else 4 - p20514 end"

    def zero(column: str) -> str:
        return f"case when {column} = -818 then 0 else {column} end"

    mixed = {
        "mixed_score": f"{reverse} + {zero('p20510')} + p20517",
        "mixed": "mixed_score >= 6",
        "other_score": f"{reverse} + {zero('p20519')}",
        "other": "other_score >= 4",
    }
    thresholds = {
        "long_hours": "p1200 >= 2",
        "often": "p20414 > 2",
        "either_often": "p20127 >= 9 or p20403 >= 4",
    }
    how_often = {
        "how_often": "case when p20414 = -818 then 'not said' when p20414 < 2 then 'seldom' when p20414 < 4 then 'often' end",
        "said": "how_often <> 'not said'",
    }
    sql = {
        # scans and joins
        "field_scan": over("touch", f"select eid, p1200, {', '.join(touch_items)} from touch"),
        "source_table": over("hospital interview online", f"select {', '.join(ptsd_source)} from cohort"),
        "outer_join_tables": over(ALL, join_check),
        "outer_join_tables_stacked": over(ALL, join_check),
        "outer_join_of_some_ids": over(ALL, some_ids),
        "join_of_any_ids": any_ids,
        "join_of_any_ids_counted": any_ids,
        "array_over_two_tables": over("interview", two_tables),
        "bucketed_round_trip": phenotypes(
            "hospital interview online touch",
            COMPOSITES["ptsd"] | _any("ptsd", *CHILDREN["ptsd"]) | _NEUROTICISM,
            _levels(["ptsd", "neuroticism"]),
        ),
        "catalogue_lookup": over("touch interview hospital online_multi", lookup),
        "two_visit_rule": phenotypes("touch", two_visits),
        "recode_per_field": phenotypes("online", mixed),
        "own_threshold": phenotypes("touch online", thresholds),
        "own_case_recode": phenotypes("online", how_often),
        # arrays
        "pack_instance_array": over(
            "interview", f"select eid, {', '.join(_joined(f'p20002_i{i}') for i in VISITS)} from interview"
        ),
        "merge_instances_array": over("interview", f"select eid, {_joined('p20002')} from interview"),
        "contains_any": over("hospital", f"select eid, {_codes('p41270', 'F401 F411 F431')} as found from hospital"),
        "intersect_codes": over(
            "hospital",
            "select eid, array_to_string(list_sort(list_intersect(p41271, ['3000', '3003', '3004', '3040'])), ',')"
            " as mental_codes, len(list_intersect(p41271, ['3000', '3003', '3004', '3040'])) > 0 as mental"
            " from hospital",
        ),
        "array_count_at_least": over("online_multi", "select eid, len(p20548) >= 4 as many from online_multi"),
        # projections
        "equals_one_flag": phenotypes("online", {"alcohol_addiction": "p20406 = 1"}),
        "threshold_flag": phenotypes("touch", _INSOMNIA_TOUCH),
        "in_list_flag": phenotypes("online", {"most_of_day": "p20436 in (3, 4)"}),
        "any_of": phenotypes(
            "touch online",
            {"alcohol_addiction": "p20406 = 1"}
            | _INSOMNIA_TOUCH
            | {"either": "alcohol_addiction or touch_screen_insomnia"},
        ),
        "custom_rule": phenotypes(
            "touch online",
            {"sleep_answer": "p1200", "poor_sleep_or_mania": "sleep_answer >= 3 or p20501 = 1"},
        ),
        "created_columns_only": phenotypes("online", _PCL6, [_labels(["ptsd_pcl6"]) + " as level_0_derived_phenotypes"]),
        "source_columns_kept": phenotypes(
            "online", _PCL6, [_labels(["ptsd_pcl6"]) + " as level_0_derived_phenotypes"], more=" ".join(ptsd_items)
        ),
        "case_recode": phenotypes("online", _CANNABIS),
        # evaluation
        "evaluate_tree": composite("ocd"),
        "query_phenotypes": phenotypes(
            "hospital interview online touch",
            COMPOSITES["ptsd"] | _any("ptsd", *CHILDREN["ptsd"]) | _NEUROTICISM,
            _levels(["ptsd", "neuroticism"]),
        ),
        "instance_expansion": phenotypes("interview", _code_leaves("depression", interview="1278 1279 1280")),
        "code_set_flag": phenotypes("online_multi_whole", {"acts": "list_has_any(p20554, [1, 3])"}),
        "icd9_flag": phenotypes("hospital", _code_leaves("anxiety", icd9="3000 3001 3002 3009 300")),
        "icd10_flag": phenotypes("hospital", _code_leaves("ptsd", icd10="F431")),
        "interview_flag": phenotypes("interview", _code_leaves("ptsd", interview="1469")),
        "ever_diagnosed_flag": phenotypes("online_multi", _code_leaves("anxiety", ever="1 6 17")),
        "level_labels": phenotypes(
            ALL,
            bipolar | _any("bipolar", *CHILDREN["bipolar"]),
            _levels(["bipolar"]),
            hide=" ".join([*bipolar, "bipolar"]),
        ),
        "level_labels_compact": phenotypes(
            TABLES["anxiety"],
            COMPOSITES["anxiety"] | _any("anxiety", *CHILDREN["anxiety"]),
            _levels(["anxiety"], compact=True),
            hide=" ".join([*COMPOSITES["anxiety"], "anxiety"]),
        ),
        "normalized_codes": over(
            "hospital",
            f", plain_codes as (select eid, {_plain('plain')} from hospital)"
            f" select eid, {', '.join(f'{e} as {n}' for n, e in normalised.items())} from plain_codes",
        ),
        # scores
        "replace_missing_code": over(
            "online", f"select eid, {', '.join(f'{_item(f)} as p{f}' for f in (20501, 20493, 20411))} from online"
        ),
        "sum_score": over("online", f"select eid, {_GAD7['anxiety_gad7_score']} as total from online"),
        "score_threshold_flag": phenotypes(
            "touch",
            {
                "neuroticism_score": _item(20127),
                **{f"reaches_{k}": f"neuroticism_score >= {k}" for k in (3, 7, 11)},
            },
        ),
        "severity_band": phenotypes(
            "online", {"anxiety_gad7_score": _GAD7["anxiety_gad7_score"], "anxiety_gad7_severity": gad7_bands}
        ),
        "scored_phenotype": phenotypes("online", _PHQ9),
        "scored_instances": phenotypes("touch", _probable_depression()),
        "audit_score": phenotypes("online", _AUDIT),
        # clinical rules
        "probable_depression": phenotypes(
            "touch",
            _probable_depression()
            | {
                f"probable_depression_severity_{i}": f"case probable_depression_score_{i}"
                " when 0 then 'No Probable Depression' when 1 then 'Single Episode Probable Depression'"
                " when 2 then 'Moderate Recurrent Probable Depression'"
                " when 3 then 'Severe Recurrent Probable Depression' end"
                for i in VISITS
            },
        ),
        "lifetime_depression": phenotypes("online", _LIFETIME_DEPRESSION),
        "probable_bipolar": phenotypes("touch", _probable_bipolar()),
        "life_time_bipolar": phenotypes(ALL, _DEPRESSION | _LIFE_TIME_BIPOLAR),
        "cannabis_use_group": phenotypes("online", _CANNABIS),
        "substance_use_questionnaire": phenotypes("online interview", _SUBSTANCE_QUESTIONNAIRE),
        "self_harm_questionnaire": phenotypes("online online_multi_whole", _SELF_HARM_QUESTIONNAIRE),
        "insomnia_touch_screen": phenotypes("touch", _INSOMNIA_TOUCH),
        "neuroticism": phenotypes("touch", _NEUROTICISM),
        # whole runs
        "flagship": flagship(),
        "flagship_outer": flagship(),
        "write_result": composite("ptsd", levels=True),
        "write_result_csv": composite("ptsd", levels=True),
    }
    for name in COMPOSITES:
        sql[name] = composite(name, levels=True)
    return sql
