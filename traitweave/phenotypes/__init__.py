"""The catalogue of phenotypes: leaves as data, composites as any-of their leaves.

Code lists, item lists, levels and labels are fixed values. Codes are matched
exactly, so their dots matter unless a query asks for normalised codes.
"""

from __future__ import annotations

from traitweave.functions.scores import at_least_level
from traitweave.operators.specs import AnyOf, EqualsOne, FlagRule, Phenotype, Score
from traitweave.phenotypes import rules
from traitweave.phenotypes.vocabularies import ever_diagnosed, icd9, icd10, interview


# --- eating disorder
eating_disorder = AnyOf(
    "eating_disorder",
    children=[
        icd9("eating_disorder", ["3071", "3075", "30750", "30751", "30752", "30753", "30754", "30755", "30759"]),
        icd10("eating_disorder", ["F500", "F501", "F502", "F503", "F508", "F509"]),
        interview("eating_disorder", [1470]),
        ever_diagnosed("eating_disorder", [13, 12, 16]),
    ],
)

# --- schizophrenia
schizophrenia = AnyOf(
    "schizophrenia",
    children=[
        icd9("schizophrenia", ["2950", "2951", "2952", "2953", "295F4", "2955", "2956", "2957", "2958", "2959"]),
        icd10(
            "schizophrenia",
            [
                "F20.0", "F20.1", "F20.2", "F20.3", "F20.4", "F20.5", "F20.6", "F20.8", "F20.9",
                "F21",
                "F22.0", "F22.8", "F22.9",
                "F23.0", "F23.1", "F23.2", "F23.3", "F23.8", "F23.9",
                "F24",
                "F25.0", "F25.1", "F25.2", "F25.8", "F25.9",
                "F28",
                "F29",
            ],
        ),
        interview("schizophrenia", [1289]),
        ever_diagnosed("schizophrenia", [2]),
    ],
)

# --- obsessive-compulsive disorder
ocd = AnyOf(
    "ocd",
    children=[
        icd9("ocd", ["3003"]),
        icd10("ocd", ["F42.0", "F42.1", "F42.2", "F42.8", "F42.9"]),
        interview("ocd", [1615]),
        ever_diagnosed("ocd", [7]),
    ],
)

# --- anxiety
anxiety_gad7 = Score(
    "anxiety_gad7",
    fields=[20506, 20509, 20520, 20515, 20516, 20505, 20512],
    levels=[5, 10, 15],
    labels=["Low", "Mild", "Moderate", "Severe"],
)
anxiety = AnyOf(
    "anxiety",
    children=[
        anxiety_gad7,
        icd9("anxiety", ["3000", "3001", "3002", "3009", "300"]),
        icd10(
            "anxiety",
            [
                "F064", "F93.0", "F931", "F932", "F40", "F400", "F401", "F402", "F408", "F409",
                "F41", "F410", "F411", "F412", "F413", "F418", "F419",
            ],
        ),
        interview("anxiety", [1287, 1614]),
        ever_diagnosed("anxiety", [1, 6, 17]),
    ],
)

# --- depression
lifetime_depression = FlagRule(
    "lifetime_depression",
    fields=rules.LIFETIME_DEPRESSION_FIELDS,
    rule=rules.lifetime_depression,
    null_if_absent=True,
)
probable_depression = Score(
    "probable_depression",
    fields=rules.PROBABLE_DEPRESSION_FIELDS,
    visits=4,
    levels=[1, 2, 3],
    labels=[
        "No Probable Depression",
        "Single Episode Probable Depression",
        "Moderate Recurrent Probable Depression",
        "Severe Recurrent Probable Depression",
    ],
    recode=None,
    scorer=rules.probable_depression_score,
    to_flag=at_least_level(0),
)
phq9_depression = Score(
    "phq9_depression",
    fields=[20514, 20510, 20517, 20519, 20511, 20507, 20508, 20518, 20513],
    levels=[5, 10, 15, 20],
    labels=["No", "Low", "Mild", "Moderate", "Severe"],
)
depression = AnyOf(
    "depression",
    children=[
        lifetime_depression,
        probable_depression,
        phq9_depression,
        icd9("depression", ["3119", "3004"]),
        icd10("depression", ["F32.0", "F32.1", "F32.2", "F32.3", "F32.8", "F32.9"]),
        interview("depression", [1278, 1279, 1280, 1281, 1282, 1283, 1284, 1285, 1286]),
        ever_diagnosed("depression", [11]),
    ],
)

# --- bipolar disorder
probable_bipolar = Score(
    "probable_bipolar",
    fields=rules.PROBABLE_BIPOLAR_FIELDS,
    visits=4,
    levels=[1, 2],
    labels=["No Probable Bipolar", "Probable Bipolar II", "Probable Bipolar I"],
    keep_raw=[6156],
    scorer=rules.probable_bipolar_score,
    to_flag=at_least_level(0),
    null_if_absent=True,
)
life_time_bipolar = Score(
    "life_time_bipolar",
    fields=rules.LIFE_TIME_BIPOLAR_FIELDS,
    children=[depression],
    levels=[1, 2],
    labels=["No Life Time Bipolar", "Life Time Bipolar II", "Life Time Bipolar I"],
    keep_raw=[20548],
    parts={
        "mania": rules.mania_answered,
        "symptoms": rules.several_mania_symptoms,
        "problems": rules.mania_caused_problems,
    },
    scorer=rules.life_time_bipolar_score,
    to_flag=at_least_level(0),
    null_if_absent=True,
)
bipolar = AnyOf("bipolar", children=[life_time_bipolar, probable_bipolar])

# --- post-traumatic stress disorder
# The published cut-off is 14 for six items scored 1 to 5; these answers run from 0 to 4, which makes it 8.
ptsd_pcl6 = Score("ptsd_pcl6", fields=[20497, 20498, 20495, 20496, 20494, 20508], levels=[8])
ptsd = AnyOf("ptsd", children=[icd10("ptsd", ["F431"]), interview("ptsd", [1469]), ptsd_pcl6])

# --- self-harm
self_harm = AnyOf(
    "self_harm",
    children=[
        FlagRule(
            "questionnaire_self_harm",
            fields=rules.SELF_HARM_FIELDS,
            parts={"answered": rules.self_harm_answered, "acts_named": rules.self_harm_acts_named},
            rule=rules.questionnaire_self_harm,
            null_if_absent=True,
        ),
        icd9("self_harm", ["E950", "E951", "E952", "E953", "E954", "E955", "E956", "E957", "E958", "E959"]),
        icd10("self_harm", [
            "X60", "X61", "X62", "X63", "X64", "X65", "X66", "X67", "X68", "X69", "X70", "X71", "X72",
            "X73", "X74", "X75", "X76", "X77", "X78", "X79", "X80", "X81", "X82", "X83", "X84", "Z915",
            "Y1", "Y2", "Y3",
        ]),
        interview("self_harm", [1290]),
    ],
)

# --- substance abuse
questionnaire_substance_abuse_non_alcoholic = FlagRule(
    "questionnaire_substance_abuse_non_alcoholic",
    fields=rules.SUBSTANCE_FIELDS,
    helpers={"cannabis_use_group": rules.cannabis_use_group},
    parts={
        "dependency_told": rules.substance_dependency_told,
        "addiction_answered": rules.substance_addiction_answered,
    },
    rule=rules.substance_use,
    null_if_absent=True,
)
substance_abuse_non_alcoholic = AnyOf(
    "substance_abuse_non_alcoholic",
    children=[
        questionnaire_substance_abuse_non_alcoholic,
        icd10(
            "substance_abuse_non_alcoholic",
            [
                "F11.1", "F11.2", "F11.3", "F11.4", "F12.1", "F12.2", "F12.3", "F12.4", "F13.1",
                "F13.2", "F13.3", "F13.4", "F14.1", "F14.2", "F14.3", "F14.4", "F19.1", "F19.2",
                "F19.3", "F19.4",
            ],
        ),
        icd9("substance_abuse_non_alcoholic", ["3040"]),
        interview("substance_abuse_non_alcoholic", [1409, 1410]),
        ever_diagnosed("substance_abuse_non_alcoholic", [8]),
    ],
)

# --- alcohol abuse
audit_score = Score(
    "audit_score", fields=rules.AUDIT_FIELDS, levels=[15], scorer=rules.audit_score, null_if_absent=True
)
alcohol_abuse = AnyOf(
    "alcohol_abuse",
    children=[
        audit_score,
        EqualsOne("alcohol_addiction", fields=[20406]),
        icd9("alcohol_abuse", ["3039"]),
        icd10("alcohol_abuse", ["F10.1", "F10.2", "F10.3", "F10.4"]),
        interview("alcohol_abuse", [1408]),
    ],
)

# --- insomnia
insomnia = AnyOf(
    "insomnia",
    children=[
        interview("insomnia", [1616]),
        FlagRule(
            "touch_screen_insomnia",
            fields=[rules.INSOMNIA_FIELD],
            rule=rules.touch_screen_insomnia,
            null_if_absent=True,
        ),
    ],
)

# --- neuroticism
neuroticism = Score(
    "neuroticism", fields=[20127], levels=[3, 7, 11], labels=["No", "Low", "Moderate", "High"]
)

#: The ten composites of the standard run, in output order.
STANDARD_RUN: tuple[Phenotype, ...] = (
    self_harm,
    eating_disorder,
    depression,
    bipolar,
    anxiety,
    alcohol_abuse,
    substance_abuse_non_alcoholic,
    schizophrenia,
    ptsd,
    ocd,
)


def _by_name(*specs: Phenotype) -> dict[str, Phenotype]:
    found: dict[str, Phenotype] = {}
    for spec in specs:
        found.update(_by_name(*spec.children))
        found[spec.name] = spec
    return found


#: Every phenotype of the catalogue by name.
CATALOGUE: dict[str, Phenotype] = _by_name(*STANDARD_RUN, insomnia, neuroticism)
