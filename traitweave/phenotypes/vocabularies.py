"""Specs bound to the field that holds the codes of one vocabulary."""

from __future__ import annotations

from collections.abc import Sequence

from traitweave.operators.specs import CodeSet

# Field numbers of the code arrays, and how many visits the interview has.
ICD9_FIELD = 41271
ICD10_FIELD = 41270
INTERVIEW_FIELD = 20002
INTERVIEW_VISITS = 4
EVER_DIAGNOSED_FIELD = 20544


def icd9(condition: str, codes: Sequence[str]) -> CodeSet:
    """Hospital diagnosis, 9th revision."""
    return CodeSet(f"icd9_{condition}", fields=[ICD9_FIELD], codes=codes)


def icd10(condition: str, codes: Sequence[str]) -> CodeSet:
    """Hospital diagnosis, 10th revision."""
    return CodeSet(f"icd10_{condition}", fields=[ICD10_FIELD], codes=codes)


def interview(condition: str, codes: Sequence[int]) -> CodeSet:
    """Illness told in the verbal interview of any visit."""
    return CodeSet(f"verbal_interview_{condition}", fields=[INTERVIEW_FIELD], codes=codes, visits=INTERVIEW_VISITS)


def ever_diagnosed(condition: str, codes: Sequence[int]) -> CodeSet:
    """Diagnosis by a professional, as reported online."""
    return CodeSet(f"ever_diag_{condition}", fields=[EVER_DIAGNOSED_FIELD], codes=codes)
