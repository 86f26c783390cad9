import pytest

from traitweave.functions.naming import Cell, field_column, field_number, sql_literal
from traitweave.sources.catalogue import FieldCatalogue


def test_field_column():
    assert field_column(20002) == "p20002"
    assert field_column(20002, 1) == "p20002_i1"
    assert field_column(20002, 1, 3) == "p20002_i1_a3"
    assert field_column(20002, element=3) == "p20002"
    assert field_column("depression", 2) == "depression"


def test_field_number():
    assert field_number("p20002_i1_a3") == 20002
    assert field_number("p1200") == 1200
    assert field_number("eid") is None
    assert field_number("p41270_hierarchy") is None
    assert field_number("note") is None


def test_cell():
    assert Cell.parse("p20002_i1_a12") == Cell(20002, 1, 12)
    assert Cell.parse("p20002_i1") is None
    assert Cell.parse("p20002_a1") is None
    assert Cell(5, 0, 1).column == "p5_i0_a1"
    assert sorted([Cell(5, 0, 10), Cell(5, 0, 9)])[0].element == 9


def test_sql_literal():
    assert sql_literal(3) == "3"
    assert sql_literal("it's") == "'it\\'s'"


def test_catalogue():
    catalogue = FieldCatalogue.of(
        {"b": ["eid", "p1_i1", "p2", "p2_hierarchy"], "a": ["eid", "p1_i0", "p1_i0_a0", "p3"]}
    )
    assert catalogue.tables_holding(1) == ["a", "b"]
    assert catalogue.tables_holding(2, 3) == ["a", "b"]
    assert catalogue.columns_of("a", 1) == ["eid", "p1_i0", "p1_i0_a0"]
    assert catalogue.columns_of("b", 1, 2) == ["eid", "p1_i1", "p2"]
    with pytest.raises(ValueError, match="no table holds field 7, 9"):
        catalogue.tables_holding(9, 1, 7)
    with pytest.raises(ValueError, match="no field is requested"):
        catalogue.tables_holding()
