"""A catalogue in a table: looked up by field, checked against the tables it names, no others opened."""

from collections.abc import Mapping

import pytest

from traitweave import CohortEngine, EqualsOne
from traitweave.functions.naming import address
from traitweave.sources.catalogue import FieldCatalogue, StoredCatalogue


class Opened(Mapping):
    """Tables that remember which of them were asked for."""

    def __init__(self, tables):
        self.tables, self.names = tables, set()

    def __getitem__(self, name):
        self.names.add(name)
        return self.tables[name]

    def __iter__(self):
        raise AssertionError("the tables are listed")

    def __len__(self):
        return len(self.tables)


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "ta": spark.createDataFrame([(1, 1, 5), (2, 0, 6)], "eid long, p1_i0 int, p1_i1_a0 int"),
        "tb": spark.createDataFrame([(2, 1)], "eid long, p2 int"),
        "tc": spark.createDataFrame([(1, 9, "x")], "eid long, p3 int, p3_hierarchy string"),
    }


@pytest.fixture(scope="module")
def entries(spark, tables):
    return FieldCatalogue.of({n: t.columns for n, t in tables.items()}).entries(spark)


def test_entries(entries):
    assert {tuple(r) for r in entries.collect()} == {
        ("ta", "p1_i0", 1, 0, None),
        ("ta", "p1_i1_a0", 1, 1, 0),
        ("tb", "p2", 2, None, None),
        ("tc", "p3", 3, None, None),
    }
    assert address("p7_i2_a11") == (7, 2, 11) and address("p7") == (7, None, None)


def test_only_the_tables_needed_are_opened(tables, entries):
    opened = Opened(tables)
    engine = CohortEngine(opened, StoredCatalogue(entries))
    assert engine.query(EqualsOne("two", fields=[2])).collect()[0]["two"] is True
    assert opened.names == {"tb"}
    assert {r["eid"]: r["p3"] for r in engine.get_table(2, 3).collect()} == {1: 9, 2: None}
    assert opened.names == {"tb", "tc"}
    with pytest.raises(ValueError, match="no table holds field 8"):
        engine.get_table(8, 2)


@pytest.mark.parametrize("change", ["missing", "new"])
def test_a_stale_catalogue_is_an_error(spark, tables, entries, change):
    changed = entries.filter("column <> 'p1_i0'") if change == "new" else entries.union(spark.createDataFrame([("tb", "p2_i1", 2, 1, None)], entries.schema))
    engine = CohortEngine(tables, StoredCatalogue(changed))
    with pytest.raises(ValueError, match="do not agree on p1_i0" if change == "new" else "do not agree on p2_i1"):
        engine.get_table(1, 2)
    assert engine.get_table(3).count() == 1  # of no concern to other tables


def test_from_database(spark, tables, entries):
    spark.sql("CREATE DATABASE IF NOT EXISTS stored_catalogue")
    try:
        for name, df in [*tables.items(), ("fields", entries)]:
            df.write.saveAsTable(f"stored_catalogue.{name}", mode="overwrite")
        for catalogue in ("fields", spark.table("stored_catalogue.fields")):
            engine = CohortEngine.from_database(spark, "stored_catalogue", catalogue)
            assert sorted(engine.get_table(1).columns) == ["eid", "p1", "p1_i0", "p1_i1", "p1_i1_a0"]
    finally:
        spark.sql("DROP DATABASE stored_catalogue CASCADE")
