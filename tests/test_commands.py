"""Files of delete commands: taken apart by Spark, checked, applied in one scan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakewright.operators.commands import MAX_KEY_SETS, apply_delete_commands
from lakewright.plans import jobs
from lakewright.sources import commands
from lakewright.sources.commands import RefusedStatement, read_delete_commands
from lakewright.sources.lake import read_table

ROWS = [(1, "ann", 1.5, dt.date(2024, 1, 1)), (2, "bob", None, None), (3, None, 3.0, dt.date(2024, 1, 3)), (4, "o'neil; x", 4.0, None), (None, "eve", 5.0, None)]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(ROWS, "id int, Name string, score double, day date")


def left_by(spark, tmp_path, people, text, table="lake.people"):
    path = tmp_path / "2024-01-05.sql"
    path.write_text(text)
    kept = apply_delete_commands(people, read_delete_commands(spark, str(path)), table)
    assert kept.columns == people.columns
    return [r["name"] or "-" for r in kept.select(F.col("Name").alias("name")).collect()]


@pytest.mark.parametrize(
    ("text", "left"),
    [
        ("DELETE FROM people WHERE id = 1;\nDELETE FROM lake.People WHERE id = 3;", ["bob", "o'neil; x", "eve"]),
        ("delete from `lake`.`people` where `ID` = 2 and name = 'bob';delete from people where id=4 and NAME='zoe'", ["ann", "-", "o'neil; x", "eve"]),
        ("DELETE FROM people WHERE score > 2 AND score < 4.5 OR day IS NULL AND id IN (2, 9);", ["ann", "eve"]),
        ("DELETE FROM people p WHERE p.name LIKE 'a%' OR p.id BETWEEN 3 AND 7;", ["bob", "eve"]),
        ("DELETE FROM people WHERE NOT (id <> 1);DELETE FROM other WHERE id = 2;DELETE FROM other WHERE no_such_column < 2;", ["bob", "-", "o'neil; x", "eve"]),
        ("DELETE FROM warehouse.people WHERE id = 1;", ["ann", "bob", "-", "o'neil; x", "eve"]),
        ("DELETE FROM people WHERE id = '1';DELETE FROM people WHERE score = 3;DELETE FROM people WHERE day = DATE '2024-01-01'", ["bob", "o'neil; x", "eve"]),
        ("DELETE FROM people WHERE id = 99999999999;DELETE FROM people WHERE id = NULL;DELETE FROM people WHERE Name <=> NULL;", ["ann", "bob", "o'neil; x", "eve"]),
        ("-- the day's deletes\nDELETE FROM people\r\n  WHERE name = 'eve'\n  AND id IS NULL;\n\n ;\n", ["ann", "bob", "-", "o'neil; x"]),
        ("", ["ann", "bob", "-", "o'neil; x", "eve"]),
    ],
)
def test_commands_delete_what_they_say(spark, tmp_path, people, text, left):
    assert left_by(spark, tmp_path, people, text) == left


@pytest.mark.parametrize(
    "statement",
    [
        "DELETE FROM people", "DELETE FROM people WHERE true", "DELETE FROM people WHERE 1 = 1", "DROP TABLE people", "DELETE FROM people WHERE nope = 1",
        "DELETE FROM people WHERE id IN (SELECT id FROM people)", "DELETE FROM people WHERE upper(name) = 'ANN'", "DELETE FROM people WHERE other.id = 1",
        "DELETE FROM people WHERE id = id + 1", "UPDATE people SET id = 1", "DELETE FROM people WHERE name = 'a;b'", "SELECT 1", "DELETE FROM other WHERE rand() < 2",
        "DELETE FROM people WHERE name LIKE 'a!%' ESCAPE '!'", "DELETE FROM people WHERE nope < 1",
    ],
)
def test_anything_else_is_refused(spark, tmp_path, people, statement):
    with pytest.raises(RefusedStatement):
        left_by(spark, tmp_path, people, f"DELETE FROM people WHERE id = 1;\n{statement};")


def test_many_commands_are_few_joins(spark, tmp_path, people, plan, monkeypatch):
    path = tmp_path / "many.sql"
    path.write_text("".join(f"DELETE FROM people WHERE id = {i};\nDELETE FROM people WHERE score > {i + 100} AND id = {i};\n" for i in range(2, 1500)))
    kept = apply_delete_commands(people, read_delete_commands(spark, str(path)), "people")
    assert sorted(r["Name"] for r in kept.collect()) == ["ann", "eve"]
    joins = plan(kept).split("== Physical Plan ==")[1].count("LeftAnti")
    assert 1 <= joins <= 2
    monkeypatch.setattr("lakewright.operators.commands.MAX_PREDICATES", 100)
    with pytest.raises(RefusedStatement, match="more than 100"):
        apply_delete_commands(people, read_delete_commands(spark, str(path)), "people")


def test_sets_of_key_columns_are_limited(spark, tmp_path):
    names = [f"c{i}" for i in range(MAX_KEY_SETS + 1)]
    wide = spark.createDataFrame([tuple(range(len(names)))], ", ".join(f"{n} int" for n in names))
    path = tmp_path / "sets.sql"
    path.write_text("".join(f"DELETE FROM wide WHERE {n} = -1;" for n in names))
    with pytest.raises(RefusedStatement, match="sets of key columns"):
        apply_delete_commands(wide, read_delete_commands(spark, str(path)), "wide")


def test_the_daily_job_takes_delete_files(spark, tmp_path, people):
    (tmp_path / "deletes").mkdir()
    (tmp_path / "deletes" / "2024-01-05.sql").write_text("DELETE FROM people WHERE id = 1; DELETE FROM people WHERE score >= 5;")
    run = jobs.daily_delete_and_append(
        people, str(tmp_path / "root"), str(tmp_path / "none"), dt.date(2024, 1, 6), delete_root=str(tmp_path / "deletes"), delete_from="people"
    )
    assert run.deleted and sorted(r["Name"] or "" for r in read_table(spark, run.version).collect()) == ["", "bob", "o'neil; x"]
    nothing = jobs.daily_delete_and_append(
        people, str(tmp_path / "root"), str(tmp_path / "none"), dt.date(2024, 1, 7), delete_root=str(tmp_path / "deletes"), delete_from="people"
    )
    assert (nothing.version, nothing.deleted) == (None, False)
    assert commands.existing_delete_file(spark, str(tmp_path / "deletes"), dt.date(2024, 1, 6)) is None
