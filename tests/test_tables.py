from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_of, rows
from tidemark.operators.evolve import as_stored
from tidemark import names as N
from tidemark.operators import align, merged_schema
from tidemark.sources import (
    BAD_RECORD,
    ConcurrentWriteError,
    AppendTable,
    CurrentTable,
    HistoryTable,
    UpsertCounts,
    counted,
    literal_table,
    read_json_records,
    read_json_snapshot,
)


def keyed(spark, data, columns="hash_chave string, v int"):
    return spark.createDataFrame(data, columns)


def test_literal_table_has_the_given_schema(spark):
    schema = T.StructType(
        [T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())]
    )
    df = literal_table(spark, [("Ana", 24), ("Rui", None)], schema)
    assert df.schema == schema
    assert rows(df) == [("Ana", 24), ("Rui", None)]


def test_probe_and_missing_table(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    assert table.find() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.append(spark.range(3)) == 3
    assert table.exists()


def test_create_insists_on_being_first(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    assert table.create(spark.range(3)) == 3
    with pytest.raises(FileExistsError):
        table.create(spark.range(3))
    assert table.read().count() == 3


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_append_keeps_rows_and_column_order_in_any_format(spark, tmp_path, fmt):
    table = AppendTable(spark, str(tmp_path / "t"), fmt)
    table.append(keyed(spark, [("a", 1)]))
    table.append(keyed(spark, [("b", 2)]).select("v", "hash_chave"))
    assert table.read().columns == ["hash_chave", "v"]
    assert rows(table.read()) == [("a", 1), ("b", 2)]
    assert table.last_release().rows == 2


def test_an_empty_first_load_makes_an_empty_table(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    assert table.append(keyed(spark, [])) == 0
    assert rows(table.read()) == []
    assert table.append(keyed(spark, [("a", 1)])) == 1
    assert rows(table.read()) == [("a", 1)]


def test_new_columns_go_to_the_tail(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    table.append(keyed(spark, [("a", 1)]))
    table.append(spark.createDataFrame([("x", "b")], "extra string, hash_chave string"))
    assert table.read().columns == ["hash_chave", "v", "extra"]
    assert rows(table.read()) == [("a", 1, None), ("b", None, "x")]


def test_without_evolution_the_stored_columns_stay(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    table.append(keyed(spark, [("a", 1)]))
    table.append(keyed(spark, [("b", 2)]).withColumn("extra", F.lit(1)), evolve=False)
    assert rows(table.read()) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError, match="no column"):
        table.append(spark.createDataFrame([("c",)], "hash_chave string"), evolve=False)


def test_a_changed_type_is_an_error(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    table.append(keyed(spark, [("a", 1)]))
    with pytest.raises(ValueError, match="v is stored as int, but arrives as double"):
        table.append(keyed(spark, [("a", 1.5)], "hash_chave string, v double"))


def test_merged_schema_and_align(spark):
    stored = T.StructType([T.StructField("a", T.LongType(), False)])
    arriving = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.LongType())])
    merged = merged_schema(stored, arriving)
    assert merged.names == ["a", "b"]
    assert all(f.nullable for f in merged.fields)
    aligned = align(spark.range(1).select(F.col("id").alias("a")), merged)
    assert rows(aligned) == [(0, None)]


def test_a_write_that_was_cut_short_stays_unseen(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    table.append(keyed(spark, [("a", 1)]))
    # Files of the next release without the row that releases them.
    keyed(spark, [("half", 0)]).write.parquet(str(tmp_path / "t" / "data" / "tidemark_release=2"))
    assert rows(table.read()) == [("a", 1)]
    table.append(keyed(spark, [("b", 2)]))
    assert rows(table.read()) == [("a", 1), ("b", 2)]


def history_rows(spark, data):
    return spark.createDataFrame(
        data, "id string, dt_atualizacao string, dt_ingestao string, hash_chave string, hash_columns string"
    )


def test_what_an_earlier_attempt_left_is_cleared_in_any_session(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"))
    one = [("a", "2025-06-01 10:00:00", "2025-06-01", "a", "a1")]
    table.append(history_rows(spark, one))
    left = history_rows(spark, [("x", "2025-06-02 10:00:00", "2025-06-02", "x", "x1")])
    left.write.partitionBy(N.INGESTED_ON).parquet(str(tmp_path / "h" / "data" / "tidemark_release=2"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        table.append(history_rows(spark, [("b", "2025-06-03 10:00:00", "2025-06-03", "b", "b1")]))
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(table.read(), "id") == [("a",), ("b",)]


def test_history_is_laid_out_by_day_and_read_by_day(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"))
    table.append(history_rows(spark, [("a", "2025-06-01 10:00:00", "2025-06-01", "a", "a1")]))
    table.append(history_rows(spark, [("a", "2025-06-03 10:00:00", "2025-06-03", "a", "a2")]))
    assert table.read().schema[N.INGESTED_ON].dataType == T.StringType()
    assert table.read().columns[2] == N.INGESTED_ON
    recent = table.read(since="2025-06-02")
    assert rows(recent, "hash_columns") == [("a2",)]
    plan = plan_of(recent)
    assert "PartitionFilters: [isnotnull(dt_ingestao" in plan
    assert f"{N.INGESTED_ON}#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_a_partitioned_write_of_one_day_is_not_sorted(spark):
    df = spark.range(10).selectExpr("id", "'2025-06-01' AS dt_ingestao")
    spark.sql("CREATE TABLE by_day (id long, dt_ingestao string) USING parquet PARTITIONED BY (dt_ingestao)")

    def write_plan(constants):
        counted(df, Observation(), constants).createOrReplaceTempView("counted_rows")
        return spark.sql("EXPLAIN INSERT INTO by_day TABLE counted_rows").first()[0]

    assert "Sort" in write_plan({})
    assert "Sort" not in write_plan({N.INGESTED_ON: "2025-06-01"})


def test_history_modes(spark, tmp_path):
    def batch(day, *states):
        return history_rows(
            spark, [(s, f"{day} 10:00:00", day, "k", s) for s in states]
        )

    days = ["2025-06-01", "2025-06-02", "2025-06-03"]
    known = HistoryTable(spark, str(tmp_path / "known"))
    assert [known.insert_unseen(batch(d, s)) for d, s in zip(days, "ABA", strict=True)] == [1, 1, 0]
    every = HistoryTable(spark, str(tmp_path / "every"))
    counts = [every.insert_unseen(batch(d, s), compare="latest") for d, s in zip(days, "ABA", strict=True)]
    assert counts == [1, 1, 1]
    assert every.insert_unseen(batch("2025-06-04", "A"), compare="latest") == 0
    once = HistoryTable(spark, str(tmp_path / "once"))
    assert once.insert_unseen(batch(days[0], "A", "A"), distinct=True) == 1
    assert known.insert_unseen(batch(days[0], "C", "C")) == 2
    with pytest.raises(ValueError, match="compare"):
        known.insert_unseen(batch(days[0], "A"), compare="newest")


def test_overwrite_from_itself(spark, tmp_path):
    table = CurrentTable(spark, str(tmp_path / "c"))
    assert table.overwrite(keyed(spark, [("a", 1), ("b", 2)])) == 2
    table.overwrite(table.read().filter("v > 1").withColumn("w", F.lit("x")))
    assert rows(table.read()) == [("b", 2, "x")]


def test_upsert_counts_and_rows(spark, tmp_path):
    table = CurrentTable(spark, str(tmp_path / "c"))
    assert table.upsert(keyed(spark, [("a", 1), ("b", 1), ("c", 1)])) == UpsertCounts(3, 0, 0)
    assert table.upsert(keyed(spark, [("b", 2), ("d", 2)])) == UpsertCounts(1, 1, 2)
    assert rows(table.read()) == [("a", 1), ("b", 2), ("c", 1), ("d", 2)]
    release = table.last_release().release
    assert table.upsert(keyed(spark, [])) == UpsertCounts(0, 0, 4)
    assert table.last_release().release == release
    assert table.upsert(keyed(spark, [("a", 5)]).withColumn("w", F.lit("x"))) == UpsertCounts(0, 1, 3)
    assert rows(table.read().filter("v > 1")) == [("a", 5, "x"), ("b", 2, None), ("d", 2, None)]


def test_the_second_of_two_writers_is_refused(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "a"))
    table.append(keyed(spark, [("a", 1)]))
    last = table.last_release()
    assert table._append(keyed(spark, [(f"b{i}", 1) for i in range(10)]), last, True) == 10
    with pytest.raises(ConcurrentWriteError, match="release 2"):
        table._append(keyed(spark, [(f"c{i}", 1) for i in range(3)]), last, True)
    assert table.read().count() == table.last_release().rows == 11
    table.append(keyed(spark, [("d", 1)]))
    assert table.read().count() == table.last_release().rows == 12


def test_a_reader_of_one_release_lists_one_folder(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"))
    for day in range(3):
        batch = keyed(spark, [(f"k{day}", day)]).withColumn(N.INGESTED_ON, F.lit(f"2025-06-0{day + 1}"))
        table._append(batch, table.last_release(), True, moment=f"2025-06-0{day + 1} 00:00:00")
    news, number = table.read_news(2)
    assert number == 3
    assert [n.count("tidemark_release=3") for n in news.inputFiles()] == [1]
    assert rows(news, "v", N.RELEASE) == [(2, 3)]


def test_an_empty_current_table_can_be_read(spark, tmp_path):
    table = CurrentTable(spark, str(tmp_path / "c"))
    assert table.upsert(keyed(spark, [])) == UpsertCounts(0, 0, 0)
    assert rows(table.read()) == []
    assert table.upsert(keyed(spark, [("abc", 1)])) == UpsertCounts(1, 0, 0)
    assert rows(table.read()) == [("abc", 1)]


def test_upsert_of_ninety_eight_two_and_two(spark, tmp_path):
    table = CurrentTable(spark, str(tmp_path / "c"))
    table.upsert(keyed(spark, [(f"k{i:03}", 0) for i in range(100)]))
    counts = table.upsert(keyed(spark, [(f"k{i:03}", 1) for i in range(2, 102)]))
    assert counts == UpsertCounts(inserted=2, updated=98, copied=2)
    assert table.read().count() == 102


def test_upsert_refuses_two_rows_for_one_key(spark, tmp_path):
    table = CurrentTable(spark, str(tmp_path / "c"))
    table.upsert(keyed(spark, [("a", 1)]))
    with pytest.raises(ValueError, match="several source rows have the key a"):
        table.upsert(keyed(spark, [("a", 2), ("a", 3)]))
    assert rows(table.read()) == [("a", 1)]
    with pytest.raises(ValueError, match="several source rows"):
        CurrentTable(spark, str(tmp_path / "d")).upsert(keyed(spark, [("a", 2), ("a", 3)]))


def test_json_snapshot_schema_and_provenance(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text('[\n {"id": "a", "roi": {"x": 1}, "p": 1.5},\n {"p": 2, "id": "b", "roi": null}\n]')
    assert read_json_snapshot(spark, str(path)).columns == ["id", "p", "roi"]
    inferred = read_json_snapshot(spark, str(path), drop=("roi",))
    assert inferred.columns == ["id", "p"]
    assert rows(inferred) == [("a", 1.5), ("b", 2.0)]
    told = read_json_snapshot(spark, str(path), "id string, p double, q string", provenance=True)
    assert told.columns == ["id", "p", "q", N.SOURCE_NAME]
    assert rows(told)[0][:3] == ("a", 1.5, None)
    assert rows(told)[0][3].endswith("/s.json")


def test_json_lines_and_broken_files(spark, tmp_path):
    lines = tmp_path / "lines.json"
    lines.write_text('{"id": "a"}\n{"id": "b"}\n')
    assert rows(read_json_snapshot(spark, str(lines), "id string", multi_line=False)) == [("a",), ("b",)]
    broken = tmp_path / "broken.json"
    broken.write_text('[{"id": "a"}, {"id": ')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_snapshot(spark, str(broken), "id string").collect()


def test_stored_types_hold_where_nothing_is_lost():
    stored = T.StructType.fromDDL("share double, code string, n bigint")
    arriving = T.StructType.fromDDL("code bigint, fresh bigint, n double, share bigint")
    fitted = as_stored(arriving, stored)
    assert fitted == T.StructType.fromDDL("code string, fresh bigint, n double, share double")


def test_a_release_file_that_breaks_off_is_skipped(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    releases = tmp_path / "t" / "releases"
    table.append(keyed(spark, [("a", 1)]))
    table.append(keyed(spark, [("b", 2)]))
    whole = (releases / f"{2:012d}.json").read_text()
    for number, text in ((3, ""), (4, whole[: len(whole) // 2]), (5, "{}")):
        (releases / f"{number:012d}.json").write_text(text)
    assert table.last_release().release == 2
    assert rows(table.read()) == [("a", 1), ("b", 2)]
    table.append(keyed(spark, [("c", 3)]))
    assert table.last_release().release == 6
    assert rows(table.read()) == [("a", 1), ("b", 2), ("c", 3)]
    assert [n.name for n in releases.iterdir() if n.name.endswith(".draft")] == []


@pytest.mark.parametrize("kind", [AppendTable, CurrentTable])
def test_a_first_release_file_that_breaks_off_is_skipped(spark, tmp_path, kind):
    releases = tmp_path / "t" / "releases"
    releases.mkdir(parents=True)
    (releases / f"{1:012d}.json").write_text("")
    table = kind(spark, str(tmp_path / "t"))
    assert not table.exists()
    table.append(keyed(spark, [("a", 1)])) if kind is AppendTable else table.upsert(keyed(spark, [("a", 1)]))
    assert rows(table.read()) == [("a", 1)]
    assert table.last_release().release == 2


def test_reading_a_history_of_many_releases_starts_no_job(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"))
    for day in range(4):
        batch = keyed(spark, [(f"k{day}", day)]).withColumn(N.INGESTED_ON, F.lit(f"2025-06-0{day + 1}"))
        table._append(batch, table.last_release(), True, moment=f"2025-06-0{day + 1} 00:00:00")
    spark.sparkContext.setJobGroup("reading", "reading")
    try:
        table.read()
        table.read_news(2)
        assert table.schema().names == ["hash_chave", "v", N.INGESTED_ON]
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("reading")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_whole_numbers_become_fractions_when_such_arrive(spark, tmp_path, fmt):
    table = AppendTable(spark, str(tmp_path / "t"), fmt)
    table.append(keyed(spark, [("a", 1), ("b", None)], "hash_chave string, v bigint"))
    table.append(keyed(spark, [("c", 2)], "hash_chave string, v bigint").withColumn("w", F.lit("x")))
    table.append(keyed(spark, [("d", 2.5)], "hash_chave string, v double"))
    assert dict(table.read().dtypes) == {"hash_chave": "string", "v": "double", "w": "string"}
    assert rows(table.read()) == [("a", 1.0, None), ("b", None, None), ("c", 2.0, "x"), ("d", 2.5, None)]
    assert len(table.last_release().schemas) == 3
    with pytest.raises(ValueError, match="v is stored as double, but arrives as string"):
        table.append(keyed(spark, [("e", "x")], "hash_chave string, v string"))


def test_without_evolution_nothing_is_widened(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    table.append(keyed(spark, [("a", 1)], "hash_chave string, v bigint"))
    with pytest.raises(ValueError, match="v is stored as bigint, but arrives as double"):
        table.append(keyed(spark, [("b", 1.5)], "hash_chave string, v double"), evolve=False)


def test_an_upsert_widens_the_rows_it_keeps(spark, tmp_path):
    table = CurrentTable(spark, str(tmp_path / "c"))
    table.upsert(keyed(spark, [("a", 1), ("b", 2)], "hash_chave string, v bigint"))
    assert table.upsert(keyed(spark, [("b", 2.5)], "hash_chave string, v double")) == UpsertCounts(0, 1, 1)
    assert rows(table.read()) == [("a", 1.0), ("b", 2.5)]


def test_bad_records_of_arrays_and_lines_are_told_apart(spark, tmp_path):
    files = {
        "array.json": '[{"id": "a", "p": 1}, {"id": "b", "p": "word"}, null, 5,\n {"id": "c", "p": 2.5, "more": []}]',
        "object.json": '{"id": "d", "p": 3}',
        "broken.json": '[{"id": "e", "p": 1}, {"id": ',
        "empty.json": " \n",
        "none.json": "[]",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    found = read_json_records(spark, str(tmp_path), "id string, p double")
    assert found.columns == ["id", "p", N.SOURCE_NAME, BAD_RECORD]
    good = found.where(F.col(BAD_RECORD).isNull())
    assert rows(good, "id", "p") == [("a", 1.0), ("c", 2.5), ("d", 3.0)]
    bad = rows(found.where(F.col(BAD_RECORD).isNotNull()), F.regexp_extract(N.SOURCE_NAME, "[a-z]+.json$", 0), BAD_RECORD)
    assert [name for name, _ in bad] == ["array.json"] * 3 + ["broken.json"]
    assert {text for _, text in bad} >= {"null", "5", files["broken.json"]}
    lines = tmp_path / "lines"
    lines.write_text('{"id": "a", "p": 1}\n\n{"id": "b" "p": 2}\n{"id": "c", "p": "x"}\n')
    found = read_json_records(spark, str(lines), "id string, p double", multi_line=False)
    assert rows(found.where(F.col(BAD_RECORD).isNull()), "id") == [("a",)]
    assert rows(found.where(F.col(BAD_RECORD).isNotNull()), BAD_RECORD) == [
        ('{"id": "b" "p": 2}',), ('{"id": "c", "p": "x"}',)
    ]
