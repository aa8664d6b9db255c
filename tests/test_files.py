import glob
import os
from datetime import datetime

import pytest
from helpers import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from sluice import schemas
from sluice.functions.stamp import as_text, audit, batch, new_batch_id, parse_audit_text, rename
from sluice.scratch import clear_scratch, materialize, scratch_root
from sluice.sinks import files, jdbc as jdbc_sink
from sluice.sinks.files import create_csv, write_csv
from sluice.sources import jdbc as jdbc_source
from sluice.sources.delimited import malformed, physical_lines, read_delimited, store_delimited, well_formed
from sluice.sources.extracts import cached_extract, key_extract, younger_than

LEAD = "L1,1,2,Name,5,City,ST,US,U,R,3,USD,10"


def write(path, *lines, end="\n"):
    with open(path, "w", newline="") as out:
        out.write(end.join(lines) + end)
    return path


def test_malformed_lines_are_set_apart(spark, folder):
    header = ",".join(f for f in schemas.LEAD_FILE.fieldNames() if f != schemas.CORRUPT)
    good = [LEAD, LEAD.replace("City", '"Port, North"'), LEAD.replace("L1", "").replace(",5,", ",,")]
    bad = {
        "wrong type": LEAD.replace(",5,", ",xx,"),
        "too few": LEAD.rsplit(",", 1)[0],
        "too many": LEAD + ",more",
        "overflow": LEAD.replace(",5,", ",99999999999,"),
    }
    path = write(folder + "/leads.csv", header, *good, *bad.values(), end="\r\n")
    stored = store_delimited(spark, path, schemas.LEAD_FILE)
    assert sorted(r[schemas.CORRUPT] for r in malformed(stored).collect()) == sorted(bad.values())
    kept = well_formed(stored).orderBy("FILE_RECORD_NUM").collect()
    assert [r.FILE_RECORD_NUM for r in kept] == [1, 2, 3]
    assert kept[1].city == "Port, North"
    assert kept[2].leadNumber is None and kept[2].dealSize is None
    assert kept[0].BudgetAmount == 10
    broken = stored.filter("FILE_RECORD_NUM = 4").first()
    assert broken.dealSize is None and broken.leadName == "Name"
    assert physical_lines(spark, path) == 8


def test_text_and_inferred_reads(spark, folder):
    path = write(folder + "/s.csv", "schoolID,schoolName,n", '1,"Hill, North",2', "2,,3")
    plain = read_delimited(spark, path)
    assert rows(plain) == [("1", "Hill, North", "2"), ("2", None, "3")]
    assert [f.dataType.simpleString() for f in read_delimited(spark, path, infer=True).schema] == ["int", "string", "int"]


def test_sinks(spark, folder):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string").repartition(2)
    write_csv(df, folder + "/out")
    write_csv(df, folder + "/out", partitions=1)
    assert len([f for f in os.listdir(folder + "/out") if f.endswith(".csv")]) == 1
    assert rows(read_delimited(spark, folder + "/out", df.schema)) == [(1, "x"), (2, "y")]
    write_csv(df, folder + "/by", by="b")
    assert {f for f in os.listdir(folder + "/by") if f.startswith("b=")} == {"b=x", "b=y"}
    create_csv(df, folder + "/once")
    with pytest.raises(AnalysisException):
        create_csv(df, folder + "/once")


def test_rows_of_large_files_are_written_where_they_are(spark, folder):
    df = spark.range(400, numPartitions=4).select("id", (F.col("id") % 2).alias("b"))
    for name, few, want in (("few", files.FILE_ROWS - 1, 1), ("many", files.FILE_ROWS, 4)):
        write_csv(df, f"{folder}/{name}", by="b", rows_per_file=few)
        write_csv(df, f"{folder}/{name}-even", even=True, rows_per_file=few, compression="gzip")
        parts = {b: len([f for f in os.listdir(f"{folder}/{name}/b={b}") if f.endswith(".csv")]) for b in (0, 1)}
        assert parts == {0: want, 1: want}
        assert len([f for f in os.listdir(f"{folder}/{name}-even") if f.endswith(".csv.gz")]) == want
        assert rows(read_delimited(spark, f"{folder}/{name}", df.schema)) == rows(df)
        assert rows(read_delimited(spark, f"{folder}/{name}-even", df.schema)) == rows(df)


def test_more_folders_than_open_files(spark, folder):
    df = spark.range(200, numPartitions=2).select("id", (F.col("id") % 50).alias("b"))
    write_csv(df, f"{folder}/out", by="b", rows_per_file=files.FILE_ROWS)
    assert rows(read_delimited(spark, f"{folder}/out", df.schema)) == rows(df)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_extract_is_built_once(spark, folder):
    data = spark.createDataFrame(
        [(1, "US", datetime(2020, 1, 1)), (2, "DE", datetime(2020, 1, 1)), (3, "US", datetime(2019, 1, 1))],
        "id long, lang string, made timestamp_ntz",
    )
    builds = []

    def build():
        builds.append(1)
        recent = younger_than("made", 100, datetime(2020, 2, 1))
        return key_extract(data, "id", "party_id", F.col("lang").like("US") & recent)

    for _ in range(2):
        assert rows(cached_extract(spark, folder + "/extract", build)) == [("1",)]
    assert builds == [1]
    os.remove(folder + "/extract/_SUCCESS")  # without the marker it may lack files
    for f in glob.glob(folder + "/extract/*.parquet"):
        os.remove(f)
    os.makedirs(folder + "/broken/_temporary/0")
    for name in ("/extract", "/broken"):
        assert rows(cached_extract(spark, folder + name, build)) == [("1",)]
    assert len(builds) == 3


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_stamps(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    text = "10-JAN-21 01.02.03.000004000 PM"
    df = audit(spark.range(1), text, "GS1")
    row = df.first()
    assert row.CREATION_DATE == row.LAST_UPDATE_DATE == datetime(2021, 1, 10, 13, 2, 3, 4)
    assert (row.CREATED_BY, row.LAST_UPDATED_BY) == ("GS1", "GS1")
    assert audit(spark.range(1), datetime(2020, 5, 6), "x").first().CREATION_DATE == datetime(2020, 5, 6)
    assert df.schema["CREATION_DATE"].dataType == T.TimestampNTZType()
    assert df.select(parse_audit_text(F.lit(None).cast("string")).alias("t")).first().t is None
    assert batch(df, 7).first().BATCH_ID == 7
    assert 0 <= new_batch_id() < 1_000_000
    assert rename(spark.range(1), {"id": "KEY"}).columns == ["KEY"]
    nulls = spark.createDataFrame([(1,), (None,)], "n int")
    assert rows(as_text(nulls)) == [("1",), (None,)]


def test_staging_attributes_follow_the_layout():
    wide = schemas.staging_renames(schemas.LEAD_FILE_WIDE)
    assert wide["LeadNumber"] == "ATTRIBUTE_SMALL_CHAR002"
    assert wide["BudgetAmount"] == "ATTRIBUTE_SMALL_CHAR010"
    assert wide["currCode"] == "ATTRIBUTE_SMALL_CHAR014"
    assert len(schemas.staging_renames(schemas.LEAD_FILE_NARROW)) == 9


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert scratch_root(spark).startswith(shared)
    stored = materialize(spark.range(3), "t")
    assert stored.count() == 3
    assert scratch_root(spark) in stored.inputFiles()[0]


class Recorder:
    """Stands in for a reader or writer and keeps what was set; no database is started."""

    def __init__(self):
        self.calls = {}

    def options(self, **kw):
        self.calls.update(kw)
        return self

    def option(self, name, value):
        self.calls[name] = value
        return self

    def format(self, name):
        return self.option("format", name)

    def mode(self, name):
        return self.option("mode", name)

    def save(self):
        self.calls["saved"] = True

    load = lambda self: self
    orderBy = lambda self, *columns: self.option("order", columns)
    read = write = property(lambda self: self)


def test_jdbc_options():
    out = Recorder()
    jdbc_sink.append_table(out, "t", {"url": "jdbc:x"}, partitions=4, batch_size=50)
    assert out.calls == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "t", "numPartitions": 4, "batchsize": 50,
        "mode": "append", "saved": True,
    }
    source = Recorder()
    jdbc_source.read_table(
        source, "t", {"url": "jdbc:x"}, partition_column="id", bounds=(1, 9), partitions=3, order_by=["id"]
    )
    assert source.calls["partitionColumn"] == "id" and source.calls["numPartitions"] == 3
    assert source.calls["order"] == ("id",)
    with pytest.raises(ValueError):
        jdbc_source.read_table(Recorder(), "t", {}, partition_column="id")


def test_scratch_can_be_cleared(spark):
    stored = materialize(spark.range(5), "few")
    assert stored.count() == 5 and os.path.isdir(scratch_root(spark))
    clear_scratch(spark)
    assert not os.path.exists(scratch_root(spark))
    assert materialize(spark.range(5), "few").count() == 5
