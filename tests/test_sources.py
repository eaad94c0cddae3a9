import datetime

import pytest
from pyspark.errors import AnalysisException

from beatmetrics.sources import readers, schemas, scratch, writers

HEADER = (
    "DR_NO,Date Rptd,DATE OCC,TIME OCC,AREA,AREA NAME,Rpt Dist No,Part 1-2,Crm Cd,Crm Cd Desc,"
    "Mocodes,Vict Age,Vict Sex,Vict Descent,Premis Cd,Premis Desc,Weapon Used Cd,Weapon Desc,"
    "Status,Status Desc,Crm Cd 1,Crm Cd 2,Crm Cd 3,Crm Cd 4,LOCATION,Cross Street,LAT,LON"
)
FULL = (
    '{id},01/08/2020 12:00:00 AM,12/31/2019 12:00:00 AM,2230,03,Southwest,0377,2,624,'
    '"BATTERY, SIMPLE",0444,{age},F,B,501,STREET,400,HANDS,AO,Adult Other,624,,,,'
    '"1100 W  39TH, PL",,34.0141,-118.2978'
)


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_incidents_of_two_files(spark, tmp_path):
    first = write(tmp_path / "a.csv", HEADER, FULL.format(id="1", age="36"))
    second = write(
        tmp_path / "b.csv",
        HEADER,
        FULL.format(id="2", age=""),
        FULL.format(id="3", age="many"),
        "4,bad date,,0100",
    )
    df = readers.read_incidents(spark, [first, second])
    assert df.columns == schemas.INCIDENTS.fieldNames()
    assert len(df.columns) == 28
    got = {r.incident_id: r for r in df.collect()}
    assert sorted(got) == ["1", "2", "3", "4"]
    one = got["1"]
    assert one.date_reported == datetime.date(2020, 1, 8)
    assert one.date_occ == datetime.date(2019, 12, 31)
    assert (one.crime_desc, one.address) == ("BATTERY, SIMPLE", "1100 W  39TH, PL")
    assert (one.victim_age, one.premise, one.weapon_code) == (36, "STREET", "400")
    assert (one.lat, one.lon) == (34.0141, -118.2978)
    assert got["2"].victim_age is None and got["3"].victim_age is None
    assert got["3"].lat == 34.0141
    assert got["4"].date_occ is None and got["4"].date_reported is None
    assert got["4"].time_occ == "0100" and got["4"].lat is None


def test_columns_are_bound_by_position(spark, tmp_path):
    """The header's own names do not matter, not even odd letters in them."""
    header = HEADER.replace("AREA NAME", "AREA ΝΑΜΕ")
    df = readers.read_incidents(spark, write(tmp_path / "a.csv", header, FULL.format(id="1", age="1")))
    assert df.first().area_name == "Southwest"


def test_incomes(spark, tmp_path):
    path = write(
        tmp_path / "i.csv",
        "Zip Code,Community,Estimated Median Income",
        '90001,"Los Angeles (South), Florence","$33,887"',
        "90002,Watts,",
        "90003,Nowhere,n/a",
    )
    got = [tuple(r) for r in readers.read_incomes(spark, path).orderBy("zip").collect()]
    assert got == [
        ("90001", "Los Angeles (South), Florence", 33887),
        ("90002", "Watts", None),
        ("90003", "Nowhere", None),
    ]


def test_geozip_and_stations(spark, tmp_path):
    geo = write(tmp_path / "g.csv", "LAT,LON,ZIPcode", "34.1,-118.2,90001-1234", "34.2,-118.3,90002")
    got = [tuple(r) for r in readers.read_geozip(spark, geo).orderBy("lat").collect()]
    assert got == [(34.1, -118.2, "90001"), (34.2, -118.3, "90002")]
    path = write(
        tmp_path / "s.csv",
        "X,Y,FID,DIVISION,LOCATION,PREC",
        '-118.28,33.75,1,HARBOR,"2175 JOHN S. GIBSON BLVD., SUITE 1",5',
    )
    row = readers.read_stations(spark, path).first()
    assert (row.lon, row.lat, row.fid, row.division, row.prec) == (-118.28, 33.75, 1, "HARBOR", 5)


def test_csv_sink_replaces_and_text_sink_refuses(spark, tmp_path):
    df = spark.createDataFrame([("NIGHT", 42), ("MORNING", 7)], "segment string, n bigint")
    path = str(tmp_path / "out.csv")
    writers.write_csv(df.limit(1), path)
    writers.write_csv(df, path)
    back = spark.read.csv(path, header=True, schema=df.schema)
    assert sorted(map(tuple, back.collect())) == [("MORNING", 7), ("NIGHT", 42)]
    text = str(tmp_path / "out.txt")
    writers.write_pairs_text(df, text, "segment", "n")
    assert sorted(r.value for r in spark.read.text(text).collect()) == [
        "('MORNING', 7)",
        "('NIGHT', 42)",
    ]
    with pytest.raises(AnalysisException):
        writers.write_pairs_text(df, text, "segment", "n")


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Session:
    def __init__(self, **settings):
        self.conf = Conf({k.replace("_", "."): v for k, v in settings.items()})


def test_scratch_folder_comes_from_the_session():
    shared = scratch.scratch_path(
        Session(spark_checkpoint_dir="hdfs://shared/tmp/", spark_master="yarn"), "t"
    )
    assert shared.startswith("hdfs://shared/tmp/t-")
    session = Session(spark_sql_warehouse_dir="hdfs://shared/warehouse")
    other = scratch.scratch_path(session, "t")
    assert other.startswith("hdfs://shared/warehouse/scratch/t-")
    assert other != scratch.scratch_path(session, "t")


def test_doubled_quotes(spark, tmp_path):
    path = tmp_path / "incomes.csv"
    path.write_text('Zip Code,Community,Income\n90001,"The ""Old"" Town, East","$33,887"\n')
    row = readers.read_incomes(spark, str(path)).first()
    assert (row.community, row.median_income) == ('The "Old" Town, East', 33887)
