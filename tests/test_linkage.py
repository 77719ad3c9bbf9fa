import base64
import json
import zipfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kinveil import cli
from kinveil.operators import blocking, clk, evaluate, extract, households, links, profile
from kinveil.operators.positions import with_position
from kinveil.sources import files

SECRET = "0123456789abcdef" * 2
CONF = {
    "date_format": "%m/%d/%Y", "initial_id": 100,
    "translation_map": {
        "given_name": "First", "family_name": "Last", "DOB": "Born", "phone": "Phone", "address": ["Street Line", "Detail"], "zip": "Zip",
        "default_values": {"sex": "F", "Detail": "N/A"}, "value_mapping_rules": {"phone": {"1234567890": "PLACEHOLDER/UNKNOWN"}, "Detail": {"N/A": ""}},
    },
}
CSV = 'First,Last,Born,Phone,Street line,detail,ZIP\nAda,"O\'Neil, Jr",05/07/1977,1234567890,1 Oak St , ,00123\nZoë,Li,1/2/2000,(555) 010-0002 x8,2 Elm Rd,Apt 3,28557\nBo,"Two\nLines",,,,,\n'


def test_rfc_5869():
    okm = clk.hkdf(bytes.fromhex("0b" * 22), 42, bytes.fromhex("000102030405060708090a0b0c"), bytes.fromhex("f0f1f2f3f4f5f6f7f8f9"))
    assert okm.hex() == "3cb25f25faacd57a90434f64d0362f2a2d2d0a90cf1a5a4c5db02d56ecc4c5bf34007208d5b887185865"


def test_secrets():
    assert clk.check_secret(f" {SECRET}\n") == SECRET
    for bad in ("abc", "zz" * 16):
        with pytest.raises(ValueError, match="secret") as e:
            clk.check_secret(bad)
        assert bad not in str(e.value)
    with pytest.raises(ValueError, match="context"):
        clk.subkey(SECRET, "x")


def test_filters(spark):
    assert clk.tokens("AB", 2) == [" A", "AB", "B "] and clk.tokens("F", 1) == ["F"] and clk.tokens("", 2) == [] and clk.shares(300, 7) == [43] * 6 + [42]
    schema = clk.SCHEMAS["name-sex-dob-zip"]
    rows = [("ADA", "LI", "1977-05-07", "F", "00123"), ("ADA", "LI", "1977-05-07", "F", "00123"), ("ADA", "LEE", "", "", None)]
    df = spark.createDataFrame(rows, "given_name string, family_name string, DOB string, sex string, household_zip string")
    got = [bytes(r.x) for r in clk.clks(df, {"x": schema}, SECRET).collect()]
    assert got[0] == got[1] != got[2] and all(len(g) == 512 for g in got) and 0 < sum(map(int.bit_count, got[0])) <= 4 * 300 + 200
    with pytest.raises(ValueError, match="doubleHash"):
        clk.Schema.of(json.loads(json.dumps(schema).replace("blakeHash", "doubleHash")))
    folded = blocking.lambda_fold(spark.createDataFrame([(g,) for g in got], "clk binary"), 3, 5, 0).collect()
    assert len(folded) == 9 and {r.block for r in folded[:3]} == {r.block for r in folded[3:6]}
    bits = "".join(f"{b:08b}" for b in got[0])
    assert [r[0] for r in spark.createDataFrame([(got[0],)], "clk binary").select(F.explode(F.array(*[blocking.bit(F.col("clk"), i) for i in (0, 9, 4095)]))).collect()] == [int(bits[i]) for i in (0, 9, 4095)]


def test_translation(spark, tmp_path):
    (tmp_path / "in.csv").write_text(CSV, encoding="utf-8")
    rows = files.positioned(files.read_csv(spark, str(tmp_path / "in.csv")))
    got = extract.from_csv(rows, extract.Translation.of(CONF)).orderBy("position").collect()
    assert [tuple(r) for r in got] == [
        (0, "100", "ADA", "O'NEIL, JR", "1977-05-07", "F", "PLACEHOLDER/UNKNOWN", "1 OAK ST", "00123"),
        (1, "101", "ZOE", "LI", "2000-01-02", "F", "55501000028", "2 ELM RD APT 3", "28557"),
        (2, "102", "BO", "TWO\nLINES", "", "F", "", "", ""),
    ]
    assert extract.config_issues(CONF) == [] and len(extract.config_issues({})) == 9
    assert extract.resolve(["a", "B", "b"], "b") == "b" and extract.resolve(["X", "x "], "x") == "X" and extract.resolve([], "x") is None


def test_households_are_a_partition(spark):
    rows = [(0, "p0", "LEE", "1", "5 GARDEN ST", "1"), (1, "p1", "LEE", "1", "5 GAREDN ST", "1"), (2, "p2", "LEE", "1", "", "1"), (3, "p3", "KIM", "", "5 GARDEN ST", "1"), (4, "p4", None, None, None, None), (5, "p5", "LEE", "1", "5 GARDEN ST", "2")]
    people = spark.createDataFrame(rows, "position long, record_id string, family_name string, phone_number string, household_street_address string, household_zip string")
    got = {r.position: r.household for r in households.assign(people).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 5}
    table = households.households(people, households.assign(people)).orderBy("household_position").collect()
    assert [r.members for r in table] == [[0, 1], [2], [3], [4], [5]] and table[0].record_ids == "p0,p1" and [r.household_position for r in table] == list(range(5))
    mixed = households.households(people, households.assign(people), seed=3).collect()
    assert sorted(m for r in mixed for m in r.members) == list(range(6)) and sorted(r.household_position for r in mixed) == list(range(5))
    same = spark.createDataFrame([(0, 3)], "a long, b long")
    assert {r.position: r.household for r in households.assign(people, pairs=same).collect()}[3] == 0
    assert {r.position: r.household for r in households.assign(people, exact_addresses=True).collect()} == {0: 0, 1: 1, 2: 2, 3: 0, 4: 4, 5: 5}


def test_links_and_scores(spark):
    people = spark.createDataFrame([(0, "a"), (1, "b")], "position long, record_id string")
    ok = links.resolve_links(spark.createDataFrame([("L1", 1)], "LINK_ID string, position long"), people).collect()
    assert [tuple(r) for r in ok] == [("L1", "b")]
    with pytest.raises(Exception, match="no row for position 7"):
        links.resolve_links(spark.createDataFrame([("L1", 7)], "LINK_ID string, position long"), people).collect()
    assert len(links.metadata_issues({"a": 1, "b": 2, "d": 0}, {"b": 3, "c": 1, "d": 0})) == 3
    found = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", 2)], "pid string, household long")
    true = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("d", 2)], "pid string, household long")
    r = evaluate.pair_score(found, true).first()
    assert (r.tp, r.found, r.true) == (1, 2, 3)
    empty = spark.createDataFrame([], "household_position long, pid string, line long")
    none = evaluate.score(empty, spark.createDataFrame([], "household_position long, household_id string"), spark.createDataFrame([], "pid string, household_id string")).first()
    assert none.precision is None and none.tp == 0


def test_positions_and_profile(spark):
    df = spark.createDataFrame([(i * 7 % 101, "x" if i % 3 else None) for i in range(101)], "k long, DOB string").repartition(5)
    assert [r.position for r in with_position(df, ["k"]).orderBy("k").collect()] == list(range(101))
    people = spark.createDataFrame([("1", "A", "B", "300101", "F", "12", "x", "NA"), ("2", "A", None, None, None, None, " ", "5")], "record_id string, given_name string, family_name string, DOB string, sex string, phone_number string, household_street_address string, household_zip string")
    stats, private = profile.profile(profile.missing_as_null(people))
    assert stats["row_count"] == 2 and stats["DOB"]["min_dob"] == "1930-01-01" and stats["zip"] == {"5": 1} and private["given_name"] == {}
    assert stats["fields"]["household_street_address"]["blank"] == 1


def test_round_trip(spark, tmp_path, monkeypatch):
    """extract, garble, households, and resolving what an agent returns."""
    monkeypatch.chdir(tmp_path)
    Path("in.csv").write_text(CSV, encoding="utf-8")
    Path("conf.json").write_text(json.dumps(CONF))
    Path("secret").write_text(SECRET)
    cli.main(["extract", str(tmp_path / "in.csv"), "--csv_config", "conf.json", "--seed", "1"])
    pii = str(Path(files.newest("temp-data")).resolve())
    assert files.same_time(pii, json.loads(Path(files.metadata_path(pii)).read_text()))
    Path("schemas").mkdir()
    for k in ("name-sex-dob-zip", "name-sex-dob-phone"):
        Path(f"schemas/{k}.json").write_text(json.dumps(clk.SCHEMAS[k]))
    cli.main(["garble", pii, "schemas", "secret"])
    names = zipfile.ZipFile("output/garbled.zip").namelist()
    assert len(names) == 3
    encoded = json.loads(zipfile.ZipFile("output/garbled.zip").read("name-sex-dob-zip.json"))["clks"]
    assert len(encoded) == 3 and all(len(base64.b64decode(c)) == 512 for c in encoded)
    cli.main(["households", pii, "secret", "-t"])
    assert files.metadata_in_zip("output/garbled_households.zip")["number_of_households"] == 3
    metadata = json.loads(Path(files.metadata_path(pii)).read_text())
    with zipfile.ZipFile("links.zip", "w") as z:
        z.writestr("links.csv", "LINK_ID,pos\nX,2\nY,0\n")
        z.writestr("metadata.json", json.dumps({"input_system_metadata": metadata}))
    cli.main(["linkid_to_patid", "--sourcefile", pii, "--linkszip", "links.zip"])
    ids = [line.split(",")[0] for line in Path(pii).read_text().splitlines() if line[:1] == "1"]
    assert sorted(Path("output/linkid_to_patid.csv").read_text().split()) == sorted(["LINK_ID,PATID", f"X,{ids[2]}", f"Y,{ids[0]}"])
    with pytest.raises(ValueError, match="metadata"):
        zipfile.ZipFile("none.zip", "w").close()
        files.metadata_in_zip("none.zip")
    assert isinstance(datetime.fromisoformat(metadata["garble_time"]), datetime)
