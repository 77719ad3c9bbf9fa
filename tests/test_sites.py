"""Commands over several sites at once."""

import csv
import io
import json
import zipfile

from kinveil import cli
from kinveil.operators import clk
from kinveil.sources import files

SECRET = "0123456789abcdef" * 2
HEADER = ["record_id", "given_name", "family_name", "DOB", "sex", "phone_number", "household_street_address", "household_zip"]


def people(site, n):
    return [[f"{site}{i}", f"GIVEN{i % 3}", f"NAME{i // 2}", f"2001-02-0{1 + i % 9}", "FM"[i % 2], f"555010{i // 2:04d}", f"{100 + i // 2} OAK ST", "00123"] for i in range(n)]


def write(path, header, rows):
    with open(path, "w", newline="") as out:
        csv.writer(out).writerows([header, *rows])


def test_sites(spark, tmp_path, capsys):
    sites = {"site_a": people("A", 7), "site_b": people("B", 4)}
    for site, rows in sites.items():
        write(tmp_path / f"pii_{site}.csv", HEADER, rows)
        write(tmp_path / f"{site}_key.csv", ["record_id", "household_id", "seed_record_id"], [[r[0], r[0][0] + r[2], r[0]] for r in rows])
    (tmp_path / "secret").write_text(SECRET)
    (tmp_path / "block.json").write_text(json.dumps({"type": "lambda-fold", "version": 1, "config": {"Lambda": 2, "K": 4, "input-clks": True, "random_state": 1}}))
    common = ["--folder", str(tmp_path), "--sites", ",".join(sites)]
    cli.main(["garble_sites", str(tmp_path / "inbox"), str(tmp_path / "secret"), "--blockschema", str(tmp_path / "block.json"), *common])
    names = sorted(n for n in clk.SCHEMAS if n.startswith("name"))
    assert sorted(p.name for p in (tmp_path / "inbox").iterdir()) == ["site_a.zip", "site_a_block.zip", "site_b.zip", "site_b_block.zip"]
    for site, rows in sites.items():
        own = clk.clks(files.read_people(spark, str(tmp_path / f"pii_{site}.csv")), {names[0]: clk.SCHEMAS[names[0]]}, SECRET).orderBy("position").collect()
        with zipfile.ZipFile(tmp_path / "inbox" / f"{site}.zip") as z:
            assert sorted(z.namelist()) == [f"{n}.json" for n in names]
            assert json.loads(z.read(f"{names[0]}.json"))["clks"] == [clk.text(bytes(r[names[0]])) for r in own]
        with zipfile.ZipFile(tmp_path / "inbox" / f"{site}_block.zip") as z:
            assert sorted(z.namelist()) == [f"{n}_blocks.csv" for n in names]
            blocks = list(csv.reader(io.StringIO(z.read(f"{names[0]}_blocks.csv").decode())))[1:]
            assert len(blocks) == 2 * len(rows) and {int(b[0]) for b in blocks} == set(range(len(rows)))

    cli.main(["hh_all_sites", *common])
    for site, rows in sites.items():
        mapped = list(csv.DictReader(open(tmp_path / f"{site}_mapping.csv")))
        assert len(mapped) == len({r[6] for r in rows})
        scored = list(csv.DictReader(open(tmp_path / f"{site}_hh_scoring.csv")))
        assert sorted(r["pid"] for r in scored) == sorted(r[0] for r in rows)
    assert (tmp_path / "full_answer_key.csv").exists() and "fscore" in capsys.readouterr().out
