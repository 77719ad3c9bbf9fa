"""From an answer-key document to the CSVs that hh_score reads."""

import csv
import json

from kinveil import cli


def rows(path):
    return [tuple(r) for r in csv.reader(path.open())]


def test_build_map_score(spark, tmp_path, capsys):
    one = lambda i, h: {"record_id": i, "seed_record_id": "s", "household_id": h, "file_name": "f"}
    (tmp_path / "key.json").write_text(json.dumps({"h1": [one("1", "h1"), one("2", "h1"), one("1", "h1")], "h2": [one("3", "h2")], "h3": [one("4", "h3")]}))
    for site, ids, at in (("a", "123", [(0, 2), (1, 3)]), ("b", "14", [(0, 1), (1, 4)])):
        (tmp_path / f"{site}.csv").write_text("record_id\n" + "".join(f"{i}\n" for i in ids))
        (tmp_path / f"{site}_household_pos_pid.csv").write_text("household_position,pid\n" + "".join(f"{p},{i}\n" for p, i in at))
        (tmp_path / f"{site}_hh_scoring.csv").write_text("household_position,pid\n" + "".join(f"{p},{i}\n" for p, i in at))
    there = ["--folder", str(tmp_path), "--sites", "a,b", "--key", str(tmp_path / "key.json")]
    for command in ("build_key", "answer_key_map", "hh_score"):
        cli.main([command, *there])
    assert rows(tmp_path / "a_mapping.csv") == [("HOUSEHOLD_POSITION", "HOUSEHOLD_ID"), ("0", "h1"), ("1", "h2")]
    assert rows(tmp_path / "b_mapping.csv") == [("HOUSEHOLD_POSITION", "HOUSEHOLD_ID"), ("0", "h1"), ("1", "h3")]
    assert rows(tmp_path / "full_answer_key.csv") == [("a", "b"), ("h1", "h1"), ("h2", ""), ("", "h3")]
    assert capsys.readouterr().out.count("precision") == 2
