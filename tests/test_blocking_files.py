"""Which record is in which block: of each CLK file, of a person CSV, and in the queries."""

import base64
import csv
import io
import json
import random
import zipfile

from kinveil import cli
from kinveil.operators.blocking import bloom_bits
from kinveil.plans import linkage

SF = "/root/testdata/sf0.001"


def members(archive):
    with zipfile.ZipFile(archive) as z:
        return {n: [tuple(r) for r in csv.reader(io.StringIO(z.read(n).decode()))] for n in z.namelist()}


def test_lambda_fold_file_by_file(spark, tmp_path):
    rng, bits = random.Random(2), random.Random(0)
    at = [bits.sample(range(4096), 5) for _ in range(3)]
    (tmp_path / "clks").mkdir()
    want = {}
    for name, n in (("one", 4), ("two", 6)):
        clks = [rng.randbytes(512) for _ in range(n)]
        (tmp_path / f"clks/{name}.json").write_text(json.dumps({"clks": [base64.b64encode(c).decode() for c in clks]}))
        blocks = [(str(p), f"{t}:" + "".join(str(c[i // 8] >> (7 - i % 8) & 1) for i in x)) for p, c in enumerate(clks) for t, x in enumerate(at)]
        want[f"{name}_blocks.csv"] = [("position", "block"), *blocks]
    (tmp_path / "lambda.json").write_text(json.dumps({"type": "lambda-fold", "version": 1, "config": {"Lambda": 3, "K": 5, "random_state": 0}}))
    cli.main(["block", "--schemafile", str(tmp_path / "lambda.json"), "--clkpath", str(tmp_path / "clks"), "-o", str(tmp_path)])
    assert members(tmp_path / "blocks.zip") == want


def test_p_sig_file(spark, tmp_path):
    (tmp_path / "p.csv").write_text("given_name,family_name\nADA,LI\nAL,LEE\nBO,\n")
    config = {"filter": {"type": "ratio", "max": 1, "min": 0}, "blocking-filter": {"number-hash-functions": 4, "bf-len": 2048}, "signatureSpecs": linkage.P_SIG["signatureSpecs"][:1]}
    (tmp_path / "p.json").write_text(json.dumps({"type": "p-sig", "version": 1, "config": config}))
    cli.main(["block", "--schemafile", str(tmp_path / "p.json"), "--clkpath", str(tmp_path / "p.csv"), "-o", str(tmp_path)])
    bits = ",".join(map(str, bloom_bits("0_A_L", 4, 2048)))
    assert members(tmp_path / "blocks.zip") == {"p_blocks.csv": [("position", "block"), ("0", "0_A_L"), ("1", "0_A_L")], "p_block_bits.csv": [("block", "bits"), ("0_A_L", bits)]}


def test_queries_return_every_record(spark):
    every = {r.position for r in linkage.pii(spark, SF).collect()}
    folded = linkage.QUERIES["block_lambda"](spark, SF).collect()
    assert len(folded) == 3 * len(every) == len({(r.position, r.block.split(":")[0]) for r in folded}) and {r.position for r in folded} == every
    signed = linkage.QUERIES["block_psig"](spark, SF).collect()
    assert {r.position for r in signed} == every and any(r.block for r in signed) and all(r.bits for r in signed if r.block)
