"""Command line: python -m kinveil.cli COMMAND --help."""

from __future__ import annotations

import argparse
import json
import secrets
import shutil
from datetime import datetime
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinveil.operators import blocking, clk, evaluate, extract, households, links, profile
from kinveil.operators.positions import with_position
from kinveil.operators.staging import stage
from kinveil.sources import files


#: The names of the sites that take part.
SITES = "site_a,site_b,site_c,site_d,site_e,site_f"


def session() -> SparkSession:
    return SparkSession.builder.appName("kinveil").getOrCreate()


def _table(spark: SparkSession, a: argparse.Namespace):
    database = a.url or getattr(a, "source", None)
    url = extract.jdbc_options(database) if database else {}
    more = {"split": a.split_column, "parts": a.split_parts} if url else {}
    if a.schema == "v1":
        return extract.from_table(
            extract.read_table(spark, a.v1_table, a.v1_schema, **more, **url), "v1", id_column=a.v1_idcolumn
        )
    people, places = (
        extract.read_table(spark, t, a.schema_name, **more, **url)
        for t in ("private_demographic", "private_address_history")
    )
    joined = extract.addresses(people, places, a.address_selection)
    if a.debug_query:
        joined.explain("formatted")
    return extract.from_table(joined, "v2")


def run_extract(a: argparse.Namespace) -> None:
    """Person records from tables or a CSV, in random order, with their metadata."""
    spark, now = session(), datetime.now()
    if a.csv_config:
        conf = json.loads(Path(a.csv_config).read_text())
        if found := extract.config_issues(conf):
            print("\n".join(found))
        source = files.positioned(files.read_csv(spark, a.source))
        people = extract.from_csv(source, extract.Translation.of(conf)).drop("position")
    else:
        people = _table(spark, a)
    if a.verbose:
        extract.issues(people, [c for c in extract.HEADER if c not in ("record_id", "DOB")]).show(200, False)
    path = f"{a.outputdir}/pii-{now.strftime(files.STAMP)}.csv"
    n = files.write_csv(extract.shuffled(people.select(*extract.HEADER), a.seed), path)
    Path(files.metadata_path(path)).write_text(json.dumps(files.new_metadata(n, now)))


def _source(a: argparse.Namespace) -> tuple[str, dict, Path]:
    path = a.sourcefile or files.newest("temp-data")
    at = Path(files.metadata_path(path))
    metadata = json.loads(at.read_text())
    if not files.same_time(path, metadata):
        raise SystemExit(f"{path} and its metadata are of different times")
    return path, metadata, at


def run_garble(a: argparse.Namespace) -> None:
    """A CLK file for each schema of a folder, zipped with the metadata."""
    spark = session()
    path, metadata, at = _source(a)
    secret = clk.check_secret(Path(a.secretfile).read_text())
    schemas = files.json_documents(a.schemadir) if a.schemadir else {
        k: v for k, v in clk.SCHEMAS.items() if k.startswith("name")
    }
    metadata["garble_time"] = datetime.now().isoformat()
    out = clk.clks(files.read_people(spark, path), schemas, secret).cache()
    made = []
    for name in schemas:
        made.append(f"{a.outputdir}/{name}.json")
        if files.write_clks(out, name, made[-1]) != metadata["number_of_records"]:
            raise SystemExit(f"{name}: not as many CLKs as records")
    at.write_text(json.dumps(metadata))
    copy = Path(a.outputdir) / at.name
    copy.write_text(json.dumps(metadata))
    files.write_zip(f"{a.outputdir}/{a.outputzip}", [*made, str(copy)])
    copy.unlink()


def run_households(a: argparse.Namespace) -> None:
    """Households (inferred, or from a file), their CLKs and metadata."""
    spark = session()
    path, metadata, at = _source(a)
    secret = clk.check_secret(Path(a.secretfile).read_text())
    if a.householddef:
        found = files.positioned(files.read_csv(spark, a.householddef), "household_position")
    else:
        people = files.read_people(spark, path)
        pairs = files.read_pairs(spark, a.pairsfile) if a.pairsfile else None
        if a.debug and not pairs:
            pairs = households.matches(people, a.exact_addresses)
            files.write_pairs(pairs, f"{Path(a.mappingfile).parent}/pairs")
        seed = None if a.keep_order else secrets.randbits(31) if a.seed is None else a.seed
        found = households.households(people, households.assign(people, a.exact_addresses, pairs=pairs), seed)
        files.write_csv(households.mapping(found), a.mappingfile, "HOUSEHOLD_POSITION")
        folder = Path(a.mappingfile).parent
        if a.testrun:
            files.write_csv(households.scoring_rows(found), f"{folder}/hh_scoring.csv", "household_position")
            files.write_csv(households.representatives(found), f"{folder}/hh_pos_pid.csv", "household_position")
        if a.debug:
            households.sizes(households.assign(people, a.exact_addresses, pairs=pairs)).show()
        own = found.select(F.col("household_position").alias("position"), *households.FIELDS, "record_ids")
        files.write_csv(own, path.replace("pii-", "households_pii-"), "position")
    schemas = {
        Path(a.schemafile).stem: json.loads(Path(a.schemafile).read_text())
    } if a.schemafile else {"fn-phone-addr-zip": clk.SCHEMAS["fn-phone-addr-zip"]}
    name = next(iter(schemas))
    made = str(Path(a.output).with_name(f"{name}.json"))
    n = files.write_clks(
        clk.clks(found.withColumnRenamed("household_position", "position"), schemas, secret, "households"), name, made
    )
    metadata |= {
        "number_of_households": n,
        "household_garble_time": datetime.now().isoformat(),
        "households_inferred": not a.householddef,
    }
    copy = Path(a.output).with_name("households_" + at.name)
    copy.write_text(json.dumps(metadata))
    files.write_zip(a.output, [made, str(copy)])


def run_block(a: argparse.Namespace) -> None:
    """Blocks of CLK files by lambda-fold (a schema's bf-len, number of hashes and features say how filters are made
    of records, so they say nothing where the input is filters), or of a person CSV by p-sig: one CSV (position, block) for each file,
    and for p-sig one of the blocks' Bloom bits, in one archive."""
    spark, spec = session(), json.loads(Path(a.schemafile).read_text())
    conf = {k.replace("_", "-"): v for k, v in spec["config"].items()}
    made = []

    def write(rows, name: str, order: list[str]) -> None:
        made.append(f"{a.outputdir}/{name}.csv")
        files.write_csv(rows.orderBy(*order), made[-1])

    if spec["type"] == "lambda-fold":
        if not conf.get("input-clks", True):
            raise SystemExit("lambda-fold works on CLK files; input-clks has to be true")
        for clk_file in sorted(Path(a.clkpath).glob("*.json")):
            raw = files.read_clks(spark, str(clk_file)).withColumn("clk", F.unbase64("clk"))
            rows = blocking.lambda_fold(raw, conf["Lambda"], conf["K"], conf.get("random-state", 0))
            write(rows.select("position", "block"), f"{clk_file.stem}_blocks", ["position", "block"])
    else:
        people = files.read_people(spark, a.clkpath)
        # feature-idx counts the file's own columns, so position goes last.
        rows, bits = blocking.p_sig(people.select(*[c for c in people.columns if c != "position"], "position"), conf)
        stem = Path(a.clkpath).stem
        write(rows.select("position", "block"), f"{stem}_blocks", ["position", "block"])
        write(bits.select("block", F.array_join("bits", ",").alias("bits")), f"{stem}_block_bits", ["block"])
    files.write_zip(f"{a.outputdir}/blocks.zip", made)


def run_garble_sites(a: argparse.Namespace) -> None:
    """pii_SITE.csv of several sites to SITE.zip with a CLK file for each schema; with --blockschema also
    SITE_block.zip. The sites' records are garbled in one pass and told apart by a site column."""
    spark, sites = session(), a.sites.split(",")
    secret = clk.check_secret(Path(a.secretfile).read_text())
    schemas = files.json_documents(a.schemadir) if a.schemadir else {
        k: v for k, v in clk.SCHEMAS.items() if k.startswith("name")
    }
    people = [files.read_people(spark, f"{a.folder}/pii_{site}.csv").withColumn("site", F.lit(site)) for site in sites]
    out = stage(clk.clks(reduce(DataFrame.unionByName, people), schemas, secret), "clks")
    for site in sites:
        at, made = f"{a.inbox}/{site}", []
        for name in schemas:
            made.append(f"{at}/{name}.json")
            files.write_clks(out.where(F.col("site") == site), name, made[-1])
        files.write_zip(f"{a.inbox}/{site}.zip", made)
        if a.blockschema:
            main(["block", "--schemafile", a.blockschema, "--clkpath", at, "-o", at])
            Path(f"{at}/blocks.zip").rename(f"{a.inbox}/{site}_block.zip")
        shutil.rmtree(at)


def run_all_sites(a: argparse.Namespace) -> None:
    """Households of pii_SITE.csv of several sites, their mappings, the full key and the scores against SITE_key.csv."""
    spark = session()
    for site in a.sites.split(","):
        people = files.read_people(spark, f"{a.folder}/pii_{site}.csv")
        found = stage(households.households(people, households.assign(people), secrets.randbits(31)), "households")
        files.write_csv(households.scoring_rows(found), f"{a.folder}/{site}_hh_scoring.csv", "household_position")
        files.write_csv(
            households.representatives(found), f"{a.folder}/{site}_household_pos_pid.csv", "household_position"
        )
    run_answer_key_map(a)
    run_score(a)


def run_resolve(a: argparse.Namespace) -> None:
    """LINK_IDs and HOUSEHOLD_IDs of linkage archives to record ids."""
    spark = session()
    for source, archive, name in (
        (a.sourcefile, a.linkszip, "LINK_ID"), (a.hhsourcefile, a.hhlinkszip, "HOUSEHOLD_ID")
    ):
        if not (source and archive):
            continue
        own = json.loads(Path(files.metadata_path(source).replace("households_metadata", "metadata")).read_text())
        found = links.metadata_issues(own, files.metadata_in_zip(archive)["input_system_metadata"])
        if found:
            print("\n".join(found))
            if not a.force:
                raise SystemExit(f"{archive} was made from other data than {source}; --force goes on")
        given = files.links_in_zip(spark, archive, name)
        people = files.positioned(files.read_csv(spark, source))
        out = links.resolve_links(given, people) if name == "LINK_ID" else links.resolve_households(
            given, people.withColumnRenamed("position", "household_position")
        )
        files.write_csv(out, f"{a.outputdir}/{name.lower().replace('_', '')}_to_patid.csv")


def run_profile(a: argparse.Namespace) -> None:
    """A profile with counts, and a PRIVATE one with values."""
    spark = session()
    df = profile.missing_as_null(files.positioned(files.read_csv(spark, a.csv))) if a.csv else _table(spark, a)
    stats, private = profile.profile(df, bool(a.csv), "position" if a.csv else None)
    Path(a.outputdir).mkdir(parents=True, exist_ok=True)
    Path(f"{a.outputdir}/profile.json").write_text(json.dumps(stats, default=str, indent=1))
    Path(f"{a.outputdir}/PRIVATE_profile.json").write_text(json.dumps(private, default=str, indent=1))


def run_validate(a: argparse.Namespace) -> None:
    """Differences between the metadata of two archives."""
    found = links.metadata_issues(
        files.metadata_in_zip(a.source_archive), files.metadata_in_zip(a.linkage_archive)["input_system_metadata"]
    )
    print(f"{len(found)} differences")
    if a.verbose:
        print("\n".join(found))


def run_score(a: argparse.Namespace) -> None:
    """Precision, recall and F-score of each site's households (files SITE_key.csv and so on)."""
    spark = session()
    for site in a.sites.split(","):
        key = files.read_csv(spark, f"{a.folder}/{site}_key.csv").select(
            F.col("record_id").alias("pid"), "household_id"
        )
        scored = files.positioned(files.read_csv(spark, f"{a.folder}/{site}_hh_scoring.csv"), "line")
        mapped = files.read_csv(spark, f"{a.folder}/{site}_mapping.csv").toDF("household_position", "household_id")
        print(site)
        evaluate.score(scored, mapped, key).show()


def run_answer_key(a: argparse.Namespace) -> None:
    """An answer-key document to one CSV a site."""
    spark = session()
    key = evaluate.answer_key(spark.read.text(a.key, wholetext=True)).cache()
    for site in a.sites.split(","):
        people = files.read_csv(spark, f"{a.folder}/{site}.csv")
        files.write_csv(
            with_position(evaluate.site_key(key, people), ["record_id", "household_id", "seed_record_id"]),
            f"{a.folder}/{site}_key.csv",
            "position",
        )


def run_answer_key_map(a: argparse.Namespace) -> None:
    """Each site's positions to household ids (SITE_mapping.csv, from SITE_key.csv of build_key and
    SITE_household_pos_pid.csv, the hh_pos_pid.csv of households -t), and full_answer_key.csv of all sites."""
    spark, sites, ids = session(), a.sites.split(","), None
    for site in sites:
        key = files.positioned(
            files.read_csv(spark, f"{a.folder}/{site}_key.csv"), "line"
        ).na.fill("", ["household_id"])
        at = files.read_csv(spark, f"{a.folder}/{site}_household_pos_pid.csv").toDF("household_position", "pid")
        mapped = evaluate.position_households(
            at.withColumn("household_position", F.col("household_position").cast("long")), key
        )
        files.write_csv(mapped, f"{a.folder}/{site}_mapping.csv", "HOUSEHOLD_POSITION")
        own = key.select(F.lit(site).alias("site"), "household_id")
        ids = own if ids is None else ids.unionAll(own)
    files.write_csv(
        evaluate.by_site(ids, sites).orderBy(F.coalesce(*(F.col(f"`{x}`") for x in sites))),
        f"{a.folder}/full_answer_key.csv",
    )


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kinveil")
    sub = p.add_subparsers(required=True)

    def command(name: str, run, db: bool = False) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=run.__doc__)
        c.set_defaults(run=run)
        c.add_argument("-v", "--verbose", action="store_true")
        if db:
            c.add_argument("-s", "--schema", choices=["v1", "v2"], default="v2")
            c.add_argument("--v1.schema", dest="v1_schema", default="codi")
            c.add_argument("--v1.table", dest="v1_table", default="identifier")
            c.add_argument("--v1.idcolumn", dest="v1_idcolumn", default="patid")
            c.add_argument("--schema_name", default="cdm")
            c.add_argument("--address_selection", choices=["full", "preferred", "single"], default="full")
            c.add_argument("--debug_query", action="store_true")
            c.add_argument(
                "--url", help="database, as a JDBC url or driver://user:password@host/name; without one, catalog tables"
            )
            c.add_argument("--split_column", help="numeric column by whose range a database table is read in parts")
            c.add_argument("--split_parts", type=int, default=0)
        return c

    c = command("extract", run_extract, db=True)
    c.add_argument("source", nargs="?"), c.add_argument("--csv_config"), c.add_argument(
        "-o", "--outputdir", default="temp-data"
    ), c.add_argument("--seed", type=int)
    c = command("garble", run_garble)
    c.add_argument("sourcefile", nargs="?"), c.add_argument("schemadir"), c.add_argument("secretfile")
    c.add_argument("-z", "--outputzip", default="garbled.zip"), c.add_argument("-o", "--outputdir", default="output")
    c = command("households", run_households)
    c.add_argument(
        "sourcefile", nargs="?"
    ), c.add_argument("secretfile"), c.add_argument("-d", "--householddef"), c.add_argument("--schemafile")
    c.add_argument(
        "--mappingfile", default="output/households/households.csv"
    ), c.add_argument("-o", "--output", default="output/garbled_households.zip")
    c.add_argument("-t", "--testrun", action="store_true"), c.add_argument(
        "--split_factor", type=int, default=4, help="kept for old calls; Spark splits the work"
    )
    c.add_argument("--exact_addresses", action="store_true"), c.add_argument("--pairsfile"), c.add_argument(
        "--debug", action="store_true"
    ), c.add_argument("--seed", type=int, help="of the random order of households")
    c.add_argument(
        "--keep_order",
        action="store_true",
        help="households by their least position, which the order of the input shows through",
    )
    c = command("block", run_block)
    c.add_argument("--schemafile", required=True), c.add_argument("--clkpath", default="output"), c.add_argument(
        "-o", "--outputdir", default="output"
    )
    c = command("linkid_to_patid", run_resolve)
    for name in ("sourcefile", "linkszip", "hhsourcefile", "hhlinkszip"):
        c.add_argument(f"--{name}")
    c.add_argument("-o", "--outputdir", default="output"), c.add_argument("-f", "--force", action="store_true")
    c = command("data_analysis", run_profile, db=True)
    c.add_argument("--csv"), c.add_argument("-o", "--outputdir", default="output")
    c = command("validate_metadata", run_validate)
    c.add_argument("source_archive"), c.add_argument("linkage_archive")
    c = command("garble_sites", run_garble_sites)
    c.add_argument("inbox"), c.add_argument("secretfile"), c.add_argument("--schemadir"), c.add_argument(
        "--blockschema"
    )
    c.add_argument("--folder", default="temp-data"), c.add_argument("--sites", default=SITES)
    for name, run in (
        ("hh_score", run_score),
        ("build_key", run_answer_key),
        ("answer_key_map", run_answer_key_map),
        ("hh_all_sites", run_all_sites),
    ):
        c = command(name, run)
        c.add_argument("--folder", default="temp-data"), c.add_argument(
            "--sites", default="a,b,c,d,e,f"
        ), c.add_argument("--key", default="temp-data/key.json")
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(args)


if __name__ == "__main__":
    main()
