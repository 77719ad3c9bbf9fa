"""CSV, JSON and ZIP files: what Spark reads goes through Spark, archives and documents through the driver."""

from __future__ import annotations

import csv
import io
import json
import re
import uuid
import zipfile
from collections.abc import Iterable
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinveil.operators.staging import stage

STAMP = "%Y%m%dT%H%M%S"


def read_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """All columns as text, quoted line breaks and doubled quotes understood, empty cells null."""
    return spark.read.csv(path, header=header, multiLine=True, escape='"', encoding="UTF-8")


def positioned(df: DataFrame, name: str = "position") -> DataFrame:
    """df with its row numbers in file order, from 0. A quoted CSV is one split a file, so order is the file's.
    Rows are written once with a number by split and place; what counts up is the splits."""
    rows = stage(df.withColumn("__id", F.monotonically_increasing_id()), "rows")
    split = F.shiftright("__id", 33)
    ahead = rows.groupBy(split.alias("__split")).agg(F.count("*").alias("__n"))
    ahead = ahead.select(
        "__split",
        (F.sum("__n").over(W.orderBy("__split").rowsBetween(W.unboundedPreceding, 0)) - F.col("__n")).alias("__ahead"),
    )
    place = F.col("__ahead") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    out = rows.withColumn("__split", split).join(F.broadcast(ahead), "__split")
    return out.select(place.alias(name), *(F.col(f"`{c}`") for c in df.columns))


def read_people(spark: SparkSession, path: str) -> DataFrame:
    """A person CSV with positions, empty cells as blanks."""
    df = positioned(read_csv(spark, path))
    return df.na.fill("", [c for c in df.columns if c != "position"])


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema="a long, b long")


def write_pairs(pairs: DataFrame, path: str) -> None:
    pairs.select("a", "b").write.csv(path)


def read_clks(spark: SparkSession, path: str) -> DataFrame:
    """(file, position, clk as base64) of CLK documents."""
    raw = spark.read.json(path, schema="clks array<string>", multiLine=True)
    return raw.select(F.input_file_name().alias("file"), F.posexplode("clks").alias("position", "clk"))


def write_csv(df: DataFrame, path: str, order: str | None = None) -> int:
    """One CSV file with a header, rows by order; streamed partition by partition, never whole in memory."""
    ordered = df.orderBy(order) if order else df
    names = [c for c in df.columns if c != order or c in ("household_position", "HOUSEHOLD_POSITION")]
    n = 0
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as out:
        w = csv.writer(out)
        w.writerow(names)
        for row in ordered.toLocalIterator(prefetchPartitions=True):
            w.writerow(["" if row[c] is None else row[c] for c in names])
            n += 1
    return n


def write_clks(df: DataFrame, clk: str, path: str) -> int:
    """A CLK document {"clks": [..]} in the order of position."""
    from kinveil.operators.clk import text

    n = 0
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="ascii") as out:
        out.write('{"clks": [')
        for row in df.select("position", clk).orderBy("position").toLocalIterator(prefetchPartitions=True):
            out.write((", " if n else "") + json.dumps(text(bytes(row[clk]))))
            n += 1
        out.write("]}")
    return n


def zip_members(archive: str, part: str) -> list[str]:
    with zipfile.ZipFile(archive) as z:
        return [n for n in z.namelist() if part in n]


def csv_in_zip(archive: str, several: bool = False) -> list[list[str]]:
    """Rows below the header of the first .csv member; more than one such member is an error unless several."""
    names = zip_members(archive, ".csv")
    if not names or (len(names) > 1 and not several):
        raise ValueError(f"{archive} has {len(names)} CSV files")
    with zipfile.ZipFile(archive) as z, z.open(names[0]) as f:
        return list(csv.reader(io.TextIOWrapper(f, "utf-8", newline="")))[1:]


def links_in_zip(spark: SparkSession, archive: str, name: str) -> DataFrame:
    """(name, position) of a linkage archive; negative positions are refused."""
    rows = [(r[0], int(r[1])) for r in csv_in_zip(archive, several=name == "HOUSEHOLD_ID")]
    if any(p < 0 for _, p in rows):
        raise ValueError(f"{archive} has a negative position")
    return spark.createDataFrame(rows, f"{name} string, position long")


def metadata_in_zip(archive: str) -> dict:
    """The first JSON member whose name has `metadata` in it; an error without one."""
    names = zip_members(archive, "metadata")
    if not names:
        raise ValueError(f"{archive} holds no metadata")
    with zipfile.ZipFile(archive) as z:
        return json.loads(z.read(names[0]))


def write_zip(archive: str, files: Iterable[str]) -> None:
    Path(archive).parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in files:
            z.write(f, Path(f).name)


def newest(folder: str, kind: str = "pii") -> str:
    """The file kind-STAMP.csv of the latest stamp."""
    found = {m[1]: p for p in Path(folder).glob(f"{kind}-*.csv") if (m := re.search(r"(\d{8}T\d{6})\.csv$", p.name))}
    if not found:
        raise FileNotFoundError(f"no {kind}-*.csv in {folder}")
    return str(found[max(found)])


def metadata_path(csv_path: str) -> str:
    p = Path(csv_path)
    return str(p.with_name(p.name.replace("pii", "metadata").replace(".csv", ".json")))


def new_metadata(n: int, created: datetime) -> dict:
    return {"number_of_records": n, "creation_date": created.isoformat(), "uuid1": str(uuid.uuid1())}


def same_time(csv_path: str, metadata: dict) -> bool:
    """Whether a file's stamp is its metadata's creation date, to the second."""
    m = re.search(r"(\d{8}T\d{6})", Path(csv_path).name)
    created = datetime.fromisoformat(metadata["creation_date"]).replace(microsecond=0)
    return bool(m) and datetime.strptime(m[1], STAMP) == created


def json_documents(folder: str) -> dict[str, dict]:
    return {p.stem: json.loads(p.read_text(encoding="utf-8")) for p in sorted(Path(folder).glob("*.json"))}
