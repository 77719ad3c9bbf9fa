"""From source tables or CSV rows to canonical person records, and what is wrong with them."""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinveil.functions import clean

#: The canonical record, and the physical names of its fields in each source version.
HEADER = [
    "record_id", "given_name", "family_name", "DOB", "sex", "phone_number", "household_street_address", "household_zip"
]
VERSIONS: dict[str, dict[str, str | list[str]]] = {
    "v1": {"record_id": "patid", "given_name": "given_name", "family_name": "family_name", "DOB": "birth_date", "sex": "sex", "phone_number": "household_phone", "household_street_address": "household_street_address", "household_zip": "household_zip"},
    "v2": {"record_id": "patid", "given_name": "pat_firstname", "family_name": "pat_lastname", "DOB": "birth_date", "sex": "sex", "phone_number": "primary_phone", "household_street_address": ["address_street", "address_detail"], "household_zip": "address_zip5"},
    "csv": {n: n for n in HEADER},
}
#: Names of the last three fields in translation configs.
SHORT = {"phone_number": "phone", "household_street_address": "address", "household_zip": "zip"}


def resolve(columns: list[str], name: str) -> str | None:
    """The column of that name, else the first whose lower case is the same, else None."""
    if name in columns:
        return name
    return next((c for c in columns if c.lower() == name.lower()), None)


def lookup(df: DataFrame, name: str | list[str]) -> Column:
    """A field by its physical name or names; parts join by spaces, absent ones (but the first) are left out."""
    quoted = lambda c: F.col(f"`{c}`").cast("string")
    if isinstance(name, str):
        found = resolve(df.columns, name)
        return quoted(found) if found else F.lit(None).cast("string")
    first = resolve(df.columns, name[0])
    if first is None:
        raise KeyError(name[0])
    rest = [c for c in (resolve(df.columns, n) for n in name[1:]) if c]
    return clean.joined(quoted(first), *map(quoted, rest))


def mapped(c: Column, rules: dict[str, str] | None) -> Column:
    """rules.get(c, c)."""
    if not rules:
        return c
    pairs = [F.lit(x) for kv in rules.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)


def from_table(df: DataFrame, version: str = "v2", date_column: bool = True, id_column: str | None = None) -> DataFrame:
    """Canonical records of a v1 or v2 table (addresses joined already). Ids stay as they are."""
    names = VERSIONS[version] | ({"record_id": id_column} if id_column else {})
    dob = resolve(df.columns, str(names["DOB"]))
    born = F.lit("") if dob is None else clean.iso_date(F.col(dob)) if date_column else clean.clean_dob(
        F.col(dob), "%Y-%m-%d"
    )
    fields = {
        "record_id": lookup(df, names["record_id"]),
        "given_name": clean.clean_string(lookup(df, names["given_name"])),
        "family_name": clean.clean_string(lookup(df, names["family_name"])),
        "DOB": born,
        "sex": clean.clean_sex(lookup(df, names["sex"])),
        "phone_number": clean.clean_phone(lookup(df, names["phone_number"])),
        "household_street_address": clean.clean_string(lookup(df, names["household_street_address"])),
        "household_zip": clean.clean_zip(lookup(df, names["household_zip"])),
    }
    return df.select(*(c.alias(n) for n, c in fields.items()))


@dataclass
class Translation:
    """A CSV translation config."""

    date_format: str
    columns: dict[str, str | list[str]] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)
    rules: dict[str, dict[str, str]] = field(default_factory=dict)
    initial_id: int = 0

    @classmethod
    def of(cls, conf: dict) -> Translation:
        known = dict(conf.get("translation_map", {}))
        defaults, rules = known.pop("default_values", {}), known.pop("value_mapping_rules", {})
        return cls(conf["date_format"], known, defaults, rules, int(conf.get("initial_id", 0)))


def config_issues(conf: dict) -> list[str]:
    """What a translation config lacks: the date format, the map, and each field's column or default."""
    out = [f"{k} is missing" for k in ("date_format", "translation_map") if k not in conf]
    known = conf.get("translation_map", {})
    for name in (SHORT.get(n, n) for n in HEADER if n != "record_id"):
        if name not in known and name not in known.get("default_values", {}):
            out.append(f"{name} has neither a column nor a default")
    return out


def translated(df: DataFrame, key: str, conf: Translation) -> Column:
    """One field under a config. Of several columns each is cleaned (its default where blank) and then
    mapped under the configured name; a single one is mapped under its header's name and then cleaned."""
    wanted = conf.columns.get(key, key)
    default = lambda k: clean.clean_string(F.lit(conf.defaults.get(k, "")))
    if isinstance(wanted, list):
        parts = []
        for name in wanted:
            found = resolve(df.columns, name)
            value = default(name)
            if found:
                text = clean.strip(F.col(f"`{found}`"))
                value = F.when(F.coalesce(text, F.lit("")) != "", clean.clean_string(text)).otherwise(value)
            parts.append(mapped(value, conf.rules.get(name)))
        return clean.joined(*parts)
    found = resolve(df.columns, wanted)
    if not found:
        return default(key)
    raw = F.col(f"`{found}`")
    filled = F.coalesce(clean.strip(raw), F.lit("")) != ""
    return F.when(filled, clean.clean_string(mapped(raw, conf.rules.get(found)))).otherwise(default(key))


def from_csv(
    df: DataFrame, conf: Translation, position: str = "position", strict: bool = True, keep_ids: bool = False
) -> DataFrame:
    """Canonical records (with position) of all-string CSV rows. Rows of blank id are numbered from
    initial_id in the order of position. keep_ids leaves ids as they are in the file."""
    get = lambda key: translated(df, key, conf)
    again = lambda c, key: mapped(clean.clean_string(c), conf.rules.get(key))
    own = resolve(df.columns, str(conf.columns.get("record_id", "record_id")))
    record_id = clean.strip(F.col(f"`{own}`")) if keep_ids and own else get("record_id")
    out = df.select(
        F.col(position).alias("position"),
        F.coalesce(record_id, F.lit("")).alias("record_id"),
        again(get("given_name"), "given_name").alias("given_name"),
        again(get("family_name"), "family_name").alias("family_name"),
        mapped(clean.clean_dob(get("DOB"), conf.date_format, strict), conf.rules.get("DOB")).alias("DOB"),
        mapped(clean.strip(get("sex")), conf.rules.get("sex")).alias("sex"),
        mapped(clean.clean_phone(get("phone")), conf.rules.get("phone")).alias("phone_number"),
        again(get("address"), "address").alias("household_street_address"),
        mapped(clean.clean_zip(get("zip")), conf.rules.get("zip")).alias("household_zip"),
    )
    return with_ids(out, conf.initial_id)


def with_ids(records: DataFrame, initial: int = 0) -> DataFrame:
    """Ids initial, initial + 1, .. for rows of blank id, by position. Counted by blocks of positions, so
    that no task numbers all of them."""
    blank = records.where("record_id = ''").withColumn("__blk", F.expr("position div 65536"))
    ahead = blank.groupBy("__blk").agg(F.count("*").alias("__n"))
    ahead = ahead.select(
        "__blk",
        (F.sum("__n").over(W.orderBy("__blk").rowsBetween(W.unboundedPreceding, 0)) - F.col("__n")).alias("__ahead"),
    )
    nth = F.row_number().over(W.partitionBy("__blk").orderBy("position")) - 1
    named = blank.join(ahead, "__blk").withColumn("record_id", (F.lit(initial) + F.col("__ahead") + nth).cast("string"))
    return records.where("record_id <> ''").unionByName(named.drop("__blk", "__ahead"))


def addresses(
    people: DataFrame,
    places: DataFrame,
    mode: str = "full",
    key: str = "patid",
    preferred: str = "address_preferred",
    start: str = "address_period_start",
    tie: str = "addressid",
) -> DataFrame:
    """People with addresses. single: one row for each; preferred: those marked Y; full: the marked one
    that began last (unknown starts last, then the least id). Who has none is left out."""
    if mode not in ("single", "preferred", "full"):
        raise ValueError(mode)
    if mode != "single":
        places = places.where(F.col(preferred) == "Y")
    if mode == "full":
        latest = W.partitionBy(key).orderBy(F.desc_nulls_last(start), F.asc(tie))
        places = places.withColumn("__nth", F.row_number().over(latest)).where("__nth = 1").drop("__nth")
    return people.join(places, key)


def issues(df: DataFrame, fields: list[str], allowed: dict[str, list[str]] | None = None) -> DataFrame:
    """(field, issue, n) of all fields by one aggregation, no row for counts of 0."""
    allowed = allowed or {}
    kinds = [
        "NULL Value", "Contains Non-ASCII Characters", "Contains Non-printable Characters", "Empty String", "No Mapping"
    ]

    def tests(name: str) -> list[Column]:
        c = F.col(f"`{name}`")
        known = ~c.isin(*allowed[name]) if name in allowed else F.lit(False)
        return [c.isNull(), ~clean.is_ascii(c), ~clean.is_printable(c), clean.is_blank_text(c), known]

    counts = [F.count_if(t).alias(f"{i}_{k}") for i, name in enumerate(fields) for k, t in enumerate(tests(name))]
    one = df.agg(*counts)
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("field"), F.lit(kind).alias("issue"), F.col(f"{i}_{k}").alias("n"))
            for i, name in enumerate(fields)
            for k, kind in enumerate(kinds)
        ]
    )
    return one.select(F.explode(rows).alias("r")).select("r.*").where("n > 0")


def shuffled(df: DataFrame, seed: int | None = None) -> DataFrame:
    """Rows in a random order (a given one with a seed)."""
    return df.orderBy(F.rand(seed))


def jdbc_options(source: str) -> dict[str, str]:
    """Reader options of a database given as a JDBC url, or as driver://user:password@host:port/database."""
    if source.startswith("jdbc:"):
        return {"url": source}
    at = urlsplit(source)
    if not at.scheme or not (at.hostname or at.path):
        raise ValueError(f"{source} names no database")
    kind = at.scheme.split("+")[0]
    host = f"//{at.hostname}{f':{at.port}' if at.port else ''}" if at.hostname else ""
    out = {"url": f"jdbc:{kind}:{host}{at.path}" + (f"?{at.query}" if at.query else "")}
    return out | ({"user": unquote(at.username)} if at.username else {}) | (
        {"password": unquote(at.password)} if at.password else {}
    )


def read_table(
    spark: SparkSession,
    name: str,
    schema: str | None = None,
    split: str | None = None,
    parts: int = 0,
    fetch: int = 10_000,
    **jdbc: str,
) -> DataFrame:
    """A catalog table, or with a url (and driver options) a table of another database.

    Without a numeric column to split by, a database table is read by one task, `fetch` rows a trip; with
    one, by `parts` tasks (by default as many as shuffle partitions) over the column's range, which the
    database is asked for first. Nulls of that column are read by the first task."""
    full = f"{schema}.{name}" if schema else name
    if "url" not in jdbc:
        return spark.table(full)
    reader = spark.read.format("jdbc").options(fetchsize=str(fetch), **jdbc)
    if split:
        low, high = reader.option("query", f"select min({split}) as lo, max({split}) as hi from {full}").load().first()
        if low is not None:
            parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
            reader = spark.read.format("jdbc").options(fetchsize=str(fetch), **jdbc)
            reader = reader.options(
                partitionColumn=split, lowerBound=str(int(low)), upperBound=str(int(high) + 1), numPartitions=str(parts)
            )
    return reader.option("dbtable", full).load()
