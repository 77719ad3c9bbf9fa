"""Queries of the record-linkage engine over the driver's tables, and the SQL that checks them.

The tables have no people. PII is one statement that both engines run unchanged and that makes one
person of every customer and the part of the same number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinveil.functions import clean
from kinveil.functions.similarity import jaro_winkler_column
from kinveil.operators import blocking, clk, evaluate, extract, households, links, profile
from kinveil.operators.staging import stage

PII = """
select position, record_id, given_name, family_name, date '1940-01-01' + cast((position * 7919) % 25000 as int) as dob, sex, phone_number,
  case when position % 17 = 0 then '' else concat(cast(101 + 37 * (position % 3) as varchar(20)), ' ',
    case when position % 11 = 0 then concat(substring(given_name, 2, 1), substring(given_name, 1, 1), substring(given_name, 3)) else given_name end, ' ',
    case when position % 2 = 0 then 'ST' else 'STREET' end,
    case when position % 5 = 0 then concat(' APT ', cast(1 + position % 2 as varchar(20))) else '' end) end as household_street_address,
  household_zip
from (select c_custkey as position, concat('P', cast(c_custkey as varchar(20))) as record_id,
    upper(split_part(p_name, ' ', 1)) as given_name, upper(split_part(p_name, ' ', 2)) as family_name,
    case when c_custkey % 3 = 0 then 'F' when c_custkey % 3 = 1 then 'M' else '' end as sex,
    case when c_custkey % 13 = 0 then '' when c_custkey % 4 = 0 then concat('(555) 010-', lpad(cast(c_custkey % 100 as varchar(20)), 4, '0'))
      else concat('555.010.', lpad(cast(c_custkey % 100 as varchar(20)), 4, '0')) end as phone_number,
    lpad(cast(c_nationkey as varchar(20)), 5, '0') as household_zip
  from customer join part on p_partkey = c_custkey) people
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
SECRET = "00112233445566778899aabbccddeeff"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pii(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        PII.replace("from customer join part", "from {customer} join {part}"),
        customer=table(spark, sf, "customer"),
        part=table(spark, sf, "part"),
    )


def people(spark: SparkSession, sf: str) -> DataFrame:
    """pii with the phone as digits and the date as text."""
    return pii(spark, sf).withColumn(
        "phone_number", clean.clean_phone(F.col("phone_number"))
    ).withColumn("DOB", clean.iso_date(F.col("dob")))


WITH = f"with pii as ({PII}), people as (select * replace (regexp_replace(phone_number, '[^0-9]', '', 'g') as phone_number) from pii)"


@query(
    f"""{WITH} select record_id, given_name, family_name, strftime(dob, '%Y-%m-%d') dob, sex, phone_number, household_street_address, household_zip from people"""
)
def extract_clean(spark, sf):
    messy = pii(spark, sf).select(
        F.col("record_id").alias("PatID"),
        F.lower("given_name").alias("pat_firstname"),
        F.concat(F.lit(" \t"), "family_name", F.lit(" ")).alias("pat_lastname"),
        F.col("dob").alias("birth_date"),
        F.concat("sex", F.lit(" ")).alias("sex"),
        F.col("phone_number").alias("primary_phone"),
        F.col("household_street_address").alias("address_street"),
        F.lit(None).cast("string").alias("address_detail"),
        F.concat(F.lit("\n"), "household_zip").alias("address_zip5"),
    )
    return extract.from_table(messy, "v2").withColumnRenamed("DOB", "dob")


@query(
    f"""{WITH} select record_id, given_name, family_name, strftime(dob, '%Y-%m-%d') dob, sex, phone_number,
  household_street_address, household_zip from people"""
)
def extract_v1(spark, sf):
    """The older source version: one table with the address in one field and an id column of another name."""
    messy = pii(spark, sf).select(
        F.col("record_id").alias("Person"),
        F.lower("given_name").alias("GIVEN_NAME"),
        F.concat(F.lit(" "), "family_name", F.lit("\t")).alias("family_name"),
        F.col("dob").alias("birth_date"),
        F.concat("sex", F.lit(" ")).alias("sex"),
        F.col("phone_number").alias("household_phone"),
        F.lower("household_street_address").alias("household_street_address"),
        F.concat(F.lit("\t"), "household_zip", F.lit(" ")).alias("household_zip"),
    )
    return extract.from_table(messy, "v1", id_column="person").withColumnRenamed("DOB", "dob")


CLEAN_SQL = "trim(regexp_replace(strip_accents({0}), '[^\\x00-\\x7F]', '', 'g'), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || ' ')"


@query(
    f"select doc_id, upper({CLEAN_SQL.format('text')}) cleaned, upper({CLEAN_SQL.format('lang')}) lang from documents"
)
def clean_strings(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", clean.clean_string(F.col("text")).alias("cleaned"), clean.clean_string(F.col("lang")).alias("lang")
    )


def _history(spark, sf):
    who = table(spark, sf, "customer").select(F.col("c_custkey").alias("patid"), F.col("c_name").alias("name"))
    where = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("patid"),
        F.col("o_orderkey").alias("addressid"),
        F.when(F.col("o_orderstatus") == "O", "Y").otherwise("N").alias("address_preferred"),
        F.to_date("o_orderdate").alias("address_period_start"),
        F.col("o_orderpriority").alias("address_street"),
    )
    return who, where


HISTORY = "select c_custkey patid, c_name as name, o_orderkey addressid, case when o_orderstatus = 'O' then 'Y' else 'N' end address_preferred, cast(o_orderdate as date) address_period_start, o_orderpriority address_street from customer join orders on c_custkey = o_custkey"


@query(HISTORY)
def address_single(spark, sf):
    return extract.addresses(*_history(spark, sf), "single")


@query(f"select * from ({HISTORY}) where address_preferred = 'Y'")
def address_preferred(spark, sf):
    return extract.addresses(*_history(spark, sf), "preferred")


@query(
    f"select * exclude (n) from (select *, row_number() over (partition by patid order by address_period_start desc nulls last, addressid) n from ({HISTORY}) where address_preferred = 'Y') where n = 1"
)
def address_latest_preferred(spark, sf):
    return extract.addresses(*_history(spark, sf), "full")


CONFIG = {
    "date_format": "%m/%d/%Y",
    "initial_id": 100000,
    "translation_map": {
        "given_name": "First Name", "family_name": "Last Name", "DOB": "Born", "phone": "Phone", "address": ["Street", "Detail"], "zip": "Zip",
        "default_values": {"sex": "F", "Detail": "N/A"},
        "value_mapping_rules": {"sex": {"Female": "F"}, "phone": {"5550100001": "PLACEHOLDER/UNKNOWN"}, "Detail": {"N/A": ""}, "given_name": {"RED": "ROT"}},
    },
}


@query(f"""{WITH} select position, case when position % 2 = 0 then cast(99999 + row_number() over (partition by position % 2 order by position) as varchar) else record_id end record_id,
  case when given_name = 'RED' then 'ROT' else given_name end given_name, family_name, strftime(dob, '%Y-%m-%d') dob, 'F' sex,
  case when phone_number = '5550100001' then 'PLACEHOLDER/UNKNOWN' else phone_number end phone_number, household_street_address, household_zip from people""")
def csv_translate(spark, sf):
    rows = pii(spark, sf).select(
        "position",
        F.when(F.col("position") % 2 == 1, F.col("record_id")).otherwise("").alias("record_id"),
        F.lower("given_name").alias("first name"),
        F.col("family_name").alias("Last Name"),
        F.date_format("dob", "M/d/yyyy").alias("Born"),
        F.col("phone_number").alias("Phone"),
        F.col("household_street_address").alias("Street"),
        F.lit(" ").alias("detail"),
        F.col("household_zip").alias("Zip"),
    )
    return extract.from_csv(rows, extract.Translation.of(CONFIG)).withColumnRenamed("DOB", "dob")


@query(f"{WITH} select record_id, case sex when 'F' then 'Female' when 'M' then 'Male' else sex end sex from people")
def value_mapping(spark, sf):
    return pii(spark, sf).select("record_id", extract.mapped(F.col("sex"), {"F": "Female", "M": "Male"}).alias("sex"))


@query("""select * from (
  select 'text' field, 'Contains Non-ASCII Characters' issue, count(*) filter (not regexp_matches(text, '^[\\x00-\\x7F]*$')) n from documents
  union all select 'text', 'Contains Non-printable Characters', count(*) filter (regexp_matches(text, '[\\pC\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]')) from documents
  union all select 'lang', 'No Mapping', count(*) filter (lang not in ('en', 'de')) from documents) where n > 0""")
def validation_report(spark, sf):
    return extract.issues(table(spark, sf, "documents"), ["text", "lang"], {"lang": ["en", "de"]})


@query(
    f"{WITH} select count(*) row_count, count(distinct record_id) distinct_ids, cast(null as bigint) repeated_ids from people"
)
def profile_counts(spark, sf):
    return profile.counts(pii(spark, sf))


@query(
    f"{WITH} select family_name as value, count(*) n from people group by 1 having count(*) >= 3 order by n desc, 1 limit 10"
)
def profile_top_n(spark, sf):
    return profile.top(pii(spark, sf), F.col("family_name"), 10, 3)


SHAPE = "regexp_replace(regexp_replace({0}, '\\pN', '#', 'g'), '\\pL', 'X', 'g')"


@query(
    f"{WITH} select 'phone' field, {SHAPE.format('phone_number')} as value, count(*) n from pii group by 2 union all select 'zip', {SHAPE.format('household_zip')}, count(*) from pii group by 2"
)
def profile_formats(spark, sf):
    df = pii(spark, sf)
    one = (
        lambda f,
        c: profile.top(df, clean.shape(F.col(c))).select(F.lit(f).alias("field"), "value", "n")  # noqa: E731,
    )
    return one("phone", "phone_number").unionByName(one("zip", "household_zip"))


@query(f"""{WITH}, l as (select unnest(['given_name', 'family_name', 'household_street_address', 'household_zip', 'phone_number']) field, unnest([given_name, family_name, household_street_address, household_zip, phone_number]) v from people)
  select field, count(*) filter (v is null or trim(v) = '') blank, count(v) n, round(avg(length(v)), 9) mean, round(stddev_samp(length(v)), 9) std, cast(min(length(v)) as int) least,
  quantile_cont(length(v), 0.25) q25, quantile_cont(length(v), 0.5) q50, quantile_cont(length(v), 0.75) q75, cast(max(length(v)) as int) most from l group by 1""")
def profile_lengths(spark, sf):
    return profile.lengths(people(spark, sf)).withColumns({c: F.round(c, 9) for c in ("mean", "std")})


@query(f"""{WITH}, l as (select unnest(['given_name', 'family_name', 'household_street_address', 'household_zip', 'phone_number']) field, unnest([given_name, family_name, household_street_address, household_zip, phone_number]) v from people),
  c as (select field, unnest(string_split(v, '')) as "character" from l where v <> '') select field, "character", count(*) n from c where "character" <> '' group by 1, 2""")
def profile_chars(spark, sf):
    return profile.characters(people(spark, sf))


@query(
    f"{WITH} select cast(min(dob) as varchar) min_dob, cast(max(dob) as varchar) max_dob, count(*) filter (dob is null) missing from people"
)
def dob_range(spark, sf):
    return profile.dates(pii(spark, sf), "dob")


@query(
    f"{WITH}, d as (select strptime(case when substring(y, 1, 1) in ('0', '1', '2') then '20' || y else '19' || y end, '%Y%m%d')::date d from (select strftime(dob, '%y%m%d') y from people)) select min(d) min_dob, max(d) max_dob from d"
)
def yymmdd(spark, sf):
    return profile.century_dates(pii(spark, sf).select(F.date_format("dob", "yyMMdd").alias("DOB")))


PARSED = WITH + """, parsed as (select *, split_part(household_street_address, ' ', 1) n, split_part(household_street_address, ' ', 2) s, split_part(household_street_address, ' ', 3) x,
  split_part(household_street_address, ' ', 4) p, split_part(household_street_address, ' ', 5) v, household_street_address as raw from people)"""
BLOCKS = "from parsed a join parsed b on a.household_zip = b.household_zip and a.position < b.position and a.raw <> '' and b.raw <> '' and ((a.s = b.s and a.n = b.n) or a.family_name = b.family_name)"


@query(f"{PARSED} select a.position a, b.position b {BLOCKS}")
def block_candidates(spark, sf):
    return blocking.candidates(households.prepared(people(spark, sf))).select("a", "b")


@query(
    f"{WITH} select a.position a, b.position b from people a join people b using (household_zip, household_street_address) where a.position < b.position and household_street_address <> ''"
)
def block_exact(spark, sf):
    return blocking.exact(people(spark, sf))


@query(
    f"{WITH}, n as (select distinct family_name f from people) select a.f a, b.f b, round(jaro_winkler_similarity(a.f, b.f), 9) similarity from n a join n b on left(a.f, 1) = left(b.f, 1) and a.f < b.f union all select a.f, g.g, round(jaro_winkler_similarity(a.f, g.g), 9) from n a join (select distinct given_name g from people) g on left(a.f, 1) = left(g.g, 1)"
)
def jw_surname(spark, sf):
    df = pii(spark, sf)
    names = df.select(F.col("family_name").alias("a")).distinct()
    surnames = names.join(names.withColumnRenamed("a", "b"), F.expr("left(a, 1) = left(b, 1) and a < b"))
    given = names.join(df.select(F.col("given_name").alias("b")).distinct(), F.expr("left(a, 1) = left(b, 1)"))
    return surnames.unionByName(given).select(
        "a", "b", F.round(jaro_winkler_column(F.col("a"), F.col("b")), 9).alias("similarity")
    )


def _jw(a: str, b: str) -> str:
    return f"jaro_winkler_similarity({a}, {b})"


# Address similarity over parts that are all there or (the unit) absent: what PII has.
_STREET = f"greatest(0.8 * {_jw('a.s', 'b.s')} + case when {_jw('a.s', 'b.s')} > 0 then 0.2 * {_jw('a.x', 'b.x')} else 0 end, {_jw('a.s || chr(32) || a.x', 'b.s')}, {_jw('b.s || chr(32) || b.x', 'a.s')}, 0.7 * {_jw('a.s', 'b.s')})"
_UNIT = f"case when a.v <> '' and b.v <> '' then greatest(0.8 * {_jw('a.v', 'b.v')} + 0.2 * {_jw('a.p', 'b.p')}, {_jw('a.p || chr(32) || a.v', 'b.v')}, {_jw('b.p || chr(32) || b.v', 'a.v')}, 0.7 * {_jw('a.v', 'b.v')}, 0.8 * {_jw('a.p || a.v', 'b.p || b.v')}) else 0 end"
_HAMMING = "(cast(a.n[1] = b.n[1] as int) + cast(a.n[2] = b.n[2] as int) + cast(a.n[3] = b.n[3] as int)) / 3.0::double"
_FLAT = f"greatest(0.5 * {_HAMMING} + 0.5 * {_STREET}, 0.6 * {_jw('a.raw', 'b.raw')})"
_UNITS = f"greatest(0.3 * {_HAMMING} + 0.5 * {_STREET}, 0.48 * {_jw('a.raw', 'b.raw')}) + 0.2 * {_UNIT}"
ADDRESS = f"case when a.raw = b.raw then 1.0::double when a.v = '' and b.v = '' then {_FLAT} else {_UNITS} end"
PAIRS = PARSED + f""", near as (select a.position a, b.position b, a.family_name fa, b.family_name fb, a.phone_number pa, b.phone_number pb, {ADDRESS} as address {BLOCKS}),
  scored as (select a, b, {_jw('fa', 'fb')} as family_name, case when pa = '' or pb = '' then 0.0::double else {_jw('pa', 'pb')} end as phone_number, address from near where address > 0.95),
  pairs as (select *, 0.25::double * family_name + 0.2::double * phone_number + 0.55::double * address as score from scored)"""


@query(
    f"{PAIRS} select a, b, round(family_name, 9) family_name, round(phone_number, 9) phone_number, round(address, 9) address, round(score, 9) score from pairs where score > 0.85"
)
def match_pairs(spark, sf):
    out = households.scored(people(spark, sf), above=households.TOTAL_ABOVE)
    return out.select("a", "b", *(F.round(c, 9).alias(c) for c in ("family_name", "phone_number", "address", "score")))


COMPONENTS = PAIRS.replace("with pii", "with recursive pii", 1) + """, e as (select a, b from pairs where score > 0.85 union all select b, a from pairs where score > 0.85),
  r as (select position a, position c from people union select e.b, r.c from r join e on e.a = r.a), assigned as (select a as position, min(c) household from r group by 1)"""
HOUSEHOLDS = COMPONENTS + """, grouped as (select household, list(position order by position) members, string_agg(record_id, ',' order by position) record_ids from assigned join people using (position) group by 1),
  numbered as (select row_number() over (order by household) - 1 household_position, * from grouped)"""


@query(f"{COMPONENTS} select position, household from assigned")
def household_members(spark, sf):
    return households.assign(people(spark, sf))


def _households(spark, sf):
    return households.households(people(spark, sf))


@query(
    f"{HOUSEHOLDS} select household_position, array_to_string(members, ',') members, family_name, phone_number, household_street_address, household_zip, record_id representative, record_ids from numbered join people on position = household"
)
def household_table(spark, sf):
    return _households(spark, sf).withColumn(
        "members", F.concat_ws(",", F.transform("members", lambda x: x.cast("string")))
    )


@query(
    f"{COMPONENTS}, n as (select count(*) n from assigned group by household) select count(*) households, avg(n) mean, round(stddev_samp(n), 9) std, min(n) least, quantile_cont(n, 0.25) q25, quantile_cont(n, 0.5) q50, quantile_cont(n, 0.75) q75, max(n) most from n"
)
def household_sizes(spark, sf):
    return households.sizes(households.assign(people(spark, sf))).withColumn("std", F.round("std", 9))


@query(
    f"{WITH} select household_zip, household_street_address, count(*) members, min(position) household from people where household_street_address <> '' group by 1, 2"
)
def households_exact(spark, sf):
    own = people(spark, sf)
    return households.assign(own, exact_addresses=True).join(
        own.where("household_street_address <> ''"), "position"
    ).groupBy("household_zip", "household_street_address", "household").agg(F.count("*").alias("members"))


@query(f"{HOUSEHOLDS} select household_position, unnest(string_split(record_ids, ',')) pid from numbered")
def household_scoring_rows(spark, sf):
    return households.scoring_rows(_households(spark, sf))


@query(
    f"{WITH} select 'L' || cast((position * 31) % 100003 as varchar) as \"LINK_ID\", record_id as \"PATID\" from people"
)
def link_resolve(spark, sf):
    own = pii(spark, sf)
    given = own.select(
        F.concat(F.lit("L"), ((F.col("position") * 31) % 100003).cast("string")).alias("LINK_ID"), "position"
    )
    return links.resolve_links(given, own)


@query(
    f"{HOUSEHOLDS} select 'H' || cast(household_position as varchar) as \"HOUSEHOLD_ID\", unnest(string_split(record_ids, ',')) as \"PATID\" from numbered"
)
def household_link_resolve(spark, sf):
    """Every household has a link, and all of its members get it."""
    found = stage(_households(spark, sf).select("household_position", "record_ids"), "found")
    given = found.select(
        F.concat(F.lit("H"), F.col("household_position").cast("string")).alias("HOUSEHOLD_ID"),
        F.col("household_position").alias("position"),
    )
    return links.resolve_households(given, found)


@query(
    f"{WITH} select distinct record_id, 'S' || cast(position % 50 as varchar) seed_record_id, household_zip household_id, 'site_' || cast(position % 3 as varchar) file_name from people"
)
def answer_key(spark, sf):
    row = F.struct(
        "record_id",
        F.concat(F.lit("S"), (F.col("position") % 50).cast("string")).alias("seed_record_id"),
        F.col("household_zip").alias("household_id"),
        F.concat(F.lit("site_"), (F.col("position") % 3).cast("string")).alias("file_name"),
    )
    documents = pii(spark, sf).select(F.to_json(F.create_map("record_id", F.array(row, row))).alias("value"))
    return evaluate.answer_key(documents)


@query(
    f"{WITH} select case when count(*) filter (position % 3 = 0) > 0 then household_zip end site_0, case when count(*) filter (position % 3 = 1) > 0 then household_zip end site_1, case when count(*) filter (position % 3 = 2) > 0 then household_zip end site_2 from people group by household_zip"
)
def answer_pivot(spark, sf):
    """All people over all three sites."""
    ids = pii(spark, sf).select(
        F.concat(F.lit("site_"), (F.col("position") % 3).cast("string")).alias("site"),
        F.col("household_zip").alias("household_id"),
    )
    return evaluate.by_site(ids, ["site_0", "site_1", "site_2"])


@query(f"""{HOUSEHOLDS}, key as (select distinct record_id pid, household_zip || household_street_address hid from people),
  last as (select household_position, record_id pid from numbered join people on position = members[len(members)]), mapped as (select household_position, household_zip || household_street_address hid from numbered join people on position = household),
  seen as (select count(*) n, count(key.pid) tp from last join mapped using (household_position) left join key using (pid, hid)), total as (select count(*) total from key),
  rates as (select tp, n - tp fp, total - tp fn, tp / n as precision, tp / total as recall from seen, total) select *, 2 * precision * recall / (precision + recall) as fscore from rates""")
def hh_score(spark, sf):
    own = people(spark, sf)
    hid = F.concat("household_zip", "household_street_address").alias("household_id")
    found = _households(spark, sf)
    found = stage(found.select("household_position", "record_ids", "household_zip", "household_street_address"), "found")
    scored = found.select("household_position", F.posexplode(F.split("record_ids", ",")).alias("line", "pid"))
    return evaluate.score(
        scored, found.select("household_position", hid), own.select(F.col("record_id").alias("pid"), hid)
    )


@query(f"""{WITH}, s as (select record_id k, sex v from people), l as (select case when sex = '' then 'N' || record_id else record_id end k, case when household_zip = '00007' then 'X' else sex end v from people)
  select coalesce(s.k, l.k) as key, case when l.k is null then 'source only' when s.k is null then 'linkage only' else 'differs' end issue, s.v source_value, l.v linkage_value from s full join l on s.k = l.k where l.k is null or s.k is null or s.v <> l.v""")
def metadata_diff(spark, sf):
    """All people on both sides; those without a sex go by another key in the second, those of one zip have another value."""
    own = pii(spark, sf)
    source = own.select(F.col("record_id").alias("key"), F.col("sex").alias("value"))
    key = F.when(F.col("sex") == "", F.concat(F.lit("N"), "record_id")).otherwise(F.col("record_id"))
    linkage = own.select(
        key.alias("key"), F.when(F.col("household_zip") == "00007", "X").otherwise(F.col("sex")).alias("value")
    )
    return links.metadata_diff(source, linkage)


@query(
    f"""{WITH}, spots as (select min(position) household_position, min_by(record_id, position) pid from people group by household_zip)
  select household_position as "HOUSEHOLD_POSITION",
  case when sex = 'F' then 'Z' || household_zip else household_zip end as "HOUSEHOLD_ID" from spots join people on pid = record_id"""
)
def answer_key_positions(spark, sf):
    """Positions to household ids through a key that names women twice: the later line counts."""
    own = pii(spark, sf)
    at = own.groupBy("household_zip").agg(
        F.min("position").alias("household_position"), F.min_by("record_id", "position").alias("pid")
    )
    first = own.select("record_id", F.col("household_zip").alias("household_id"), F.lit(1).alias("line"))
    later = own.where("sex = 'F'").select(
        "record_id", F.concat(F.lit("Z"), "household_zip").alias("household_id"), F.lit(2).alias("line")
    )
    return evaluate.position_households(at.select("household_position", "pid"), first.unionAll(later))


@query(
    f"""{WITH}, a as (select distinct household_zip z, household_street_address s from people where household_street_address <> '')
  select a.z household_zip, a.s a, b.s b, round(jaro_winkler_similarity(a.s, b.s), 9) similarity
  from a join a b on a.z = b.z and left(a.s, 5) = left(b.s, 5) and a.s < b.s"""
)
def jw_address(spark, sf):
    """Whole addresses of one zip that begin alike."""
    own = people(spark, sf).where("household_street_address <> ''")
    own = own.select("household_zip", F.col("household_street_address").alias("a")).distinct()
    own = own.withColumn("start", F.expr("left(a, 5)"))
    pairs = own.join(own.withColumnRenamed("a", "b"), ["household_zip", "start"]).where("a < b")
    similarity = jaro_winkler_column(F.col("a"), F.col("b"))
    return pairs.select("household_zip", "a", "b", F.round(similarity, 9).alias("similarity"))


GRAMS = "case when family_name = '' then [] else list_transform(range(1, length(family_name) + 2), lambda i: substring(' ' || family_name || ' ', i, 2)) end"


@query(
    f"{WITH}, g as (select record_id, {GRAMS} g from people) select record_id, array_to_string(g, '|') tokens, cast(len(g) as int) n, cast(300 // len(g) + case when 300 % len(g) > 0 then 1 else 0 end as int) most_bits, cast(300 // len(g) as int) least_bits from g"
)
def ngram_tokens(spark, sf):
    grams = F.transform(
        F.sequence(F.lit(1), F.length("family_name") + 1),
        lambda i: F.substring(F.concat(F.lit(" "), "family_name", F.lit(" ")), i, F.lit(2)),
    )
    n = F.size("g")
    return pii(spark, sf).where("family_name <> ''").select("record_id", grams.alias("g")).select(
        "record_id",
        F.concat_ws("|", "g").alias("tokens"),
        n.alias("n"),
        F.ceil(300 / n).cast("int").alias("most_bits"),
        F.floor(300 / n).cast("int").alias("least_bits"),
    )


@query()
def clk_individual(spark, sf):
    names = {k: v for k, v in clk.SCHEMAS.items() if k.startswith("name")}
    out = clk.clks(
        people(spark, sf).select(
            "position",
            "record_id",
            "given_name",
            "family_name",
            "DOB",
            "sex",
            "phone_number",
            "household_street_address",
            "household_zip",
        ),
        names,
        SECRET,
    )
    return out.select("position", *(F.base64(F.col(f"`{k}`")).alias(k.replace("-", "_")) for k in names))


@query()
def clk_household(spark, sf):
    out = clk.clks(_households(spark, sf), {"clk": clk.SCHEMAS["fn-phone-addr-zip"]}, SECRET, "households")
    return out.select("household_position", F.base64("clk").alias("clk"))


@query()
def block_lambda(spark, sf):
    own = clk.clks(
        people(spark, sf).select("position", "given_name", "family_name", "DOB", "sex", "household_zip"),
        {"clk": clk.SCHEMAS["name-sex-dob-zip"]},
        SECRET,
    )
    return blocking.lambda_fold(own, 3, 5, 0).select("position", "block")


P_SIG = {
    "blocking-features": [1], "filter": {"type": "ratio", "max": 0.02, "min": 0.0}, "blocking-filter": {"type": "bloom filter", "number-hash-functions": 4, "bf-len": 2048},
    "signatureSpecs": [[{"type": "characters-at", "config": {"pos": [0]}, "feature-idx": 1}, {"type": "characters-at", "config": {"pos": [0]}, "feature-idx": 2}], [{"type": "metaphone", "feature-idx": 1}, {"type": "metaphone", "feature-idx": 2}]],
}


@query()
def block_psig(spark, sf):
    """A row for each block of each person, with the block's bits; nulls for a person whose blocks the filter all drops."""
    own = people(spark, sf).select("given_name", "family_name", "position")
    rows, bits = blocking.p_sig(own, P_SIG)
    found = rows.select("position", "block").join(bits, "block").select(
        "position", "block", F.array_join("bits", ",").alias("bits")
    )
    return own.select("position").join(found, "position", "left")
