"""Business-shaped inputs derived by Spark from the driver tables (FIXTURES.md).

The reference works on two systems' company lists (firms with ``rec_id, name,
kuerzel, plz, strasse``; accounts with ``Id, Account_Name, Billing_Code,
Billing_Street``). No such data ships with it, so the queries derive both from
``pages``: a name is the whole ``<title>`` element of a page, white-space runs
collapsed, nothing cut. Near copies are whole titles with one character left
out, by a fixed rule on the page id. Every derivation is a plain projection of
the whole table, so the work grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, title): the whole title of every page, white-space runs collapsed, trimmed."""
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("k"),
        F.trim(F.regexp_replace(title, "[ \\t\\n\\f\\r]+", " ")).alias("title"))


def _txt(c) -> F.Column:
    return c.cast("string")


def firms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left system: even ``page_id``; NULL name every 14th, NULL plz every 22nd."""
    b = titles(spark, sf_dir).where(F.col("k") % 2 == 0)
    k = F.col("k")
    road = (F.when(k % 10 == 0, "Hauptstraße").when(k % 10 == 2, "Bahnhofstr.")
            .when(k % 10 == 4, "Müllerweg").when(k % 10 == 6, "Weststrasse")
            .when(k % 10 == 8, "Lindenallee"))
    suffix = (F.when(k % 3 == 0, F.concat(F.lit("-"), _txt(k % 90 + 3)))
              .when(k % 3 == 1, F.lit("a")).otherwise(F.lit("")))
    return b.select(
        _txt(k).alias("rec_id"),
        F.when(k % 14 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat("title", F.lit(" GmbH"))).alias("name"),
        F.col("title").alias("kuerzel"),
        F.when(k % 22 == 0, F.lit(None).cast("string"))
         .otherwise(F.lpad(_txt((k * 7919) % 99999), 5, "0")).alias("plz"),
        F.concat(road, F.lit(" "), _txt(k % 90 + 1), suffix).alias("strasse"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right system, one scan: per page up to two rows. Untrimmed name-only rows (odd ``page_id``), near
    copies of firm names (``page_id % 6 = 0``, one character left out), and rows that can match by
    address only (``page_id % 4 = 0``)."""
    k, title = F.col("k"), F.col("title")
    null = F.lit(None).cast("string")
    gap = (k % F.greatest(F.length(title), F.lit(1))).cast("int")   # characters before the one left out
    near = F.concat(F.substring(title, F.lit(1), gap), F.substring(title, gap + 2, F.length(title)))
    road = (F.when(k % 10 == 0, "Hauptstr.").when(k % 10 == 2, "Bahnhofstraße")
            .when(k % 10 == 4, "MÜLLERWEG").when(k % 10 == 6, "Weststraße")
            .when(k % 10 == 8, "Linden-Allee"))

    def row(number, name, code, street):
        return F.struct(_txt(number).alias("Id"), name.alias("Account_Name"), code.alias("Billing_Code"),
                        street.alias("Billing_Street"))

    rows = F.array(
        F.when(k % 2 == 1, row(k, F.concat(F.lit("  "), title, F.lit(" ")), null, null)),
        F.when(k % 6 == 0, row(k + 2000000, F.concat(near, F.lit(" Ltd")), null, null)),
        F.when(k % 4 == 0, row(
            k + 1000000,
            F.when(k % 12 == 0, F.concat(F.repeat(F.lit("qzx7"), 15), F.lit(" "), title))
             .when(k % 20 == 0, F.lit("Unrelated 4711"))
             .otherwise(F.concat(title, F.lit(" Niederlassung Nord"))),
            F.lpad(_txt((k * 7919) % 99999), 5, "0"),
            F.concat(road, F.lit(" "), _txt(k % 90 + 1)))))
    return (titles(spark, sf_dir).select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r"))
            .select("r.*"))


CITIES = ("Berlin", "Bad Homburg", "Köln", "Frankfurt am Main", "Ulm")


def labelled_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, line, tokens, labels): an address line per page in one of four orders, with its tokens' labels."""
    k = table(spark, sf_dir, "pages").select(F.col("page_id").alias("k"))
    roads = F.array(*[F.lit(r) for r in ("Hauptstraße", "Bahnhofstr.", "Am Alten Markt", "Müllerweg", "Lange Gasse", "Lindenallee")])
    key = F.col("k")
    road = F.get(roads, (key % 6).cast("int"))
    number = F.concat(_txt(key % 90 + 1), F.when(key % 3 == 0, F.concat(F.lit("-"), _txt(key % 90 + 3)))
                      .when(key % 3 == 1, F.lit("a")).otherwise(F.lit("")))
    code = F.lpad(_txt((key * 7919) % 99999), 5, "0")
    city = F.get(F.array(*[F.lit(c) for c in CITIES]), (key % 5).cast("int"))

    def part(text, label):
        words = F.split(text, " ")
        return F.transform(words, lambda w: F.struct(w.alias("token"), F.lit(label).alias("label")))

    comma, land = part(F.lit(","), "skip"), part(F.lit("Deutschland"), "country")
    street = F.concat(part(road, "road"), part(number, "house_number"))
    place = F.concat(part(code, "postcode"), part(city, "city"))
    cells = (F.when(key % 4 == 0, F.concat(street, comma, part(code, "postcode"), comma, land))
             .when(key % 4 == 1, F.concat(street, comma, place, comma, land))
             .when(key % 4 == 2, F.concat(place, comma, street))
             .otherwise(F.concat(part(city, "city"), comma, part(road, "road"))))
    words = F.transform("cells", lambda c: c["token"])
    return k.withColumn("cells", cells).select(
        "k", F.regexp_replace(F.array_join(words, " "), " ,", ",").alias("line"), words.alias("tokens"),
        F.transform("cells", lambda c: c["label"]).alias("labels"))


# The same derivations in DuckDB SQL, for the oracle queries.
SQL_TITLES = (
    "select page_id as k, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), "
    "'[ \\t\\n\\f\\r]+', ' ', 'g')) as title from pages")

SQL_FIRMS = f"""
select cast(k as varchar) as rec_id,
       case when k%14=0 then null else concat(title,' GmbH') end as name,
       title as kuerzel,
       case when k%22=0 then null else lpad(cast((k*7919)%99999 as varchar),5,'0') end as plz,
       concat(case k%10 when 0 then 'Hauptstraße' when 2 then 'Bahnhofstr.' when 4 then 'Müllerweg'
                        when 6 then 'Weststrasse' when 8 then 'Lindenallee' end, ' ',
              cast(k%90+1 as varchar),
              case when k%3=0 then concat('-',cast(k%90+3 as varchar)) when k%3=1 then 'a' else '' end)
         as strasse
from ({SQL_TITLES}) b where k%2=0"""

SQL_ACCOUNTS = f"""
select cast(k as varchar) as Id, concat('  ',title,' ') as Account_Name,
       cast(null as varchar) as Billing_Code, cast(null as varchar) as Billing_Street
from ({SQL_TITLES}) b where k%2=1
union all
select cast(2000000+k as varchar), concat(substr(title, 1, g), substr(title, g + 2), ' Ltd'), null, null
from (select *, k % greatest(length(title), 1) as g from ({SQL_TITLES})) b where k%6=0
union all
select cast(1000000+k as varchar),
       case when k%12=0 then concat(repeat('qzx7',15),' ',title)
            when k%20=0 then 'Unrelated 4711'
            else concat(title,' Niederlassung Nord') end,
       lpad(cast((k*7919)%99999 as varchar),5,'0'),
       concat(case k%10 when 0 then 'Hauptstr.' when 2 then 'Bahnhofstraße' when 4 then 'MÜLLERWEG'
                        when 6 then 'Weststraße' when 8 then 'Linden-Allee' end, ' ', cast(k%90+1 as varchar))
from ({SQL_TITLES}) b where k%4=0"""
