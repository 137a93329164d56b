"""Location catalogs as small dimension tables, and lookups over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cities with latitude, longitude and alias (fixed values).
CITIES = """
An Giang,10.5216,105.1259,
Ba Ria - Vung Tau,10.4114,107.1362,
Bac Giang,21.2819,106.1970,
Bac Kan,22.1470,105.8348,
Bac Lieu,9.2941,105.7278,
Bac Ninh,21.1861,106.0763,
Ben Tre,10.2434,106.3759,
Binh Dinh,13.7820,109.2197,
Binh Duong,10.9804,106.6519,
Binh Phuoc,11.5349,106.8834,
Binh Thuan,10.9289,108.1021,
Ca Mau,9.1769,105.1524,
Can Tho,10.0379,105.7869,
Cao Bang,22.6666,106.2639,
Da Nang,16.0544,108.2022,
Dak Lak,12.6667,108.0500,
Dak Nong,12.0042,107.6907,
Dien Bien,21.3860,103.0230,
Dong Nai,10.9574,106.8426,
Dong Thap,10.4938,105.6882,
Gia Lai,13.9833,108.0000,
Ha Giang,22.8233,104.9836,
Ha Nam,20.5411,105.9122,
Hanoi,21.0285,105.8542,Ha Noi
Ha Tinh,18.3428,105.9057,
Hai Duong,20.9373,106.3145,
Hai Phong,20.8449,106.6881,
Hau Giang,9.7845,105.4701,
HCMC,10.7769,106.6964,Ho Chi Minh City
Hoa Binh,20.8133,105.3383,
Hung Yen,20.6464,106.0511,
Khanh Hoa,12.2388,109.1967,
Kien Giang,10.0125,105.0809,
Kon Tum,14.3545,108.0076,
Lai Chau,22.3964,103.4582,
Lam Dong,11.9404,108.4583,
Lang Son,21.8537,106.7610,
Lao Cai,22.4856,103.9707,
Long An,10.5359,106.4137,
Nam Dinh,20.4388,106.1621,
Nghe An,18.6734,105.6923,
Ninh Binh,20.2506,105.9745,
Ninh Thuan,11.5658,108.9886,
Phu Tho,21.3227,105.4010,
Phu Yen,13.0955,109.3209,
Quang Binh,17.4689,106.6223,
Quang Nam,15.5394,108.0191,
Quang Ngai,15.1214,108.8044,
Quang Ninh,21.0064,107.2925,
Quang Tri,16.7500,107.2000,
Soc Trang,9.6025,105.9739,
Son La,21.3256,103.9188,
Tay Ninh,11.3675,106.1193,
Thai Binh,20.4463,106.3365,
Thai Nguyen,21.5942,105.8481,
Thanh Hoa,19.8075,105.7764,
Hue,16.4637,107.5909,Thua Thien Hue
Tien Giang,10.4493,106.3420,
Tra Vinh,9.9477,106.3423,
Tuyen Quang,21.8236,105.2140,
Vinh Long,10.2537,105.9722,
Vinh Phuc,21.3089,105.6049,
Yen Bai,21.7229,104.9113,
"""
#: Names of the six cities in the two air providers' catalogs: feed; state (fixed values).
FEEDS = {"Hanoi": "hanoi", "Hai Phong": "hai-phong", "Da Nang": "da-nang", "Hue": "hue", "HCMC": "ho-chi-minh-city", "Can Tho": "can-tho"}
STATES = {"Hanoi": "Ha Noi", "Hai Phong": "Hai Phong", "Da Nang": "Da Nang", "Hue": "Thua Thien Hue", "HCMC": "Ho Chi Minh City", "Can Tho": "Can Tho"}
#: Where a record without place or coordinates is put.
DEFAULT = ("bac", "Hanoi", 21.0285, 105.8542)


def region_of(lat: Column) -> Column:
    return F.when(lat >= 18, "bac").when(lat >= 14, "trung").when(lat.isNotNull(), "nam")


def locations(spark: SparkSession) -> DataFrame:
    """city, latitude, longitude, alias, region, feed, state."""
    rows = [(c, float(a), float(b), x or None, FEEDS.get(c), STATES.get(c)) for c, a, b, x in (line.split(",") for line in CITIES.strip().split("\n"))]
    df = spark.createDataFrame(rows, "city string, latitude double, longitude double, alias string, feed string, state string")
    return df.withColumn("region", region_of(F.col("latitude")))


def by_name(catalog: DataFrame, city: str = "city", alias: str = "alias") -> DataFrame:
    """The catalog once per name or alias, in lower case, as `name_key`."""
    names = F.array_distinct(F.array_compact(F.array(F.lower(F.trim(city)), F.lower(F.trim(alias)))))
    return catalog.withColumn("name_key", F.explode(names))


def select_locations(catalog: DataFrame, wanted: list[str], city: str = "city", alias: str = "alias") -> DataFrame:
    keys = [w.strip().lower() for w in wanted]
    return catalog.filter(F.lower(city).isin(keys) | F.coalesce(F.lower(alias).isin(keys), F.lit(False)))


def place(df: DataFrame, catalog: DataFrame, city: str = "city", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """region, city, latitude and longitude of each record: from the catalog, else from the latitude, else the default.

    Spark sends the catalog to every task if its size is below spark.sql.autoBroadcastJoinThreshold.
    """
    known = by_name(catalog).select("name_key", F.col("city").alias("_city"), F.col("region").alias("_region"), F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"))
    joined = df.withColumn("name_key", F.lower(F.trim(city))).join(known, "name_key", "left")
    here = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    anchor = F.when(F.col(lat) >= 18, "Hanoi").when(F.col(lat) >= 14, "Da Nang").otherwise("HCMC")
    named = F.nullif(F.col(city), F.lit(""))
    out = {
        "region": F.coalesce("_region", F.when(here, region_of(F.col(lat))), F.lit(DEFAULT[0])),
        city: F.coalesce("_city", named, F.when(here, anchor), F.lit(DEFAULT[1])),
        lat: F.coalesce("_lat", F.when(here, F.col(lat)), F.lit(DEFAULT[2])),
        lon: F.coalesce("_lon", F.when(here, F.col(lon)), F.lit(DEFAULT[3])),
    }
    return joined.withColumns(out).drop("name_key", "_city", "_region", "_lat", "_lon")


def match_provider(df: DataFrame, catalog: DataFrame, default: str = "Hanoi", city: str = "city", alias: str = "alias") -> DataFrame:
    """Each location's city in another provider's catalog, by name or alias of either side; `default` when none."""
    mine = by_name(df.withColumn("_row", F.struct(city, alias)), city, alias)
    theirs = by_name(catalog, "city", "alias").select("name_key", F.col("city").alias("provider_city"))
    first = mine.join(theirs, "name_key", "left").groupBy("_row").agg(F.min("provider_city").alias("provider_city"))
    return first.select("_row.*", F.coalesce("provider_city", F.lit(default)).alias("provider_city"))
