"""Small reference lists: the ticker universe and the sector seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The five largest tickers of each sector.
SECTOR_TICKERS = {
    "Energy": ["BYAN.JK", "DSSA.JK", "CUAN.JK", "AADI.JK", "BUMI.JK"],
    "Basic Materials": ["TPIA.JK", "AMMN.JK", "BRPT.JK", "EMAS.JK", "BRMS.JK"],
    "Industrials": ["ASII.JK", "IMPC.JK", "UNTR.JK", "VKTR.JK", "BNBR.JK"],
    "Consumer Non-Cyclicals": ["HMSP.JK", "ICBP.JK", "CPIN.JK", "INDF.JK", "UNVR.JK"],
    "Consumer Cyclicals": ["BELI.JK", "EMTK.JK", "MSIN.JK", "FILM.JK", "MDIY.JK"],
    "Healthcare": ["SRAJ.JK", "KLBF.JK", "SILO.JK", "MIKA.JK", "SOHO.JK"],
    "Financials": ["BBCA.JK", "BBRI.JK", "BMRI.JK", "BBNI.JK", "DNET.JK"],
    "Properties & Real Estate": ["PANI.JK", "MPRO.JK", "CBDK.JK", "RISE.JK", "BUVA.JK"],
    "Technology": ["DCII.JK", "GOTO.JK", "MLPT.JK", "BUKA.JK", "WIFI.JK"],
    "Infrastructures": ["BREN.JK", "TLKM.JK", "CDIA.JK", "MORA.JK", "ISAT.JK"],
    "Transportation & Logistic": ["TCPI.JK", "GIAA.JK", "ALII.JK", "ELPI.JK", "SHIP.JK"],
}

# Sector seed table. It spells one sector "Industrial", the universe
# "Industrials"; the difference is kept so that the quality checks report it.
SECTOR_MAPPING = [
    ("Energy", "Commodities"),
    ("Basic Materials", "Commodities"),
    ("Consumer Cyclicals", "Consumer & Services"),
    ("Consumer Non-Cyclicals", "Consumer & Services"),
    ("Healthcare", "Consumer & Services"),
    ("Properties & Real Estate", "Financial"),
    ("Technology", "Infrastructure & Tech"),
    ("Infrastructures", "Infrastructure & Tech"),
    ("Transportation & Logistic", "Infrastructure & Tech"),
    ("Financials", "Financial"),
    ("Industrial", "Infrastructure & Tech"),
]
ACCEPTED_SECTORS = [sector for sector, _ in SECTOR_MAPPING]

SEED_SCHEMA = "sector_name STRING, category STRING"


def universe(spark: SparkSession, mapping: dict[str, list[str]] | None = None) -> DataFrame:
    """(sector, ticker) rows of a sector -> tickers mapping."""
    mapping = SECTOR_TICKERS if mapping is None else mapping
    lists = spark.createDataFrame(
        list(mapping.items()), "sector STRING, tickers ARRAY<STRING>"
    )
    return lists.select("sector", F.explode("tickers").alias("ticker"))


def sector_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SECTOR_MAPPING, SEED_SCHEMA)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """A sector mapping kept as a CSV file with a header."""
    return spark.read.schema(SEED_SCHEMA).option("header", True).csv(path)
