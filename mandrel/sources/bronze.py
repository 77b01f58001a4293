"""Raw extract tables: schemas, and the columns that come from a file's place.

Every source column is text as delivered; blank is '' and not null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of the delivered tables.
COLUMNS = {
    "LFA1": "LIFNR KTOKK NAME1 ADRNR LAND1 STCD1 STCD2 SPERR SPERZ SPERM LOEVM XCPDK LNRZA XZEMP CONFS ERDAT",
    "LFB1": "LIFNR BUKRS AKONT ZTERM ZWELS ZAHLS SPERR LOEVM REPRF LNRZB PERNR CONFS ERDAT",
    "LFBK": "LIFNR BANKS BANKL BANKN KOINH BVTYP",
    "BUT000": "PARTNER PARTNER_GUID TYPE NAME_ORG1 NAME_FIRST NAME_LAST",
    "BUT0BK": "PARTNER BKVID BANKS BANKL BANKN IBAN KOINH BK_VALID_FROM BK_VALID_TO",
    "ADRC": "ADDRNUMBER DATE_FROM NATION NAME1 STREET CITY1 POST_CODE1 REGION COUNTRY PO_BOX",
    "DFKKBPTAXNUM": "PARTNER TAXTYPE TAXNUM",
    "CVI_VEND_LINK": "PARTNER_GUID VENDOR",
    "ACDOCA": "RLDNR RBUKRS GJAHR BELNR DOCLN KOART RACCT LIFNR BLART BUDAT HSL RHCUR AUGBL AUGDT NETDT",
    "CDHDR": "OBJECTCLAS OBJECTID CHANGENR USERNAME UDATE UTIME TCODE CHANGE_IND",
    "CDPOS": "OBJECTCLAS OBJECTID CHANGENR TABNAME TABKEY FNAME CHNGIND VALUE_NEW VALUE_OLD",
}
TABLES = tuple(COLUMNS)


def schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS[table].split()])


def with_origin(rows: DataFrame) -> DataFrame:
    """extract_date from the folder name, the file and the load time."""
    path = F.col("_metadata.file_path")
    return rows.withColumns({
        "extract_date": F.to_date(F.regexp_extract(path, r"extract_date=(\d{4}-\d{2}-\d{2})", 1)),
        "_source_file": path,
        "_loaded_at": F.current_timestamp(),
    })


def stream(spark: SparkSession, inbox: str, table: str) -> DataFrame:
    """Files of a table as a stream; recursive lookup leaves partition columns out, so the date has one origin."""
    return with_origin(spark.readStream.schema(schema(table)).option("recursiveFileLookup", True).parquet(f"{inbox}/{table}"))


def batch(spark: SparkSession, inbox: str, table: str) -> DataFrame:
    return with_origin(spark.read.schema(schema(table)).option("recursiveFileLookup", True).parquet(f"{inbox}/{table}"))
