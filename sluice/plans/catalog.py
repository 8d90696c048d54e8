"""Feed registry: declared schemas, URL templates, source ids (O-07, O-14, O-15).

The catalog is configuration, tiny and bounded by the number of
(environment, feed) pairs, so it is the one side of the request plan that
is safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- Fixed values: must equal the feed provider's contract -----------------
# Declared columns of each XML feed, in table order.  Every column is a
# nullable string; the element names are case-sensitive.
FEED_COLUMNS: dict[str, list[str]] = {
    "agent-move-1.0": [
        "mlsSid", "moveDate", "agentId", "firstName", "lastName", "currOfficeId", "currOffice",
        "currOfficeAddress", "currCity", "currState", "currZip", "formerOfficeId", "formerOffice",
        "formerOfficeAddress", "formerCity", "formerState", "formerZip",
    ],
    "agent-new-1.0": [
        "mlsSid", "agentId", "firstName", "lastName", "agentEmail", "agentPhone1", "dateFirstAppeared",
        "officeId", "officeName", "officeAddress", "officeCity", "officeState", "officeZip",
    ],
    "agent-2.0": [
        "mlsSid", "agentId", "firstName", "lastName", "agentStatus", "agentPhone1", "agentPhoneType1",
        "agentPhone2", "agentPhoneType2", "agentPhone3", "agentPhoneType3", "agentFax", "agentEmail",
        "officeId", "officeName", "officeAddress", "officeCity", "officeState", "officeZip",
    ],
    "agents-all-1.0": [
        "mlsSid", "agentId", "agentFirstName", "agentLastName", "agentOfficeId", "agentStatus",
    ],
    "closed-listings-1.0": [
        "mlsSid", "closeDate", "listingId", "taxId", "streetName", "streetNumber", "zipCode",
        "listOfficeId", "sellOfficeId", "salePrice", "bank", "listAgentId", "sellAgentId",
        "listingCounty", "listingState", "listingUnitNumber", "insertDate",
    ],
    "listings-2.0": [
        "mlsSid", "listAgentId", "listAgentFirstName", "listAgentLastName", "listAgentPhone1",
        "coListAgentId", "coListAgentFirstName", "coListAgentLastName", "coListAgentPhone1",
        "sellAgentId", "sellAgentFirstName", "sellAgentLastName", "sellAgentPhone1", "coSellAgentId",
        "coSellAgentFirstName", "coSellAgentLastName", "coSellAgentPhone1", "dom", "city", "dateList",
        "listPrice", "state", "address", "bank", "statusCode", "dateStatusChange", "zipCode",
        "listingId", "officeId", "officeName", "streetName1", "officeCity", "officeZip", "officeState",
    ],
    "office-2.0": [
        "mlsSid", "officeId", "officeName", "agents", "officeAddress1", "officeAddress2", "officeCity",
        "officeState", "officeZip", "officeGeoCode", "officeCounty", "officeStatus", "officePhone",
        "officeFax", "officeEmail",
    ],
    "listings-3.0": [
        "mlsSid", "listAgentId", "listAgentFirstName", "listAgentLastName", "listAgentPhone1",
        "coListAgentId", "coListAgentFirstName", "coListAgentLastName", "coListAgentPhone1",
        "sellAgentId", "sellAgentFirstName", "sellAgentLastName", "sellAgentPhone1", "coSellAgentId",
        "coSellAgentFirstName", "coSellAgentLastName", "coSellAgentPhone1", "dom", "city", "dateList",
        "listPrice", "state", "address", "addressUnit", "bank", "statusCode", "dateStatusChange",
        "zipCode", "listOfficeId", "listOfficeName", "listOfficeStreetName1", "listOfficeCity",
        "listOfficeZip", "listOfficeState", "sellOfficeId", "sellOfficeName", "sellOfficeStreetName1",
        "sellOfficeCity", "sellOfficeZip", "sellOfficeState",
    ],
}

# Query-string template of each feed.  Slots: {0} base URL, {1} access
# token (filled only inside the fetching task, never stored), {2} source id,
# {3} from date, {4} to date (MM-dd-yyyy).
FEED_URL_TEMPLATES: dict[str, str] = {
    "agent-move-1.0": "{0}?authToken={1}&mlsSid={2}&status=All&searchStr=All&searchBy=office&fromDate={3}&recLimit=1000000",
    "agent-new-1.0": "{0}?authToken={1}&mlsSid={2}&status=All&searchStr=All&searchBy=office&fromDate={3}&recLimit=1000000",
    "agent-2.0": "{0}?authToken={1}&mlsSid={2}&status=A&searchStr=All&fromDate={3}",
    "agents-all-1.0": "{0}?authToken={1}&mlsSid={2}&status=A&searchStr=All&fromDate={3}",
    "closed-listings-1.0": "{0}?authToken={1}&mlsSid={2}&status=A&searchStr=All&fromDate={3}",
    "listings-2.0": "{0}?authToken={1}&mlsSid={2}&status=All&searchStr=All&searchBy=office&fromDate={3}&recLimit=1000000",
    "office-2.0": "{0}?authToken={1}&mlsSid={2}&status=A&searchStr=All&fromDate={3}",
    "listings-3.0": "{0}?authToken={1}&mlsSid={2}&status=All&searchStr=All&searchBy=office&fromDate={3}&toDate={4}&recLimit=1000000",
}

# Source (MLS) ids asked for per environment.  The dev list names 36 twice
# and both copies are fetched.
SOURCE_IDS: dict[str, list[int]] = {
    "dev": [278, 14, 4, 29, 238, 125, 165, 16, 167, 45, 5, 201, 36, 92, 1, 156, 6, 3, 295, 36, 345, 65, 63],
    "uat": [278, 14, 238, 125, 167, 36, 92],
}

# Feeds in the order an all-feed run processes them.
FEED_ORDER: list[str] = [
    "agent-move-1.0", "agent-new-1.0", "agent-2.0", "agents-all-1.0",
    "closed-listings-1.0", "listings-2.0", "office-2.0", "listings-3.0",
]
# ---------------------------------------------------------------------------

DEFAULT_ROW_TAGS = ("row",)
ENVIRONMENTS = ("dev", "uat")


class UnknownFeed(KeyError):
    pass


def feed_columns(endpoint: str) -> list[str]:
    """O-15: declared column list of a feed; an unknown feed is an error."""
    try:
        return list(FEED_COLUMNS[endpoint])
    except KeyError:
        raise UnknownFeed(endpoint) from None


def feed_schema(endpoint: str) -> T.StructType:
    """O-14: the all-string table schema of a feed."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in feed_columns(endpoint)])


def table_name_of(endpoint: str) -> str:
    """O-25 on the driver: the catalog table name of a feed ('-' and '.' dropped)."""
    return endpoint.replace("-", "").replace(".", "")


def example_base_url(env: str, endpoint: str) -> str:
    """Placeholder hosts for tests and examples; real hosts are configuration."""
    return f"https://{env}.feeds.example.com/api/{endpoint}.xml"


def feed_catalog(spark: SparkSession, base_urls: dict[str, dict[str, str]] | None = None,
                 row_tags: dict[str, list[str]] | None = None) -> DataFrame:
    """O-07: the feeds catalog as a DataFrame.

    One row per (env, endpoint): base URL, template, record tags, table name
    and the feed's ordinal in an all-feed run.  ``base_urls`` maps env ->
    endpoint -> URL; by default example hosts are used.
    """
    rows = []
    for env in ENVIRONMENTS:
        for ordinal, endpoint in enumerate(FEED_ORDER):
            base = (base_urls or {}).get(env, {}).get(endpoint) or example_base_url(env, endpoint)
            tags = list((row_tags or {}).get(endpoint, DEFAULT_ROW_TAGS))
            rows.append((env, endpoint, ordinal, base, FEED_URL_TEMPLATES[endpoint], tags,
                         table_name_of(endpoint)))
    return _local(spark, rows, CATALOG_SCHEMA)


CATALOG_SCHEMA = T.StructType([
    T.StructField("env", T.StringType(), False),
    T.StructField("endpoint", T.StringType(), False),
    T.StructField("feed_ordinal", T.IntegerType(), False),
    T.StructField("base_url", T.StringType(), False),
    T.StructField("template", T.StringType(), False),
    T.StructField("row_tags", T.ArrayType(T.StringType(), False), False),
    T.StructField("table_name", T.StringType(), False),
])


def source_ids(spark: SparkSession, ids: dict[str, list[int]] | None = None) -> DataFrame:
    """(env, mlsSid, id_ordinal) rows; duplicates are kept (one request each)."""
    rows = [(env, int(i), n) for env, lst in (ids or SOURCE_IDS).items() for n, i in enumerate(lst)]
    return _local(spark, rows, T.StructType([T.StructField("env", T.StringType(), False),
                                             T.StructField("mlsSid", T.LongType(), False),
                                             T.StructField("id_ordinal", T.IntegerType(), False)]))


def schema_rows(spark: SparkSession) -> DataFrame:
    """(endpoint, ordinal, column) listing of the registry, for inspection."""
    rows = [(e, i, c) for e in FEED_ORDER for i, c in enumerate(FEED_COLUMNS[e])]
    return _local(spark, rows, T.StructType([T.StructField("endpoint", T.StringType(), False),
                                             T.StructField("ordinal", T.IntegerType(), False),
                                             T.StructField("column", T.StringType(), False)]))


def _local(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Driver configuration as a local relation: Spark then knows its exact
    size (so broadcast decisions need no extra job)."""
    import pandas as pd
    pdf = pd.DataFrame(rows, columns=schema.fieldNames())
    for f in schema.fields:
        if isinstance(f.dataType, T.IntegerType):
            pdf[f.name] = pdf[f.name].astype("int32")
        elif isinstance(f.dataType, T.LongType):
            pdf[f.name] = pdf[f.name].astype("int64")
    return spark.createDataFrame(pdf, schema)
