"""Table schemas, enforced where data enters instead of inferred."""

from pyspark.sql import types as T

_STR, _INT, _LONG, _FLOAT = T.StringType(), T.IntegerType(), T.LongType(), T.FloatType()

# fixed values: column suffixes of the two actor blocks and the three place blocks
_ACTOR = (
    "Code", "Name", "CountryCode", "KnownGroupCode", "EthnicCode",
    "Religion1Code", "Religion2Code", "Type1Code", "Type2Code", "Type3Code",
)
_PLACE = {
    "Type": _INT, "Fullname": _STR, "CountryCode": _STR, "ADM1Code": _STR,
    "Lat": _FLOAT, "Long": _FLOAT, "FeatureID": _STR,
}


def _fields(**columns) -> list[T.StructField]:
    return [T.StructField(name, dtype, True) for name, dtype in columns.items()]


# Event codes are strings: "010" and "10" are different codes.
EVENTS = T.StructType(
    _fields(GlobalEventID=_LONG, Day=_INT, MonthYear=_INT, Year=_INT, FractionDate=_FLOAT)
    + [T.StructField(f"Actor{n}{suffix}", _STR, True) for n in (1, 2) for suffix in _ACTOR]
    + _fields(
        IsRootEvent=_INT, EventCode=_STR, EventBaseCode=_STR, EventRootCode=_STR, QuadClass=_INT,
        GoldsteinScale=_FLOAT, NumMentions=_INT, NumSources=_INT, NumArticles=_INT, AvgTone=_FLOAT,
    )
    + [
        T.StructField(f"{who}Geo_{suffix}", dtype, True)
        for who in ("Actor1", "Actor2", "Action")
        for suffix, dtype in _PLACE.items()
    ]
    + _fields(DATEADDED=_LONG, SOURCEURL=_STR)
)

GKG = T.StructType(
    _fields(
        DATE=_INT, NUMARTS=_INT, COUNTS=_STR, THEMES=_STR, LOCATIONS=_STR, PERSONS=_STR,
        ORGANIZATIONS=_STR, TONE=_STR, CAMEOEVENTIDS=_STR, SOURCES=_STR, SOURCEURLS=_STR,
    )
)

CONTROL = T.StructType(
    _fields(TABLE_NAME=_STR, LAST_UPDATE_DATE=T.DateType(), LAST_MODIFIED=T.TimestampType())
)


def with_lineage(schema: T.StructType) -> T.StructType:
    """The stored form of a feed: its columns plus the two lineage dates."""
    return T.StructType(
        schema.fields + _fields(extraction_date=T.DateType(), last_modified=T.DateType())
    )
