"""Declared schemas of the landed files."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S, _D, _L, _DATE = T.StringType(), T.DoubleType(), T.LongType(), T.DateType()

READINGS = _schema(
    Monitoring_Location_ID=_S, Activity_Start_Date=_DATE, Activity_Start_Time=_S, Activity_Time_Zone=_S,
    Equipment_ID=_S, Characteristic_Name=_S, Result_Value=_D, Result_Unit=_S, Result_Status_ID=_S,
)
# The multi-part form swaps characteristic and equipment.
MULTI_PART_COLUMNS = (
    "Monitoring_Location_ID", "Activity_Start_Date", "Activity_Start_Time", "Activity_Time_Zone",
    "Characteristic_Name", "Equipment_ID", "Result_Value", "Result_Unit", "Result_Status_ID",
)
MULTI_PART_DROPPED = ("OBJECTID", "TEMP_GUID", "SAMPLE_GUID", "BLM_ORG_CD")

LOGGER_COLUMNS = (
    "StationCode", "DateTimeStamp", "Temp", "F_Temp", "DO_Pct", "F_DO_Pct", "DO_mgl", "F_DO_mgl", "pH", "F_pH",
)
PORTAL_CSV = _schema(
    datetime=_S, Result_Value=_D, Grade_Code=_D, Approval_Level=_D, Interpolation_Type=_D, Event_Timestamp=_S,
    Comment=_S,
)
PORTAL_COLUMNS = (
    "Monitoring_Location_ID", "datetime", "Event_Timestamp", "Characteristic_Name", "Result_Unit", "Result_Value",
    "Interpolation_Type", "Grade_Code", "Approval_Level", "Comment",
)
PORTAL_JSON = T.StructType([
    T.StructField("numPoints", T.ArrayType(_L)),
    T.StructField("points", T.ArrayType(_schema(
        timestamp=_S, value=_D, gradeCode=_L, approvalLevel=_L, comment=_S,
    ))),
    T.StructField("dataset", _schema(identifier=_S, label=_S, locationIdentifier=_S, parameter=_S, unit=_S)),
])
CATALOGUE_JSON = T.StructType([
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", _schema(dataSetLabel=_S, dataSetIdentifier=_S)),
    ]))),
])
INSTANT_PH = _schema(site_no=_S, dateTime=T.TimestampNTZType(), tz_cd=_S, pH_Inst=_D, pH_Inst_cd=_S)
SITES = _schema(
    site_no=_S, station_nm=_S, site_tp_cd=_S, county_cd=_S, huc_cd=_S, dec_coord_datum_cd=_S, nat_aqfr_cd=_S,
    dec_lat_va=_D, dec_long_va=_D, map_scale_fc=_D, well_depth_va=_D,
)
COUNTIES = _schema(county_cd=_S, county_nm=_S)
INVENTORY = _schema(station=_S, startdate=_S, enddate=_S, char=_S)
STATION_CROSSWALK = _schema(LocationIdentifier=_S, MLocID=_S)
CITY_STATIONS = _schema(
    row=T.IntegerType(), LocationIdentifier=_S, LocationName=_S, Latitude=_D, Longitude=_D, LocationType=_S,
)
AIR_STATIONS = _schema(STATION=_S, NAME=_S, LATITUDE=_D, LONGITUDE=_D)
EXISTING_RESULTS = _schema(
    OrganizationID=_S, MLocID=_S, Char_Name=_S, SampleStartDate=_DATE, SampleStartTime=_S, Method_Code=_S,
    act_depth_height=_S, Statistical_Base=_S, Result=_D, Result_Numeric=_D, Result_Unit=_S, Result_UID=_S,
    act_id=_S, sample_fraction=_S,
)
EXISTING_EQUIPMENT = _schema(OrganizationID=_S, MLocID=_S, Equipment_ID=_S)


def air_schema(data_types: tuple[str, ...]) -> T.StructType:
    """A station's place and day, then each data type with its attributes; the service sends all of them as text."""
    values = {name: _S for t in data_types for name in (t, f"{t}_ATTRIBUTES")}
    return _schema(STATION=_S, NAME=_S, LATITUDE=_S, LONGITUDE=_S, ELEVATION=_S, DATE=_S, **values)


def daily_value_schema(columns: tuple[str, ...]) -> T.StructType:
    """`agency_cd, site_no, Date`, then each statistic with its qualifier column."""
    fields = {"agency_cd": _S, "site_no": _S, "Date": _DATE}
    for c in columns:
        fields[c] = _D
        fields[f"{c}_cd"] = _S
    return _schema(**fields)
