"""Schemas and column-name maps of the input files and prepared datasets."""

from __future__ import annotations

from pyspark.sql import types as T

from .operators.cluster import PrepSpec

# ---------------------------------------------------------------------------
# Column names of the input files (they must equal the names in
# the source files for the data to be read).  Source name -> canonical name.
# ---------------------------------------------------------------------------
SPEED_COLUMNS = {
    "일자": "date",
    "링크아이디": "link_id",
    "시점명": "from_node",
    "종점명": "to_node",
    "거리": "distance_m",
    "속도": "speed_kmh",
    "시간": "hour",
    "걸리는시간": "travel_s",
    "일시": "ts",
    "예측": "condition",
}
# The hour columns used by the reference's analysis (10 and 15 o'clock).
SPEED_HOUR_COLUMNS = ("10시", "15시")

WEATHER_COLUMNS = {
    "일시": "ts",
    "지점": "station",
    "지점명": "station_name",
    "기온(°C)": "temp_c",
    "강수량(mm)": "rain_mm",
    "풍속(m/s)": "wind_ms",
    "풍향(16방위)": "wind_dir",
    "습도(%)": "humidity",
    "증기압(hPa)": "vapor_hpa",
    "이슬점온도(°C)": "dew_c",
    "현지기압(hPa)": "local_hpa",
    "해면기압(hPa)": "sea_hpa",
    "일조(hr)": "sunshine_hr",
    "일사(MJ/m2)": "solar_mj",
    "적설(cm)": "snow_cm",
    "3시간신적설(cm)": "snow3h_cm",
    "전운량(10분위)": "cloud",
    "중하층운량(10분위)": "low_cloud",
    "운형(운형약어)": "cloud_form",
    "최저운고(100m )": "cloud_base",
    "시정(10m)": "visibility",
    "지면상태(지면상태코드)": "ground_state",
    "현상번호(국내식)": "phenomenon",
    "지면온도(°C)": "ground_c",
    "5cm 지중온도(°C)": "soil5_c",
    "10cm 지중온도(°C)": "soil10_c",
    "20cm 지중온도(°C)": "soil20_c",
    "30cm 지중온도(°C)": "soil30_c",
}
# QC flag columns of the weather files are dropped, whatever their names.

# ---------------------------------------------------------------------------
# Canonical schemas
# ---------------------------------------------------------------------------
TRAFFIC_FACT = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("link_id", T.LongType()),
    T.StructField("from_node", T.StringType()),
    T.StructField("to_node", T.StringType()),
    T.StructField("distance_m", T.DoubleType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("travel_s", T.DoubleType()),
    T.StructField("ts", T.TimestampType()),
])
LABELLED_FACT = T.StructType(TRAFFIC_FACT.fields + [T.StructField("condition", T.IntegerType())])

SPEED_WIDE = T.StructType([
    T.StructField("일자", T.IntegerType()),
    T.StructField("링크아이디", T.LongType()),
    T.StructField("시점명", T.StringType()),
    T.StructField("종점명", T.StringType()),
    T.StructField("거리", T.DoubleType()),
    T.StructField("10시", T.DoubleType()),
    T.StructField("15시", T.DoubleType()),
])

# ---------------------------------------------------------------------------
# Cleaning specs of the two reference modes (canonical names)
# ---------------------------------------------------------------------------
FULL_FEATURES = ("temp_c", "rain_mm", "wind_ms", "wind_dir", "humidity", "vapor_hpa", "dew_c",
                 "sea_hpa", "solar_mj", "snow_cm", "cloud", "visibility", "ground_c", "soil5_c",
                 "cloud_filled")
FULL_MODE = PrepSpec(
    name="full",
    drop=("station", "station_name", "local_hpa", "snow3h_cm", "low_cloud", "cloud_form",
          "cloud_base", "ground_state", "phenomenon", "soil10_c", "soil20_c", "soil30_c",
          "sunshine_hr"),
    fill={"rain_mm": -1.0, "snow_cm": -1.0, "solar_mj": 0.0},
    require=("temp_c", "wind_ms", "wind_dir", "humidity", "vapor_hpa", "dew_c", "visibility",
             "ground_c", "soil5_c", "sea_hpa"),
    ffill={"cloud": "cloud_filled"},
    require_after=("cloud",),
    features=FULL_FEATURES,
)
COMPACT_MODE = PrepSpec(
    name="compact",
    select=("ts", "temp_c", "rain_mm", "snow_cm"),
    require=("temp_c",),
    fill_numeric=0.0,
    features=("temp_c", "rain_mm", "snow_cm"),
)
