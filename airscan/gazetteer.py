"""Named latitude/longitude boxes and their evaluation order.

A gazetteer level is a short ordered list of boxes.  The order decides which box
wins where boxes overlap: ``listed`` takes them as written, ``area`` takes the
smallest box first.  Levels are plain data, so a job may pass its own.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

OTHER = "other"
US_OTHER = "us_other"


class Box(NamedTuple):
    name: str
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float

    @property
    def area(self) -> float:
        return (self.lat_max - self.lat_min) * (self.lon_max - self.lon_min)


# Name, lat_min, lat_max, lon_min, lon_max, in listed order.
# Published box tables (see NOTICE); the numbers decide the results, so they are kept as published.
REGION_BOXES = """
india               8.0    37.0     68.0     98.0
europe             34.0    72.0    -25.0     45.0
us                 24.0    50.0   -125.0    -65.0
canada             41.0    84.0   -141.0    -52.0
"""

COUNTRY_BOXES = """
usa                24.0    49.5   -125.0    -65.0
canada             41.7    84.0   -141.0    -52.0
mexico             14.5    32.7   -117.1    -86.7
uk                 49.9    60.9     -8.2      1.8
ireland            51.4    55.4    -10.5     -6.0
france             41.3    51.1     -5.1      9.6
germany            47.3    55.1      5.9     15.0
netherlands        50.8    53.6      3.4      7.2
belgium            49.5    51.5      2.5      6.4
switzerland        45.8    47.8      5.9     10.5
austria            46.4    49.0      9.5     17.2
spain              36.0    43.8     -9.3      4.3
portugal           36.9    42.2     -9.5     -6.2
italy              36.6    47.1      6.6     18.5
sweden             55.3    69.1     11.1     24.2
norway             57.9    71.2      4.5     31.1
denmark            54.6    57.8      8.1     15.2
finland            59.7    70.1     20.0     31.6
poland             49.0    54.9     14.1     24.2
czechia            48.6    51.1     12.1     18.9
hungary            45.7    48.6     16.1     22.9
romania            43.6    48.3     20.3     30.0
greece             34.8    42.0     19.4     28.3
india               8.0    37.1     68.1     97.4
china              18.2    53.6     73.6    134.8
japan              24.0    45.7    122.9    145.8
south_korea        33.1    38.6    125.1    129.6
taiwan             21.9    25.3    120.1    122.0
singapore           1.1     1.5    103.6    104.1
thailand            5.6    20.5     97.5    105.7
vietnam             8.6    23.4    102.1    109.5
indonesia         -11.0     6.1     95.0    141.1
malaysia            0.9     7.4     99.6    119.3
philippines         4.6    21.1    116.9    126.6
israel             29.5    33.3     34.3     35.9
uae                22.6    26.1     51.6     56.4
saudi_arabia       16.4    32.2     34.6     55.7
australia         -43.7   -10.7    113.2    153.6
new_zealand       -47.3   -34.4    166.4    178.6
brazil            -33.8     5.3    -73.9    -34.8
argentina         -55.1   -21.8    -73.6    -53.6
colombia           -4.2    13.4    -79.0    -66.8
chile             -55.9   -17.5    -75.7    -66.4
south_africa      -34.8   -22.1     16.5     32.9
nigeria             4.3    13.9      2.7     14.7
kenya              -4.7     4.6     33.9     41.9
egypt              22.0    31.7     25.0     37.1
"""

US_STATE_BOXES = """
alabama           30.14   35.01   -88.47   -84.89
alaska            54.56   71.54  -179.99  -129.99
arizona           31.33   37.00  -114.82  -109.04
arkansas          33.00   36.50   -94.62   -89.64
california        32.53   42.01  -124.41  -114.13
colorado          36.99   41.00  -109.05  -102.04
connecticut       40.98   42.05   -73.73   -71.79
delaware          38.45   39.84   -75.79   -75.04
florida           24.52   31.00   -87.63   -79.50
georgia           30.36   35.00   -85.61   -80.84
hawaii            18.91   22.24  -160.25  -154.81
idaho             41.99   49.00  -117.24  -111.04
illinois          36.97   42.51   -91.51   -87.02
indiana           37.77   41.77   -88.10   -84.78
iowa              40.38   43.50   -96.64   -90.14
kansas            36.99   40.00  -102.05   -94.59
kentucky          36.50   39.15   -89.57   -81.96
louisiana         28.93   33.02   -94.04   -88.82
maine             43.06   47.46   -71.08   -65.50
maryland          37.91   39.72   -79.49   -75.05
massachusetts     41.24   42.89   -73.51   -69.93
michigan          41.70   48.31   -90.42   -79.50
minnesota         43.50   49.38   -97.24   -89.49
mississippi       30.17   35.01   -91.65   -88.10
missouri          35.99   40.61   -95.77   -89.10
montana           44.36   49.00  -116.05  -104.04
nebraska          40.00   43.00  -104.05   -95.31
nevada            35.00   42.00  -120.00  -114.04
new_hampshire     42.70   45.31   -72.56   -70.61
new_jersey        38.93   41.36   -75.57   -73.50
new_mexico        31.33   37.00  -109.05  -103.00
new_york          40.50   45.90   -79.76   -71.50
north_carolina    33.84   36.59   -84.32   -75.00
north_dakota      45.94   49.00  -104.05   -96.55
ohio              38.40   42.33   -84.82   -80.52
oklahoma          33.62   37.00  -103.00   -94.43
oregon            41.99   46.26  -124.57  -116.46
pennsylvania      39.72   42.27   -80.52   -74.69
rhode_island      41.15   42.02   -71.86   -71.12
south_carolina    32.05   35.22   -83.35   -77.90
south_dakota      42.48   45.95  -104.06   -96.44
tennessee         34.98   36.68   -90.31   -81.65
texas             25.84   36.50  -106.65   -93.51
utah              36.99   42.00  -114.05  -109.04
vermont           42.73   45.02   -73.44   -71.46
virginia          36.54   39.47   -83.68   -75.24
washington        45.54   49.00  -124.73  -116.92
washington_dc     38.79   38.99   -77.12   -76.91
west_virginia     37.20   40.64   -82.64   -77.72
wisconsin         42.49   47.31   -92.89   -86.25
wyoming           40.99   45.01  -111.06  -104.05
"""


def parse_boxes(text: str) -> tuple[Box, ...]:
    """Read a whitespace-separated box table."""
    rows = (line.split() for line in text.strip().splitlines())
    return tuple(Box(name, *map(float, edges)) for name, *edges in rows)


LEVELS: dict[str, tuple[Box, ...]] = {
    "region": parse_boxes(REGION_BOXES),
    "country": parse_boxes(COUNTRY_BOXES),
    "us_state": parse_boxes(US_STATE_BOXES),
}


def ordered_boxes(level: str | tuple[Box, ...], order: str = "area") -> list[Box]:
    """Boxes of a level in evaluation order, ``listed`` or ``area``."""
    boxes = list(LEVELS[level] if isinstance(level, str) else level)
    if order == "listed":
        return boxes
    if order == "area":
        return sorted(boxes, key=lambda box: box.area)
    raise ValueError(f"order must be 'listed' or 'area', not {order!r}")


def box_table(spark: SparkSession, level: str | tuple[Box, ...], order: str = "area") -> DataFrame:
    """A level as a table: one row per box with its listed position, area and rank (1 = tried first)."""
    name = level if isinstance(level, str) else "custom"
    listed = ordered_boxes(level, "listed")
    position = {box: i for i, box in enumerate(listed, 1)}
    rows = [
        (name, box.name, position[box], box.lat_min, box.lat_max, box.lon_min, box.lon_max, box.area, rank)
        for rank, box in enumerate(ordered_boxes(level, order), 1)
    ]
    return spark.createDataFrame(
        rows,
        "level string, name string, seq int, lat_min double, lat_max double, "
        "lon_min double, lon_max double, area double, rank int",
    )
