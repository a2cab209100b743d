"""Column names and fixed formats of the observation table."""

from __future__ import annotations

MAC = "MAC"
TYPE = "Type"
RSSI = "RSSI"
LAT = "CurrentLatitude"
LON = "CurrentLongitude"
CHANNEL = "Channel"
SSID = "SSID"
AUTH = "AuthMode"
SEEN = "FirstSeen"

FILE = "_file"
LOG = "_log_id"

REQUIRED = (MAC, TYPE)

# Radio types kept by default.
DEFAULT_TYPES = ("WIFI", "BLE", "BT", "GSM", "LTE", "WCDMA")

# Line 1 of exported logs unless another is given; readers pass over it.
LOG_PREHEADER = "SurveyLog-1.0,appRelease=1,model=none,release=1,device=none,display=none,brand=none"
