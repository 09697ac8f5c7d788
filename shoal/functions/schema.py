"""Canonical column contracts and categorical domains of the integrated data."""

from __future__ import annotations

# The integrated survey table, columns in contract order.
SURVEY_COLS = [
    "Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "Survey",
    "Depth", "SampleID", "Method", "Tide", "Sal_surf", "Sal_bot", "Temp_surf",
    "TurbidityNTU", "TurbidityFNU", "Secchi", "Secchi_estimated",
    "Tow_duration", "Tow_area", "Tow_volume", "Cable_length", "Tow_direction",
    "Notes_tow", "Notes_flowmeter",
]

# The fish table before zero-fill (Source is dropped after).
FISH_COLS = ["Source", "SampleID", "Taxa", "Length", "Count", "Notes_catch"]

# Measured-length tables.
MEASURED_LENGTH_COLS = ["SampleID", "Taxa", "Length", "Count"]

# Registry names of the ten survey datasets.
SOURCES = ["Baystudy", "Suisun", "FMWT", "SKT", "DJFMP", "EDSM", "TMM", "SLS",
           "STN", "Salvage"]

# Source labels written into the data.
SOURCE_LABELS = ["20mm", "Bay Study", "DJFMP", "EDSM", "FMWT", "SKT", "SLS",
                 "STN", "Suisun", "Salvage"]

# Categorical domains checked by the quality rules.
TIDES = ["Low Slack", "Ebb", "High Slack", "Flood"]
METHODS = ["Midwater trawl", "Otter trawl", "Kodiak trawl", "Beach seine",
           "20mm net", "Oblique tow", "STN net", "Normal count", "Second flush"]
NO_FISH = "No fish caught"
UNKNOWN_LENGTH = "Unknown length"
LENGTH_FLAGS = [NO_FISH, UNKNOWN_LENGTH]

# The unidentified-taxon label removed when its count is zero.
UNID = "UnID"

# Coordinate box of the study area.
LAT_RANGE = (37.0, 39.3)
LON_RANGE = (-123.0, -121.0)
