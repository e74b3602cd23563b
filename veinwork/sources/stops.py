"""The traffic-stop table: its fields, and which of them each analysis uses."""

from __future__ import annotations

from veinwork.sources.schema import FieldSpec

# Field names and kinds of the input file.
TEXT_FIELDS = (
    "SeqID", "Time Of Stop", "Agency", "SubAgency", "Description", "Location",
    "Search Disposition", "Search Outcome", "Search Reason", "Search Reason For Stop",
    "Search Type", "Search Arrest Reason", "State", "VehicleType", "Make", "Model", "Color",
    "Violation Type", "Charge", "Article", "Race", "Gender", "Driver City", "Driver State",
    "DL State", "Arrest Type", "Geolocation",
)
FLAG_FIELDS = (
    "Accident", "Belts", "Personal Injury", "Property Damage", "Fatal", "Commercial License",
    "HAZMAT", "Commercial Vehicle", "Alcohol", "Work Zone", "Search Conducted",
    "Contributed To Accident",
)
STOP_FIELDS = (
    [FieldSpec(n, "text") for n in TEXT_FIELDS]
    + [FieldSpec(n, "flag") for n in FLAG_FIELDS]
    + [FieldSpec("Date Of Stop", "timestamp"), FieldSpec("Latitude", "double"),
       FieldSpec("Longitude", "double"), FieldSpec("Year", "whole")]
)
