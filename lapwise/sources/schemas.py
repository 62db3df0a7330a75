"""Columns and types of the raw tables after cleaning.

`duration` stands for duration text that becomes milliseconds.
"""

from __future__ import annotations

# Raw table layouts.
TAGS = {"RACEYEAR": "int", "RACENUMBER": "int", "SESSIONTYPE": "string"}

LAPS = {
    "Driver": "string", "LapNumber": "double", "Stint": "double", "LapTime": "duration",
    "Sector1Time": "duration", "Sector2Time": "duration", "Sector3Time": "duration",
    "PitInTime": "duration", "PitOutTime": "duration", "Compound": "string",
    "TyreLife": "double", "SpeedFL": "double", **TAGS,
}
WEATHER = {
    "AirTemp": "double", "Humidity": "double", "Pressure": "double", "TrackTemp": "double",
    "WindSpeed": "double", "WindDirection": "int", "Rainfall": "boolean", **TAGS,
}
TRACK_STATUS = {"Time": "duration", "Status": "string", "Message": "string", **TAGS}
RACE_RESULTS = {
    "DriverNumber": "int", "BroadcastName": "string", "Abbreviation": "string", "DriverId": "string",
    "TeamName": "string", "TeamId": "string", "CountryCode": "string", "Position": "double",
    "ClassifiedPosition": "string", "GridPosition": "double", "Time": "duration", "Status": "string",
    "Points": "double", "RACEYEAR": "int", "RACENUMBER": "int",
}
QUALIFYING_RESULTS = {
    "RACEYEAR": "int", "RACENUMBER": "int", "Abbreviation": "string", "Position": "double",
    "Q1": "duration", "Q2": "duration", "Q3": "duration",
}
CORNERS = {"Angle": "double", "RACEYEAR": "int", "RACENUMBER": "int"}
SCHEDULE = {
    "RoundNumber": "int", "Country": "string", "Location": "string", "OfficialEventName": "string",
    "EventDate": "date", "EventName": "string", "EventFormat": "string",
    **{
        name: "string"
        for i in range(1, 6)
        for name in (f"Session{i}", f"Session{i}Date", f"Session{i}DateUtc")
    },
    "F1ApiSupport": "boolean", **TAGS,
}
