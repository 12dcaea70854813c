"""Input schemas and the contracts of the published tables.

Ingest casts to these types; nothing is inferred, because a column that is
empty in one month would otherwise come back with another type.
"""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _DOUBLE, _TEXT, _INT = T.LongType(), T.DoubleType(), T.StringType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


#: Partition columns of the flight table, in directory order.
PARTITIONS = ("Year", "Month")

# Columns and types of the public on-time performance file.
# Flags are 0.0 / 1.0 and clock and taxi times whole numbers, stored as doubles
# where a flight may lack them.
_FLIGHT_COLUMNS = """
Quarter BIGINT, DayofMonth BIGINT, DayOfWeek BIGINT, FlightDate STRING,
Reporting_Airline STRING, DOT_ID_Reporting_Airline BIGINT, IATA_CODE_Reporting_Airline STRING,
Tail_Number STRING, Flight_Number_Reporting_Airline BIGINT,
OriginAirportID BIGINT, OriginAirportSeqID BIGINT, OriginCityMarketID BIGINT, Origin STRING,
OriginCityName STRING, OriginState STRING, OriginStateFips BIGINT, OriginStateName STRING, OriginWac BIGINT,
DestAirportID BIGINT, DestAirportSeqID BIGINT, DestCityMarketID BIGINT, Dest STRING,
DestCityName STRING, DestState STRING, DestStateFips BIGINT, DestStateName STRING, DestWac BIGINT,
CRSDepTime BIGINT, DepTime DOUBLE, DepDelay DOUBLE, DepDelayMinutes DOUBLE, DepDel15 DOUBLE,
DepartureDelayGroups DOUBLE, DepTimeBlk STRING, TaxiOut DOUBLE, WheelsOff DOUBLE, WheelsOn DOUBLE, TaxiIn DOUBLE,
CRSArrTime BIGINT, ArrTime DOUBLE, ArrDelay DOUBLE, ArrDelayMinutes DOUBLE, ArrDel15 DOUBLE,
ArrivalDelayGroups DOUBLE, ArrTimeBlk STRING, Cancelled DOUBLE, CancellationCode STRING, Diverted DOUBLE,
CRSElapsedTime DOUBLE, ActualElapsedTime DOUBLE, AirTime DOUBLE, Flights DOUBLE, Distance DOUBLE,
DistanceGroup BIGINT, CarrierDelay DOUBLE, WeatherDelay DOUBLE, NASDelay DOUBLE, SecurityDelay DOUBLE,
LateAircraftDelay DOUBLE, FirstDepTime DOUBLE, TotalAddGTime DOUBLE, LongestAddGTime DOUBLE,
DivAirportLandings BIGINT, DivReachedDest DOUBLE, DivActualElapsedTime DOUBLE, DivArrDelay DOUBLE, DivDistance DOUBLE
"""
_DIVERSION_COLUMNS = """
Div{n}Airport STRING, Div{n}AirportID DOUBLE, Div{n}AirportSeqID DOUBLE, Div{n}WheelsOn DOUBLE,
Div{n}TotalGTime DOUBLE, Div{n}LongestGTime DOUBLE, Div{n}WheelsOff DOUBLE, Div{n}TailNum STRING
"""

_BY_NAME = {"BIGINT": _LONG, "DOUBLE": _DOUBLE, "STRING": _TEXT}


def _fields(text: str) -> list[tuple[str, T.DataType]]:
    pairs = (column.split() for column in text.split(","))
    return [(name, _BY_NAME[kind]) for name, kind in pairs]


#: Flight legs: every column of a monthly file, the partition columns last.
FLIGHT = _struct(
    *_fields(_FLIGHT_COLUMNS),
    *[field for n in range(1, 6) for field in _fields(_DIVERSION_COLUMNS.format(n=n))],
    ("Year", _LONG),
    ("Month", _LONG),
)

#: A monthly archive without these columns is rejected (fixed values).
REQUIRED = (
    "Year", "Month", "Reporting_Airline", "Origin", "Dest", "ArrDel15",
    "DepDelay", "ArrDelay", "TaxiOut", "TaxiIn", "CRSDepTime",
)

#: Columns whose nulls the audit reports (fixed values).
CRITICAL = (
    "FlightDate", "Year", "Month", "DayOfWeek", "Reporting_Airline",
    "Flight_Number_Reporting_Airline", "Tail_Number", "Origin", "Dest",
    "CRSDepTime", "TaxiOut", "TaxiIn", "Cancelled", "Diverted",
    "Div1Airport", "DivActualElapsedTime", "Distance",
)

#: Columns whose nulls the delay study reports (fixed values).
DELAY_COLUMNS = (
    "ArrDel15", "ArrDelay", "DepDelay", "Reporting_Airline", "Origin", "Dest",
    "Distance", "CRSDepTime", "DayOfWeek", "Month",
)

#: Operational identity of a flight; two rows sharing it are duplicates.
FLIGHT_KEY = (
    "FlightDate", "Reporting_Airline", "Flight_Number_Reporting_Airline",
    "Origin", "Dest", "CRSDepTime",
)

WEATHER = _struct(
    ("Origin", _TEXT),
    ("Fecha", _TEXT),
    ("precipitacion_mm", _DOUBLE),
    ("nieve_cm", _DOUBLE),
    ("viento_max_kmh", _DOUBLE),
    ("temp_media_c", _DOUBLE),
)

_WEATHER_EFFECT = _struct(("condicion", _TEXT), ("vuelos", _LONG), ("min_promedio_salida", _DOUBLE))

#: Published tables: what a consumer of the results may rely on.
CONTRACTS: dict[str, T.StructType] = {
    "resumen_global": _struct(
        ("anio", _INT), ("vuelos", _LONG),
        ("horas_salida", _DOUBLE), ("horas_llegada", _DOUBLE), ("horas", _DOUBLE),
        ("co2_t_bajo", _DOUBLE), ("co2_t_alto", _DOUBLE),
    ),
    "co2_aeropuerto_mes": _struct(
        ("aeropuerto", _TEXT), ("anio", _INT), ("mes", _INT),
        ("vuelos_salida", _LONG), ("vuelos_llegada", _LONG), ("vuelos", _LONG),
        ("min_rodaje_salida", _DOUBLE), ("min_rodaje_llegada", _DOUBLE),
        ("horas_salida", _DOUBLE), ("horas_llegada", _DOUBLE), ("horas", _DOUBLE),
        ("co2_t_bajo_salida", _DOUBLE), ("co2_t_alto_salida", _DOUBLE),
        ("co2_t_bajo_llegada", _DOUBLE), ("co2_t_alto_llegada", _DOUBLE),
        ("co2_t_bajo", _DOUBLE), ("co2_t_alto", _DOUBLE),
    ),
    "co2_aeropuerto_hora": _struct(
        ("aeropuerto", _TEXT), ("hora", _INT), ("vuelos", _LONG),
        ("min_promedio_salida", _DOUBLE), ("min_rodaje_salida", _DOUBLE),
        ("co2_t_bajo", _DOUBLE), ("co2_t_alto", _DOUBLE),
    ),
    "rodaje_clima": _WEATHER_EFFECT,
    "rodaje_clima_independiente": _WEATHER_EFFECT,
    "escenario_ahorro": _struct(
        ("concepto", _TEXT), ("detalle", _TEXT), ("co2_t_bajo_actual", _DOUBLE),
        ("co2_t_evitado", _DOUBLE), ("co2_t_bajo_escenario", _DOUBLE),
    ),
    # Open contract: any columns, only the table itself must be there.
    "benchmark_salida": T.StructType([]),
}

#: Key of each published table, unique and never null.
KEYS: dict[str, tuple[str, ...]] = {
    "resumen_global": ("anio",),
    "co2_aeropuerto_mes": ("aeropuerto", "anio", "mes"),
    "co2_aeropuerto_hora": ("aeropuerto", "hora"),
    "rodaje_clima": ("condicion",),
    "rodaje_clima_independiente": ("condicion",),
    "escenario_ahorro": ("concepto",),
    "benchmark_salida": ("aeropuerto", "anio", "mes", "hora"),
}

#: Types that stored tables are read with: the contracts', and those of tables without one.
STORED: dict[str, T.StructType] = {
    **{name: contract for name, contract in CONTRACTS.items() if contract.fields},
    "benchmark_salida": _struct(
        ("aeropuerto", _TEXT), ("anio", _LONG), ("mes", _LONG), ("hora", _LONG), ("min_rodaje_salida", _DOUBLE), ("vuelos", _LONG)),
    "clima": WEATHER,
}
