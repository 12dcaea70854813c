"""Hand-made flights and weather for the cases general test tables never hold."""

from __future__ import annotations

import pyarrow as pa

from groundburn.schema import WEATHER

#: Types of the flight columns the queries read, in both engines.
COLUMNS = {
    "FlightDate": "string", "Year": "long", "Month": "long", "DayOfWeek": "long",
    "Reporting_Airline": "string", "Flight_Number_Reporting_Airline": "long",
    "Origin": "string", "Dest": "string", "CRSDepTime": "long",
    "TaxiOut": "double", "TaxiIn": "double", "Cancelled": "double", "Diverted": "double",
    "DivReachedDest": "double", "Div1Airport": "string",
    "DepDelay": "double", "ArrDelay": "double", "ArrDel15": "double", "Distance": "double",
}
FLIGHT_DDL = ", ".join(f"{c} {t}" for c, t in COLUMNS.items())
WEATHER_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in WEATHER.fields)

_SQL = {"string": "VARCHAR", "long": "BIGINT", "double": "DOUBLE"}

_USUAL = dict(
    FlightDate="1996-05-06", Year=1996, Month=5, DayOfWeek=1, Reporting_Airline="AA",
    Flight_Number_Reporting_Airline=10, Origin="AAA", Dest="BBB", CRSDepTime=930, TaxiOut=15.0, TaxiIn=6.0,
    Cancelled=0.0, Diverted=0.0, DivReachedDest=None, Div1Airport=None,
    DepDelay=1.0, ArrDelay=2.0, ArrDel15=0.0, Distance=500.0,
)


def flight(**changes):
    row = {**_USUAL, **changes}
    return tuple(row[c] for c in COLUMNS)


FLIGHTS = [
    flight(), flight(), flight(),                                    # the same key three times
    flight(CRSDepTime=None), flight(CRSDepTime=None),                # NULL keys are equal keys
    *[flight(CRSDepTime=t) for t in (-5, -1, 0, 59, 60, 99, 2359, 2360, 2399, 2400, 2401, 9999, 650, 750, 2350, 1261)],
    *[flight(TaxiOut=m) for m in (None, -3.0, 0.0, 179.0, 180.0, 181.0, 1274.0)],
    *[flight(TaxiIn=m) for m in (None, -1.0, 0.0, 180.0, 180.5, 1318.0)],
    flight(TaxiOut=None, TaxiIn=None, Cancelled=1.0, ArrDel15=None, ArrDelay=None, DepDelay=None),
    flight(Cancelled=1.0), flight(Cancelled=None, Diverted=None),
    flight(Diverted=1.0, Div1Airport="CCC", DivReachedDest=1.0),
    flight(Diverted=1.0, Div1Airport="BBB", DivReachedDest=1.0),     # sent to its own destination
    flight(Diverted=1.0, Div1Airport=None, DivReachedDest=0.0, TaxiIn=None),
    flight(Diverted=1.0, Div1Airport="CCC", DivReachedDest=None, TaxiIn=200.0),
    flight(Diverted=1.0, Div1Airport="CCC", Dest=None),
    flight(FlightDate="1997-01-01"), flight(FlightDate="1996-06-01"),  # outside the partition
    flight(Year=2010, Month=1, FlightDate="2010-01-05"),             # outside the calendar
    flight(FlightDate=None),
    flight(Origin=None), flight(Dest=None), flight(Origin=None, Dest=None),
    flight(Origin="ZZZ", Dest="YYY", TaxiOut=None),                  # arrivals only, at YYY
    flight(Origin="XXX", Dest="WWW", TaxiIn=None),                   # departures only, at XXX
    *[flight(Origin="DDD", Month=m, FlightDate=f"1996-{m:02d}-15", TaxiOut=float(m), DayOfWeek=m % 9,
             Reporting_Airline="BB", ArrDel15=float(m % 2), Distance=100.0 * m) for m in range(1, 13)],
    *[flight(Year=1998, Month=2, FlightDate="1998-02-02", TaxiOut=None, TaxiIn=None, ArrDel15=None)] * 3,
    *[flight(Origin="HOT", Dest="HOT", TaxiOut=float(5 + i % 40), FlightDate=f"1996-05-{1 + i % 28:02d}")
      for i in range(120)],
]

WEATHER_ROWS = [
    ("AAA", "1996-05-06", 0.0, 0.0, 10.0, 20.0),
    ("AAA", "1996-05-06", 6.0, 0.0, 45.0, 21.0),       # the same day twice
    ("DDD", "1996-01-15", 0.0, 1.5, 50.0, -3.0),
    ("DDD", "1996-02-15", 9.0, 0.0, 50.0, 3.0),
    ("DDD", "1996-03-15", 1.0, 0.0, 40.0, 3.0),
    ("DDD", "1996-04-15", 0.5, 0.0, 39.0, 3.0),
    ("DDD", "1996-05-15", None, None, None, None),     # no measure at all: normal
    ("DDD", "1996-06-15", None, 0.0, 41.0, None),
    ("HOT", "1996-05-03", 5.0, None, 12.0, 30.0),
    (None, "1996-05-03", 5.0, 0.0, 12.0, 30.0),
    ("QQQ", "1996-05-03", 5.0, 0.0, 12.0, 30.0),
]


def load(con, flights, weather):
    """Both tables in DuckDB."""
    con.execute("CREATE OR REPLACE TABLE vuelos (" + ", ".join(f'"{c}" {_SQL[t]}' for c, t in COLUMNS.items()) + ")")
    con.execute("CREATE OR REPLACE TABLE clima (Origin VARCHAR, Fecha VARCHAR, precipitacion_mm DOUBLE, "
                "nieve_cm DOUBLE, viento_max_kmh DOUBLE, temp_media_c DOUBLE)")
    if flights:
        kinds = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}
        columns = [pa.array(values, kinds[t]) for values, t in zip(zip(*flights), COLUMNS.values())]
        rows = pa.table(columns, names=list(COLUMNS))  # noqa: F841  (read by the statement)
        con.execute("INSERT INTO vuelos SELECT * FROM rows")
    if weather:
        con.executemany("INSERT INTO clima VALUES (?, ?, ?, ?, ?, ?)", weather)
    con.execute("CREATE OR REPLACE VIEW informes AS SELECT *, row_number() OVER () AS informe FROM clima")
