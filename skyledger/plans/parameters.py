"""The sample keys, dates and years the named queries ask for."""

LOOKUP_AIRPORTS = ("NATION_3", "NATION_7", "NATION_11", "NATION_15", "NATION_20")
LOOKUP_ROUTES = (
    ("NATION_3", "NATION_7"),
    ("NATION_7", "NATION_3"),
    ("NATION_11", "NATION_15"),
    ("NATION_20", "NATION_5"),
)
YEARS = (1996, 1997, 1998)
DATES = (
    "1996-01-24", "1996-01-26", "1997-04-03", "1997-04-05",
    "1998-05-16", "1998-05-18", "1999-09-07", "1999-09-09",
)
TRIP_DATES = ("1996-01-24", "1997-04-03", "1998-05-16", "1999-09-07")
# The month that is delivered again, without flights that depart before this time.
CORRECTED_MONTH = (1996, 3)
CORRECTED_BEFORE = 600
