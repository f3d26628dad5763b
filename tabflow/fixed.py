"""Results and stored data depend on these, so they are not tunable."""

# Text markers that stand for a missing value in a delimited file.
NULL_MARKERS = ("NULL", "\\N")

# A user id that means "no user".
NO_USER_ID = -1

# Relationship type and property written on every follower edge.
REL_TYPE = "KNOWS"
REL_NAME = "follows"

# Positions of the fields of a user profile line (position 2 is not used).
USER_FIELDS = {
    "username": 1,
    "fname": 3,
    "lname": 4,
    "mname": 5,
    "city": 6,
    "state": 7,
    "country": 8,
    "zip": 9,
    "email": 10,
}

# Positions of the fields of a geographic feed line.
FEED_FIELDS = {"city": 1, "latitude": 4, "longitude": 5, "country": 8, "region": 10}

# Positions of the fields of a location CSV line, counted from 0.
LOCATION_FIELDS = {"country": 1, "region": 2, "city": 3, "latitude": 5, "longitude": 6}
LOCATION_HEADER_LINES = 2

# A published table alternates weekly between <name>_Table1 and <name>_Table2.
SUFFIX_STEM = "Table"
DAYS_IN_WEEK = 7

# Default batch sizes.
USER_BATCH_SIZE = 50_000
INSERT_BATCH_SIZE = 10_000
JDBC_PARTITIONS = 5
