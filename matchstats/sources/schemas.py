"""Explicit schemas for the four raw inputs and the feed of new matches."""

from pyspark.sql import types as T

RESULTS_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("home_team", T.StringType(), False),
    T.StructField("away_team", T.StringType(), False),
    T.StructField("home_score", T.IntegerType(), True),
    T.StructField("away_score", T.IntegerType(), True),
    T.StructField("tournament", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("neutral", T.BooleanType(), False),
])

GOALSCORERS_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("home_team", T.StringType(), False),
    T.StructField("away_team", T.StringType(), False),
    T.StructField("team", T.StringType(), False),
    T.StructField("scorer", T.StringType(), True),
    T.StructField("minute", T.DoubleType(), True),
    T.StructField("own_goal", T.BooleanType(), False),
    T.StructField("penalty", T.BooleanType(), False),
])

SHOOTOUTS_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("home_team", T.StringType(), False),
    T.StructField("away_team", T.StringType(), False),
    T.StructField("winner", T.StringType(), False),
    T.StructField("first_shooter", T.StringType(), True),
])

FORMER_NAMES_SCHEMA = T.StructType([
    T.StructField("current", T.StringType(), False),
    T.StructField("former", T.StringType(), False),
    T.StructField("start_date", T.DateType(), False),
    T.StructField("end_date", T.DateType(), False),
])

# One record of the incremental feed (a played match, optional shootout).
NEW_MATCH_SCHEMA = T.StructType([
    T.StructField("match_id", T.LongType(), True),
    T.StructField("date", T.DateType(), True),
    T.StructField("home_team", T.StringType(), True),
    T.StructField("away_team", T.StringType(), True),
    T.StructField("home_score", T.IntegerType(), True),
    T.StructField("away_score", T.IntegerType(), True),
    T.StructField("tournament", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("neutral", T.BooleanType(), True),
    T.StructField("shootout_winner", T.StringType(), True),
])
