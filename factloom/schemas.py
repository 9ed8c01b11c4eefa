"""Declared schemas and other fixed values of the player-match data set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: file format -------------------------------------------------
# Quotes inside a quoted field are doubled; a quoted field may hold line breaks
# and leading or trailing blanks.
CSV_FORMAT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# --- Fixed values: columns of the landing file, in file order -------------------
_STR, _INT, _LONG, _DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()
_D32, _D31, _D21 = T.DecimalType(3, 2), T.DecimalType(3, 1), T.DecimalType(2, 1)

SOURCE_COLUMNS = [
    ("player_id", _STR),
    ("player_name", _STR),
    ("age", _INT),
    ("nationality", _STR),
    ("team", _STR),
    ("jersey_number", _INT),
    ("position", _STR),
    ("height_cm", _INT),
    ("weight_kg", _INT),
    ("preferred_foot", _STR),
    ("club_name", _STR),
    ("market_value_eur", _LONG),
    ("match_id", _STR),
    ("match_date", _DATE),
    ("stadium", _STR),
    ("city", _STR),
    ("opponent_team", _STR),
    ("tournament_stage", _STR),
    ("match_result", _STR),
    ("goals_team", _INT),
    ("goals_opponent", _INT),
    ("minutes_played", _INT),
    ("goals", _INT),
    ("assists", _INT),
    ("shots", _INT),
    ("shots_on_target", _INT),
    ("expected_goals_xg", _D32),
    ("expected_assists_xa", _D32),
    ("key_passes", _INT),
    ("successful_passes", _INT),
    ("total_passes", _LONG),
    ("pass_accuracy", _D32),
    ("dribbles_attempted", _INT),
    ("successful_dribbles", _INT),
    ("crosses", _INT),
    ("successful_crosses", _INT),
    ("tackles", _INT),
    ("interceptions", _INT),
    ("clearances", _INT),
    ("blocks", _INT),
    ("aerial_duels_won", _INT),
    ("aerial_duels_lost", _INT),
    ("recoveries", _INT),
    ("defensive_actions", _INT),
    ("fouls_committed", _INT),
    ("fouls_suffered", _INT),
    ("yellow_cards", _INT),
    ("red_cards", _INT),
    ("offsides", _INT),
    ("saves", _INT),
    ("save_percentage", _D32),
    ("punches", _INT),
    ("clean_sheet", _INT),
    ("goals_conceded", _INT),
    ("penalty_saves", _INT),
    ("distance_covered_km", _D31),
    ("sprint_distance_km", _D21),
    ("top_speed_kmh", _D31),
    ("accelerations", _INT),
    ("decelerations", _INT),
    ("stamina_score", _D31),
    ("player_rating", _D21),
    ("performance_score", _D31),
    ("offensive_contribution", _D31),
    ("defensive_contribution", _D31),
    ("possession_impact", _D31),
    ("pressure_resistance", _D31),
    ("creativity_score", _D31),
    ("consistency_score", _D31),
    ("clutch_performance_score", _D31),
    ("total_goals_tournament", _LONG),
    ("total_assists_tournament", _LONG),
    ("total_minutes_tournament", _LONG),
    ("player_of_match_awards", _INT),
    ("tournament_rating", _D21),
]

# --- Fixed values: names the load adds ------------------------------------------
GROUP_MAX = "Team_Max_Goals"
ROW_KEY = "row_sk"
ROW_HASH = "row_hash"
DOCUMENT = "player_document"
VECTOR = "player_vector"
VECTOR_DIM = 768
NAMESPACES = ("raw_data", "util", "vector_data")

SRC = T.StructType([T.StructField(name, kind) for name, kind in SOURCE_COLUMNS])
RAW = T.StructType(
    SRC.fields
    + [
        T.StructField(GROUP_MAX, _INT),
        T.StructField(ROW_KEY, _LONG),
        T.StructField(ROW_HASH, _LONG),
    ]
)
VEC = T.StructType(
    [
        T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.DecimalType) else f.dataType)
        for f in RAW.fields
    ]
    + [
        T.StructField(DOCUMENT, _STR),
        T.StructField(VECTOR, T.ArrayType(T.FloatType())),
    ]
)

# What a filter extractor must return; both fields are required.
FILTERS = T.StructType(
    [
        T.StructField("hard_keywords", T.ArrayType(T.StringType())),
        T.StructField("semantic_query", T.StringType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind ``df`` to ``schema`` by column name, cast where the types differ."""
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
