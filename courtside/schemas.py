"""Column lists, read schemas and vocabularies.

Nothing is inferred at read time: every raw column is declared as text and typed by the cleaning functions.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column names and vocabularies of the data model -------------------------------------------------

MATCH_COLUMNS = [
    "name", "phase", "surfaceInout", "typeTournament", "date", "winnerRate", "looserRate", "looserName",
    "winnerName", "winnerRateSurface", "looserRateSurface", "url",
]

STAT_COLUMNS = [
    "player", "aces", "doubleFautes", "firstServe", "firstServePointsWon", "secondServePointsWon",
    "breakPointsFaced", "breakPointsSaved", "serviceGamePlayed", "serviceGamesWon", "totalServicePointsWon",
    "firstServeReturnPointsWon", "secondServeReturnPointsWon", "breakPointsOpportunities",
    "breakPointsConverted", "returnGamesPlayed", "returnGamesWon", "returnPointsWon", "totalPointsWon", "url",
    "year", "weight", "height", "age", "startCareer", "plays", "ranking", "points", "tournCell",
    "pointsDropping", "nextBest",
]

PERCENT_COLUMNS = [
    "breakPointsConverted", "breakPointsSaved", "firstServe", "firstServePointsWon",
    "firstServeReturnPointsWon", "serviceGamesWon", "totalPointsWon", "totalServicePointsWon",
    "returnGamesWon", "returnPointsWon", "secondServePointsWon", "secondServeReturnPointsWon",
]

COUNT_COLUMNS = [
    "aces", "doubleFautes", "breakPointsFaced", "breakPointsOpportunities", "serviceGamePlayed",
    "returnGamesPlayed",
]

THOUSANDS_COLUMNS = ["points", "pointsDropping"]

SIDE_FEATURES = [
    "aces", "age", "breakPointsConverted", "breakPointsFaced", "breakPointsOpportunities", "breakPointsSaved",
    "doubleFautes", "firstServe", "firstServePointsWon", "firstServeReturnPointsWon", "height", "nextBest",
    "points", "pointsDropping", "ranking", "returnGamesPlayed", "returnGamesWon", "returnPointsWon",
    "secondServePointsWon", "secondServeReturnPointsWon", "serviceGamePlayed", "serviceGamesWon",
    "totalPointsWon", "totalServicePointsWon", "tournCell",
]

IN_OUT = ["Indoor", "Outdoor"]
SURFACES = ["Carpet", "Clay", "Grass", "Hard"]
HANDS = ["Left-Handed", "Right-Handed"]

LABEL = "label"
FEATURES = (
    ["typeTournament", LABEL]
    + [f"{c}0" for c in SIDE_FEATURES]
    + [f"{c}1" for c in SIDE_FEATURES]
    + ["mental0", "mental1"]
    + IN_OUT
    + SURFACES
    + HANDS
    + [f"{h}.1" for h in HANDS]
    + ["RateFace2Face0", "RateFace2FaceSurface0", "RateFace2Face1", "RateFace2FaceSurface1",
       "Forme0", "Forme1", "WinMean0", "WinMean1"]
)

# round label -> ordinal
PHASE_ORDINAL = {
    "Qualification": 1, "Robin": 1, "Round Robin": 1, "Round of 128": 2, "Round of 64": 3, "Round of 32": 4,
    "Round of 16": 5, "Quarter-Finals": 6, "Semi-Finals": 7, "Finals": 8, "Quarterfinals": 6,
    "Semifinals": 7, "Final": 8,
}

# badge text that stands for a points value
TOURNAMENT_POINTS = {"finals": "2000", "grandslam": "2000"}
DEFAULT_TOURNAMENT_POINTS = "250"

# values found in `plays` that are not a playing hand
DIRTY_PLAYS = ["Eric Lambert", "Brent Larkham", "Nelen Brodar", "Tony Graham", ""]
DEFAULT_PLAYS = "Right-Handed, Two-Handed Backhand"

TOURNAMENT_GROUPS = ["Grand Chelem", "ATP"]
EXCLUDED_TOURNAMENT_WORDS = ["Femmes", "Doubles"]
OFFER_LABEL = "Match Odds"

RANKING_DEFAULT = 300.0
WIN_MEAN_DEFAULT = 200.0

# --- schemas -------------------------------------------------------------------------------------------------------


def text_schema(columns: list[str], index: bool = False) -> T.StructType:
    """All-text read schema; ``index`` declares the unnamed leading row-number column of one-row files."""
    names = (["_index"] if index else []) + columns
    return T.StructType([T.StructField(c, T.StringType()) for c in names])



TOURNAMENT_INFO = T.MapType(
    T.StringType(),
    T.StructType([
        T.StructField("surface", T.StringType()),
        T.StructField("inOut", T.StringType()),
        T.StructField("points", T.StringType()),
    ]),
)

_NAMED_ID = T.StructType([T.StructField("name", T.StringType()), T.StructField("id", T.LongType())])

FEED_GROUPS = T.StructType([
    T.StructField("group", T.StructType([
        T.StructField("groups", T.ArrayType(T.StructType([
            T.StructField("name", T.StringType()),
            T.StructField("groups", T.ArrayType(_NAMED_ID)),
        ]))),
    ])),
])

FEED_EVENTS = T.StructType([
    T.StructField("groupId", T.LongType()),
    T.StructField("events", T.ArrayType(T.StructType([T.StructField("id", T.LongType())]))),
])

FEED_OFFERS = T.StructType([
    T.StructField("events", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("englishName", T.StringType()),
        T.StructField("start", T.StringType()),
    ]))),
    T.StructField("betOffers", T.ArrayType(T.StructType([
        T.StructField("eventId", T.LongType()),
        T.StructField("criterion", T.StructType([T.StructField("label", T.StringType())])),
        T.StructField("outcomes", T.ArrayType(T.StructType([
            T.StructField("oddsFractional", T.StringType()),
        ]))),
    ]))),
])

PREDICTIONS = T.StructType([
    T.StructField("player_0_name", T.StringType()),
    T.StructField("player_1_name", T.StringType()),
    T.StructField("winner_name", T.StringType()),
    T.StructField("probability_score_player_0", T.DoubleType()),
    T.StructField("probability_score_player_1", T.DoubleType()),
    T.StructField("odd_player_0", T.DoubleType()),
    T.StructField("odd_player_1", T.DoubleType()),
    T.StructField("is_visible_to_users", T.BooleanType()),
    T.StructField("match_date", T.StringType()),
    T.StructField("complete_id", T.StringType()),
])
