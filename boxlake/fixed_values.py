"""Names, word lists, patterns and limits that results depend on.

Everything here is data, stated once and in its natural order.
"""

# --- Leagues -----------------------------------------------------------------------------
# key, display name, base URL path prefix, regulation minutes, overtime minutes,
# periods, season spans the new year, configured team codes
LEAGUES = [
    ("nba", "NBA", "", 240, 25, ["Q1", "Q2", "Q3", "Q4"], True, []),
    (
        "wnba", "WNBA", "wnba", 200, 25, ["Q1", "Q2", "Q3", "Q4"], False,
        ["ATL", "CHI", "CON", "DAL", "GSV", "IND", "LAS", "LVA", "MIN", "NYL", "PHO", "SEA", "WAS"],
    ),
]
MAX_OVERTIMES = 4
GAME_MINUTES_TOLERANCE = 0.1
SEASON_FIRST_MONTH = 10

# --- Request budget ----------------------------------------------------------------------
MAX_REQUESTS = 19
WINDOW_SECONDS = 65
MIN_GAP_SECONDS = 3.0
SCHEDULE_MAX_AGE_SECONDS = 21_600

# --- Box-score pages ---------------------------------------------------------------------
STATS_TABLE_CLASS = "stats_table"
TABLE_ID_PATTERN = r"^box-([A-Za-z0-9]{2,4})-(game|q[1-4]|h[12]|ot[0-9]*)-basic$"
FULL_GAME_CAPTION = "Basic and Advanced Stats"
PERIOD_CAPTION_PATTERN = r"^(.*) \(([QH][1234])\)"
OFFICIALS_LABEL = "Officials:"
DNP = "DNP"
PLAY_BY_PLAY_TABLE_ID = "pbp"
CSV_COLUMNS = ["Player", "Player ID", "MP", "PTS", "Team", "Team Code", "Period", "Officials", "filename"]
EXPECTED_PLAYERS = {"nba": 1442}

# --- Season archive ----------------------------------------------------------------------
SEASON_FILE_PREFIX = "player_box_"
ARCHIVE_COLUMNS = [
    ("game_id", "string"),
    ("season", "int"),
    ("season_type", "int"),
    ("game_date", "date"),
    ("athlete_id", "string"),
    ("athlete_display_name", "string"),
    ("team_id", "string"),
    ("team_abbreviation", "string"),
    ("opponent_team_abbreviation", "string"),
    ("home_away", "string"),
    ("starter", "boolean"),
    ("minutes", "double"),
    ("active", "boolean"),
    ("ejected", "boolean"),
    ("did_not_play", "boolean"),
    ("reason", "string"),
]
ABSENCE_COLUMNS = ["player_name", "player_id", "date", "status", "reason", "value", "source_file"]

# --- Absence reasons ---------------------------------------------------------------------
# Ordered: the first matching pattern decides. (status, reason, pattern over upper-case text)
UNKNOWN = "unknown"
ABSENCE_RULES = [
    ("not_chosen", "coach_decision", r"COACH'?S DECISION|TEAM DECISION"),
    ("unavailable", "suspension", r"SUSPEND|INELIGIBLE"),
    (
        "unavailable", "not_with_team",
        r"NOT WITH TEAM|DID NOT TRAVEL|OVERSEAS|NATIONAL TEAM|OLYMPIC|TRADE|G LEAGUE",
    ),
    ("unavailable", "personal", r"PERSONAL|FAMILY|BEREAVE|MENTAL HEALTH|MATERNITY|PREGNAN"),
    ("unavailable", "rest", r"\bREST\b|LOAD MANAGEMENT|FATIGUE"),
    ("unavailable", "injury", r"INJUR"),
    (
        "unavailable", "illness",
        r"\bILL|SICK|\bFLU\b|COVID|HEALTH & SAFETY|MIGRAINE|VERTIGO|DEHYDRAT|KIDNEY|CROHN|MEDICAL|"
        r"EVALUAT|COLLAPSED LUNG|DENTAL",
    ),
    (
        "unavailable", "injury",
        r"CONCUSSION|SURGERY|REHAB|RECONDITION|RECOVERY|PROTOCOL|SPRAIN|STRAIN|FRACTUR|BROKEN|TEAR|TORN|"
        r"RUPTUR|BRUISE|CONTUSION|SORE|STIFF|SPASM|INFLAM|TENDIN|TENDON|LIGAMENT|MENISCUS|BONE|CYST|"
        r"DISLOCAT|STRESS REACTION|PLANTAR|FASCIITIS|\bDISC\b|POINTER|KNEE|ANKLE|FOOT|HEEL|TOE|ACHILLES|"
        r"\bACL\b|\bMCL\b|HAMSTRING|CALF|GROIN|\bHIP\b|BACK|SHOULDER|WRIST|THUMB|FINGER|HAND|\bARM\b|"
        r"ELBOW|\bLEG\b|SHIN|QUAD|THIGH|GLUTE|ADDUCTOR|ABDUCTOR|PATELLA|TIBIA|FIBULA|ULNAR|RHOMBOID|"
        r"NECK|HEAD|\bRIB\b|STERNUM|ABDOM|CHEST|FACE|FACIAL|NOSE|NASAL|\bJAW\b|MOUTH|\bEYE\b|"
        r"LOWER BODY|STRENGTHEN",
    ),
    ("unavailable", "undisclosed", r"UNDISCLOSED|DID NOT DRESS|INACTIVE"),
]

# --- Game-summary JSON -------------------------------------------------------------------
# Compared with key names after dropping "_" and lower-casing.
INJURY_WORDS = ["injur", "inactive", "didnotplay", "availability"]
RELATED_WORDS = INJURY_WORDS + ["status", "reason", "comment", "athlete"]
EXPLANATION_KEYS = ["reason", "comment", "shortcomment", "longcomment", "details"]
PLAYER_NAME_KEYS = ["displayName", "fullName", "shortName", "name"]
STATUS_KEYS = ["availabilityStatus", "status"]
REASON_KEYS = ["reason", "injury", "type"]
STATUS_DATE_KEYS = ["statusDate", "reportedDate", "lastUpdated"]
DETAIL_KEYS = ["longComment", "shortComment", "comment", "details", "description"]
OBJECT_TEXT_KEYS = ["displayName", "name", "description"]
AVAILABILITY_COLUMNS = [
    "game_id", "game_date", "team_id", "team_abbreviation", "player_id", "player_name",
    "availability_status", "absence_reason", "status_date", "status_detail", "source_json_path",
]
