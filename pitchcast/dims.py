"""Dictionaries that drive resolution and scoring.

Everything that the original pipeline hard-codes (league ids, season rules,
name clean-up tables, report constants) is a *parameter* here, so a job can run
with the production dictionaries or with the test dictionaries that fit the
TPC-H-derived fixtures.  All tables are tiny, bounded by the dictionary itself,
which is why they may be turned into broadcast literals.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the original pipeline's dictionaries for the
# results to agree.  Kept as plain text, in their natural order.
# ---------------------------------------------------------------------------

COMPETITION_LEAGUE_IDS = {
    "LaLiga": 4335,
    "UEFA Champions League": 4480,
    "UEFA Europa League": 4481,
    "Copa del Rey": 4483,
    "UEFA Nations League": 4490,
    "Mundial": 4429,
    "Copa América": 4499,
    "Eurocopa": 4502,
    "Copa de África": 4496,
    "Supercopa de España": 4511,
    "Supercopa de Europa": 4512,
    "Mundial de Clubes": 4503,
}

SINGLE_YEAR_SEASON = ["Mundial", "Copa América", "Eurocopa", "Copa de África", "Mundial de Clubes"]

SEASON_OVERRIDES = {("Eurocopa", "2021"): "2020"}

MAX_ROUNDS = {
    "LaLiga": 38,
    "UEFA Champions League": 20,
    "UEFA Europa League": 20,
    "Copa del Rey": 10,
    "UEFA Nations League": 10,
    "Mundial": 10,
    "Copa América": 10,
    "Eurocopa": 10,
    "Copa de África": 10,
    "Supercopa de España": 3,
    "Supercopa de Europa": 1,
    "Mundial de Clubes": 10,
}
DEFAULT_MAX_ROUNDS = 10

AGGREGATE_COMPETITIONS = ["UEFA Champions League", "UEFA Europa League"]

FINISHED_STATUS = "Match Finished"

ACCENT_FOLD_FROM = "áéíóúñüç"
ACCENT_FOLD_TO = "aeiounuc"

WORD_SUBSTITUTIONS = {
    "marsella": "marseille",
    "copenhague": "copenhagen",
    "napoles": "napoli",
    "praga": "prague",
    "francfort": "frankfurt",
    "brujas": "brugge",
    "carabaj": "qarabag",
    "karabaj": "qarabag",
    "eslavia": "slavia",
    "egipto": "egypt",
    "tunez": "tunisia",
    "marruecos": "morocco",
    "sudafrica": "south africa",
    "camerun": "cameroon",
    "argelia": "algeria",
    "benin": "benin",
    "costa de marfil": "ivory coast",
    "republica democratica del congo": "dr congo",
}

TEAM_ALIASES = {
    "sporting portugal": "sporting cp",
    "union san giluas": "union saintgilloise",
    "union san giloise": "union saintgilloise",
    "union san gilas": "union saintgilloise",
    "union san gjilas": "union saintgilloise",
    "union saintgilloise": "union saintgilloise",
    "union saint gilloise": "union saintgilloise",
}

STOP_WORDS_PATTERN = r"\b(de|del)\b"
NAME_PREFIX_PATTERN = r"^(real |atletico |club |rc |fc |sd |cd )"

# ---------------------------------------------------------------------------
# Report constants of the original pipeline, as they stand.
# ---------------------------------------------------------------------------
BENCHMARKS = {"naive_baseline": 0.2222, "bookmaker": 0.19, "threshold": 0.20}
SUPERFORECASTER_MIN_N = 100
CONSISTENCY_LOW_BELOW = 0.08
CONSISTENCY_HIGH_ABOVE = 0.14
GAUGE_MAX = 0.30
TREND_LO, TREND_HI, TREND_STEPS = 0.10, 0.30, 7
HIST_BIN_WIDTH, HIST_LO, HIST_HI = 0.025, 0.0, 0.375
HIST_BAR_WIDTH = 24
RULER_WIDTH = 68
RECENT_LIMIT = 15
TEAM_DISPLAY_WIDTH = 13
COMPETITION_DISPLAY_WIDTH = 22
TRANSCRIPT_CHAR_CAP = 50_000
EXTRACTION_PREFIX = "Extract all match predictions from this transcript:\n\n"
UNDATED_WINDOW_DAYS = 45
DATED_TOLERANCE_DAYS = 1
EMPTY_ROUND_STREAK = 3


@dataclass(frozen=True)
class Dictionaries:
    """Parameter bundle for one run; defaults are the production values."""

    leagues: dict = field(default_factory=lambda: dict(COMPETITION_LEAGUE_IDS))
    single_year: tuple = tuple(SINGLE_YEAR_SEASON)
    season_overrides: dict = field(default_factory=lambda: dict(SEASON_OVERRIDES))
    max_rounds: dict = field(default_factory=lambda: dict(MAX_ROUNDS))
    default_max_rounds: int = DEFAULT_MAX_ROUNDS
    aggregate_competitions: tuple = tuple(AGGREGATE_COMPETITIONS)
    substitutions: dict = field(default_factory=lambda: dict(WORD_SUBSTITUTIONS))
    aliases: dict = field(default_factory=lambda: dict(TEAM_ALIASES))
    finished_status: str = FINISHED_STATUS

    def substitutions_longest_first(self) -> list[tuple[str, str]]:
        # stable sort: equal-length keys keep their dictionary order
        return sorted(self.substitutions.items(), key=lambda kv: len(kv[0]), reverse=True)


PRODUCTION = Dictionaries()

# Dictionaries for the TPC-H-derived test views (sources/testviews.py): the
# market segments play competitions, nation names play teams.
TEST = Dictionaries(
    leagues={"MACHINERY": 1, "BUILDING": 2, "AUTOMOBILE": 3, "FURNITURE": 4},
    single_year=("MACHINERY",),
    season_overrides={("FURNITURE", "1994-1995"): "1994"},
    max_rounds={},
    default_max_rounds=24,
    aggregate_competitions=("MACHINERY", "BUILDING"),
    substitutions={"nacion": "nation"},
    aliases={"nation7": "nation23"},      # a team of the views, known under another one's name
)
