"""Column groups, thresholds and word lists shared by every stage."""

from __future__ import annotations

from dataclasses import dataclass

RAW_TARGET = "repeat_listens"
TARGET = "log_repeat_listens"
LABEL = "is_high_replay"
UNKNOWN = "Unknown"

# Column names and groups (fixed values).
AUDIO_SIGNALS = ("tempo", "danceability", "loudness", "dynamic_complexity")
AUDIO_LABELS = ("key", "key_scale")


@dataclass(frozen=True)
class FeatureConfig:
    """Which columns play which role, and the cut-offs used on them (fixed values)."""

    numeric: tuple[str, ...] = (
        "duration_sec",
        "release_year",
        "release_decade",
        "artist_career_age",
        "track_age",
        "genre_match_count",
        "has_audio_features",
        "audio_feature_missing_count",
        "career_x_duration_min",
    )
    optional_numeric: tuple[str, ...] = AUDIO_SIGNALS + ("tempo_x_dance",)
    categorical: tuple[str, ...] = ("genre", "release_type", "artist_type", "artist_country")
    optional_categorical: tuple[str, ...] = AUDIO_LABELS
    target: str = TARGET
    coverage_flag: str = "has_audio_features"
    coverage_threshold: float = 0.50
    first_year: int = 1900
    as_of_year: int = 2025

    @property
    def all_categorical(self) -> tuple[str, ...]:
        return self.categorical + self.optional_categorical


DEFAULT_FEATURES = FeatureConfig()

# Share of a language below which a word counts as rare.
RARE_WORD_SHARE = 1e-5
# Similarity (0-100) a fuzzy title match must reach.
FUZZY_CUT = 85
# Equal-depth value ranges used to spread an ordering over tasks. A task sorts about
# (distinct values / ORDER_RANGES), so raise it for columns with > 1e10 distinct values.
ORDER_RANGES = 1024

# Duration bucket edges in seconds and their labels (fixed values).
DURATION_EDGES = (90, 180, 240, 300, 420)
DURATION_LABELS = ("0_<1.5min", "1_1.5-3min", "2_3-4min", "3_4-5min", "4_5-7min", "5_7+min")
DURATION_BIN_LABELS = ("<1.5min", "1.5-3min", "3-4min", "4-5min", "5-7min", "7+min")
QUARTILE_LABELS = ("Q1 (Low)", "Q2", "Q3", "Q4 (High)")

# The 32 ASCII punctuation marks (fixed values).
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Standard English stop words (fixed values). Forms with an apostrophe can never match, because
# punctuation is removed before the look-up; they are kept so the list stays recognisable.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
    yourselves he him his himself she she's her hers herself it it's its itself they them their
    theirs themselves what which who whom this that that'll these those am is are was were be been
    being have has had having do does did doing a an the and but if or because as until while of at
    by for with about against between into through during before after above below to from up down
    in out on off over under again further then once here there when where why how all any both each
    few more most other some such no nor not only own same so than too very s t can will just don
    don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn
    doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn
    needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)

# Words added for song texts (fixed values): fillers, then section names.
FILLER_WORDS = (
    "oh", "yeah", "na", "la", "ooh", "ah", "hey", "uh", "mm",
    "gonna", "wanna", "gotta", "ain", "em", "im", "ive",
)
SECTION_WORDS = (
    "chorus", "verse", "bridge", "outro", "intro", "hook",
    "repeat", "x2", "x3", "pre",
)

CORPUS_STOP_WORDS = ENGLISH_STOP_WORDS + FILLER_WORDS + SECTION_WORDS
# The single-item profile keeps section names as words.
PROFILE_STOP_WORDS = ENGLISH_STOP_WORDS + FILLER_WORDS
